"""Groups of segments by meaning: a language model proposes them, the rules decide, single segments are the way out.

No group may cross a hard break, so the unit of a question is a run between two of them; a run of over ``most_rows``
segments is parted at a long pause, see :func:`groups`. Runs of one segment are never asked about. A task holds one question's rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import ordered
from cadenza.operators.grouping import Packing
from cadenza.providers import Provider, unfenced
from cadenza.sources.fixtures import by_i

#: A segment in a question: i, start and end in milliseconds, text.
Row = tuple[int, int, int, str | None]

QUESTION = """These are consecutive speech segments of one recording, one JSON object a line.
Join neighbours that belong to one sentence or thought, and part them where the subject changes.
A group lasts {max_s:g} s at most, from the start of its first segment to the end of its last. A group may be one segment.
Every i stands in exactly one group, and the order stays.
Answer with JSON only: {{"groups": [[i, ...], ...]}}

"""
AGAIN = "That can't be used: {fault}. Give all groups again, as JSON only."


def question(rows: list[Row], rules: Packing) -> str:
    """The prompt for some segments, with times in seconds."""
    lines = [json.dumps({"i": i, "start": a / 1000, "end": b / 1000, "text": text or ""}, ensure_ascii=False) for i, a, b, text in rows]
    return QUESTION.format(max_s=rules.max_dur / 1000) + "\n".join(lines)


def proposed(reply: str) -> list[list[int]]:
    """The groups of a reply; a ValueError says what is wrong with its form."""
    got = json.loads(unfenced(reply))
    groups = got.get("groups") if isinstance(got, dict) else None
    if not isinstance(groups, list) or not all(isinstance(g, list) and g and all(type(i) is int for i in g) for g in groups):
        raise ValueError("no list of groups of whole numbers")
    return groups


def fault(groups: list[list[int]], rows: list[Row], rules: Packing) -> str | None:
    """The first rule that groups break, or None. Gaps need no look: a question never holds a hard break."""
    asked, said = [r[0] for r in rows], [i for g in groups for i in g]
    if said != asked:
        return "the order changed" if sorted(said) == sorted(asked) else "some i is missing, new or there twice"
    times = {i: (a, b) for i, a, b, _ in rows}
    for g in groups:
        length = times[g[-1]][1] - times[g[0]][0]
        if len(g) > 1 and length > rules.max_dur:
            return f"the group from {g[0]} to {g[-1]} lasts {length / 1000:.1f} s"
    return None


def ask(model: Provider, rows: list[Row], rules: Packing, attempts: int, wait_s: float) -> tuple[list[list[int]], str]:
    """Groups and where they come from: ``model``, or ``fallback`` when no attempt gave sound ones."""
    talk = [{"role": "user", "content": question(rows, rules)}]
    for attempt in range(attempts):
        try:
            reply = model([{"messages": talk}])[0]["reply"]
        except Exception:  # noqa: BLE001  whatever a model raises
            time.sleep(wait_s * 2**attempt)
            continue
        try:
            groups = proposed(reply)
            wrong = fault(groups, rows, rules)
        except ValueError as e:
            wrong = str(e)
        if wrong is None:
            return groups, "model"
        talk = [*talk, {"role": "assistant", "content": reply}, {"role": "user", "content": AGAIN.format(fault=wrong)}]
    return [[r[0]] for r in rows], "fallback"


def groups(gapped: DataFrame, texts: DataFrame, make: Callable[[], Provider], rules: Packing = Packing(), most_rows: int = 200, attempts: int = 3, wait_s: float = 1.0) -> DataFrame:
    """(idx, head, pos, i, source): groups named by their first segment, pos from 0; source model, fallback or single.

    ``gapped`` is what :func:`cadenza.operators.segments.gaps` gives, ``texts`` has (idx, i, text); a segment without a
    text has an empty one. The model's input is ``messages``, its output ``reply``. Tables without rows give none.
    """
    hard = ~(F.col("next_is_adjacent") & (F.col("gap_ms") <= rules.max_gap))
    rows = gapped.withColumn("breaks", F.coalesce(hard, F.lit(True)).cast("int"))
    runs = ordered.running_sum(rows, ["idx"], ["i"], by_i(), F.col("breaks"), "run", inclusive=False)
    asked = runs.select("idx", "run", "i", "start_ms", "end_ms").join(texts.select("idx", "i", "text"), ["idx", "i"], "left")
    asked = asked.select("idx", "run", "i", "start_ms", "end_ms", "text").repartition("idx", "run").sortWithinPartitions("idx", "run", "i")
    columns = ["idx", "head", "pos", "i", "source"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, at, held = make(), None, []

        def settle(n: int | None = None) -> list[tuple]:
            """Ask about the first ``n`` segments that are held, or all."""
            rows = held[:n]
            del held[:n]
            if not rows:
                return []
            found, source = ask(model, rows, rules, attempts, wait_s) if len(rows) > 1 else ([[rows[0][0]]], "single")
            return [(at[0], g[0], pos, i, source) for g in found for pos, i in enumerate(g)]

        def widest() -> int:
            """Where a run that is too long for a question is parted: at the longest pause of its later half, the last among equals."""
            return max(range(max(1, len(held) // 2), len(held)), key=lambda k: (held[k][1] - held[k - 1][2], k))

        for pdf in batches:
            out = []
            for idx, no, i, start, end, text in pdf.itertuples(index=False):
                if at != (idx, no):
                    out += settle()
                    at = (idx, no)
                elif len(held) > 1 and len(held) >= most_rows:
                    out += settle(widest())
                held.append((int(i), int(start), int(end), text))
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame(settle(), columns=columns)

    return asked.mapInPandas(run, f"idx {dict(gapped.dtypes)['idx']}, head long, pos long, i long, source string")


def as_splits(found: DataFrame, packed: DataFrame) -> DataFrame:
    """Model groups as splits (idx, gid, part, pos, i) of packed groups, for :func:`cadenza.operators.grouping.apply_splits`.

    Where a model's group goes beyond a packed one, its members there are a part of their own.
    """
    rows = packed.select("idx", "gid", F.col("pos").alias("place"), "i").join(found.select("idx", "i", "head").hint("merge"), ["idx", "i"])
    return rows.select("idx", "gid", F.col("head").alias("part"), F.col("place").alias("pos"), "i")
