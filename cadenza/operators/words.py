"""Words with times from transcripts and their alignments.

An alignment is one row for each clip (sid, text, items). Its items are walked along the clip's transcript; each one met
becomes a row with its step in the walk and the characters up to the next one met, whose marks tell what kind of
boundary lies between. Clips without an alignment are left out, and so are clips of which too little is met.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import matching
from cadenza.functions.rowwise import mapped

STEPS = "array<struct<pos: long, item: long, between: string>>"


@dataclass(frozen=True)
class Trust:
    """Alignments that can be judged: how alike their text must be to the clip's, the share of items met, and the items met at least."""

    least_sim: float = 0.5
    least_met: float = 0.8
    least_words: int = 2


def _ms(seconds: Column) -> Column:
    return F.round(seconds * 1000).cast("long")


def walked(metadata: DataFrame, alignments: DataFrame, compare: bool = True) -> DataFrame:
    """(sid, text) and (sid, text, items) to sid, items, sim, n_items, aligned and steps, for clips that both have.

    ``steps`` has for each item met its step, its number, and what stands between it and the next one. Without
    ``compare`` the texts aren't compared and ``sim`` is null. A null text is empty, null items are none.
    """
    rows = metadata.select("sid", "text").join(alignments.select("sid", F.col("text").alias("heard"), "items"), "sid")

    def run(sid, text, heard, tokens) -> tuple:
        text, tokens = text or "", tokens or []
        met = matching.aligned_tokens(text, tokens)
        ends = [start for _, start, _ in met[1:]] + [len(text)]
        steps = [{"pos": step, "item": k, "between": text[end:then]} for k, ((step, _, end), then) in enumerate(zip(met, ends))]
        return sid, matching.similarity(text, heard or "") if compare else None, len(tokens), len(met), steps

    tokens = F.transform("items", lambda x: F.coalesce(x["token"], F.lit("")))
    kind = dict(rows.dtypes)["sid"]
    made = mapped(rows.select("sid", "text", "heard", tokens.alias("tokens")), run, f"sid {kind}, sim double, n_items long, aligned long, steps {STEPS}")
    return made.join(alignments.select("sid", "items"), "sid")


def eligible(scored: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """Rows of :func:`walked` that are good enough to judge."""
    return scored.where((F.col("sim") >= trust.least_sim) & (F.col("aligned") >= trust.least_met * F.col("n_items")) & (F.col("aligned") >= trust.least_words))


def rows(scored: DataFrame) -> DataFrame:
    """A row for each item met: sid, pos (its step), token, start_ms, end_ms, between."""
    met = scored.select("sid", "items", F.explode("steps").alias("s")).select("sid", F.col("s.pos").alias("pos"), F.get("items", F.col("s.item").cast("int")).alias("x"), F.col("s.between").alias("between"))
    return met.select("sid", "pos", F.col("x.token").alias("token"), _ms(F.col("x.start")).alias("start_ms"), _ms(F.col("x.end")).alias("end_ms"), "between")


def judged(metadata: DataFrame, alignments: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """The words of clips whose alignment can be judged, as the silence checks need them."""
    return rows(eligible(walked(metadata, alignments), trust))


def heard(metadata: DataFrame, alignments: DataFrame, least_items: int = 2) -> DataFrame:
    """sid, pos, token, start_ms, end_ms of all items of the clips in ``metadata``, met in the text or not: sound that some word accounts for."""
    some = alignments.join(metadata.select("sid").distinct(), "sid", "left_semi").where(F.size("items") >= least_items)
    items = some.select("sid", F.posexplode("items").alias("pos", "x"))
    return items.select("sid", F.col("pos").cast("long").alias("pos"), F.col("x.token").alias("token"), _ms(F.col("x.start")).alias("start_ms"), _ms(F.col("x.end")).alias("end_ms"))
