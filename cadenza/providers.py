"""Interfaces for models, and stand-ins without one. A provider is made once in each Python worker and sees batches.

Separation, voice activity, speaker vectors, recognition, alignment, enhancement, pitch and both kinds of language
model plug in as a function of a batch of inputs to as many outputs.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cadenza.operators import audio


class Provider(Protocol):
    """A model: ``batch`` inputs at a time."""

    batch: int

    def __call__(self, inputs: list[dict]) -> list[dict]: ...


def apply(df: DataFrame, make: Callable[[], Provider], schema: str, key: str, attempts: int = 3, wait_s: float = 1.0) -> DataFrame:
    """(key, inputs...) to (key, outputs..., error), as the DDL ``schema`` of the outputs says.

    A batch that fails is tried again after ``wait_s`` seconds, then after twice as long, and so on; then item by item, so one bad item doesn't take others with it; an item that
    keeps failing has nulls and the reason in ``error``. To resume, leave out finished keys by an anti join before.
    """
    names = [p.split()[0] for p in re.split(r",\s*(?![^<]*>)", schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()

        def call(rows: list[dict]) -> list[dict]:
            reason = ""
            for attempt in range(attempts):
                try:
                    got = model(rows)
                    if len(got) != len(rows):
                        raise ValueError(f"{len(got)} outputs for {len(rows)} inputs")
                    return [{**x, "error": None} for x in got]
                except Exception as e:  # noqa: BLE001  whatever a model raises
                    reason = f"{type(e).__name__}: {e}"
                    if attempt + 1 < attempts:
                        time.sleep(wait_s * 2**attempt)
            return [x for r in rows for x in call([r])] if len(rows) > 1 else [{"error": reason}]

        for pdf in batches:
            rows = pdf.to_dict("records")
            out = []
            for at in range(0, len(rows), model.batch):
                part = rows[at : at + model.batch]
                out += [{key: r[key], **{n: x.get(n) for n in names}, "error": x["error"]} for r, x in zip(part, call(part))]
            yield pd.DataFrame(out, columns=[key, *names, "error"])

    kind = dict(df.dtypes)[key]
    return df.mapInPandas(run, f"{key} {kind}, {schema}, error string")


class EnergySpeech:
    """Voice activity by level. Inputs sr, pcm; output spans."""

    batch = 16

    def __call__(self, inputs: list[dict]) -> list[dict]:
        out = []
        for x in inputs:
            samples = np.frombuffer(x["pcm"], "<i2").astype(np.float32) / 32768
            out.append({"spans": [{"start": a, "end": b} for a, b in audio.energy_speech(samples, int(x["sr"]))]})
        return out


class HashVectors:
    """Speaker vectors that depend on the text of ``voice`` alone; equal voices have equal vectors."""

    batch = 64

    def __init__(self, size: int = 16):
        self.size = size

    def __call__(self, inputs: list[dict]) -> list[dict]:
        out = []
        for x in inputs:
            seed = int.from_bytes(hashlib.sha256(str(x["voice"]).encode()).digest()[:8], "little")
            v = np.random.default_rng(seed).normal(size=self.size)
            out.append({"emb": (v / np.linalg.norm(v)).tolist()})
        return out


class GivenTranscripts:
    """Recognition that already knows the text."""

    batch = 32

    def __call__(self, inputs: list[dict]) -> list[dict]:
        return [{"text": str(x["truth"]).strip()} for x in inputs]


class EvenAlignment:
    """Alignment that gives every character the same time. Inputs text, dur_s; output items."""

    batch = 8

    def __call__(self, inputs: list[dict]) -> list[dict]:
        out = []
        for x in inputs:
            chars = re.findall(r"\w", x["text"] or "")
            step = x["dur_s"] / max(1, len(chars))
            out.append({"items": [{"token": c, "start": round(k * step, 3), "end": round((k + 1) * step, 3)} for k, c in enumerate(chars)]})
        return out


VERDICTS = ("keep", "review", "drop")


def unfenced(reply: str) -> str:
    """A reply without the code fence that may stand around it."""
    return re.sub(r"^\s*```[a-z]*\s*|\s*```\s*$", "", reply)


def parse_verdict(reply: str) -> dict:
    """The JSON object of a reply, with or without a code fence around it; the verdict must be a known one."""
    got = json.loads(unfenced(reply))
    if got.get("verdict") not in VERDICTS:
        raise ValueError(f"unknown verdict {got.get('verdict')!r}")
    return {"verdict": got["verdict"], "reason": str(got.get("reason", ""))}


#: What a listening model is asked; speaker, seconds and transcript are put in.
AUDIT = """You hear one clip of %s, %.1f seconds long. Its transcript is: %s
Say whether it is fit to train a voice on. Reasons against it: another voice, clipping, a pause that doesn't belong there,
speech that can't be understood, words that the transcript lacks or has too many.
Answer with JSON only: {"verdict": "keep" | "review" | "drop", "reason": "..."}"""


def audit_prompt(speaker: str, seconds, text):
    """The question about a clip, from columns of its length and its transcript."""
    from pyspark.sql import functions as F

    return F.format_string(AUDIT, F.lit(speaker), seconds.cast("double"), F.coalesce(text, F.lit("")))


def audits(df: DataFrame, make: Callable[[], Provider], key: str = "sid", attempts: int = 6, wait_s: float = 1.0) -> DataFrame:
    """Verdicts of a listening model (its output ``reply``); whatever fails to the end has the verdict ``error``.

    Between attempts a task waits ``wait_s`` seconds, then twice as long each time.
    """
    from pyspark.sql import functions as F

    class Parsed:
        def __init__(self):
            self.model = make()
            self.batch = self.model.batch

        def __call__(self, inputs: list[dict]) -> list[dict]:
            return [parse_verdict(x["reply"]) for x in self.model(inputs)]

    got = apply(df, Parsed, "verdict string, reason string", key, attempts, wait_s)
    return got.withColumn("verdict", F.coalesce("verdict", F.lit("error")))


def accept_enhanced(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(sid, sim, floor_before, floor_after) with ``accepted``: the voice is still the same; else the original stays."""
    from pyspark.sql import functions as F

    return rows.withColumn("accepted", F.coalesce(F.col("sim") >= threshold, F.lit(False))).withColumn("floor_gain", F.col("floor_before") - F.col("floor_after"))
