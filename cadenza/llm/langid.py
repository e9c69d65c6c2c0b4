"""Language identification by the nearest of several centroids for each language.

A text becomes a vector over hashed byte 3-grams of its lower-cased letters:
log(1 + count) times idf, of length 1. Fitting takes labelled rows, at most
``per_language`` of each language, ``sample`` in all, and one of each at least, drawn
by a 64-bit hash from the texts of ``longest`` characters at most; their
vectors are clustered into ``clusters`` centroids for each language by spherical
k-means. A text gets the language of the centroid of largest cosine; its score
is that cosine, and it is rejected if the distance, 1 - cosine, exceeds
``max_distance``. Short texts have few 3-grams and lie far from any centroid, so
the limit shrinks to the part that their count of 3-grams can reach.

Null texts and texts without a letter get ``und``, score 0, and are rejected.
Rows without a language aren't learnt from; without any such rows all texts
are ``und``. Ties go to the language that sorts first. Repeated rows are judged
alike, and equal ones count once in fitting; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import annotate, drawn, raw_texts, slices

FIELDS = "lang_pred string, score double, rejected boolean"
_SPACE = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
_LETTER = re.compile(rb"[a-z]").search


@dataclass(frozen=True)
class LanguageRules:
    buckets: int = 8192
    clusters: int = 3
    per_language: int = 400
    sample: int = 4000
    longest: int = 200_000
    max_distance: float = 0.9
    #: 3-grams from which the full limit holds.
    enough: int = 60


def grams(raw: bytes | None, buckets: int) -> np.ndarray | None:
    """The hashed 3-grams of a text, with repeats; None without a letter."""
    if not raw:
        return None
    text = raw if raw.isascii() else raw.decode().lower().encode()
    low = text.lower().translate(_SPACE)
    if not _LETTER(low) and not any(c.isalpha() for c in low.decode("utf-8", "ignore")):
        return None
    b = np.frombuffer(b" " + b" ".join(low.split()) + b" ", np.uint8).astype(np.uint32)
    code = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    return (code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(buckets)


class Centroids:
    """idf, and unit vectors with their languages."""

    def __init__(self, idf: np.ndarray, vectors: np.ndarray, languages: list[str]):
        self.idf, self.vectors, self.languages = idf.astype(np.float32), np.ascontiguousarray(vectors.T, np.float32), languages

    def score(self, raws: list[bytes | None], rules: LanguageRules) -> dict[str, list]:
        pred, score, rejected = ["und"] * len(raws), [0.0] * len(raws), [True] * len(raws)
        for start in range(0, len(raws), 64):
            found = [(i, g) for i, r in enumerate(raws[start : start + 64], start) if (g := grams(r, rules.buckets)) is not None]
            if not found or not self.languages:
                continue
            x = np.stack([np.bincount(g, minlength=rules.buckets) for _, g in found]).astype(np.float32)
            x = np.log1p(x) * self.idf
            cos = (x @ self.vectors) / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
            best = cos.argmax(1)
            for (i, g), k, row in zip(found, best.tolist(), cos):
                pred[i], score[i] = self.languages[k], float(min(1.0, max(0.0, row[k])))
                rejected[i] = score[i] < (1 - rules.max_distance) * min(1.0, len(g) / rules.enough)
        return {"lang_pred": pred, "score": score, "rejected": rejected}


def _clusters(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Spherical k-means from well-spread starts."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    c = x[chosen]
    for _ in range(15):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(labelled: DataFrame, rules: LanguageRules = LanguageRules()) -> Centroids:
    """Centroids from (text, lang) rows."""
    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    buckets, none = rules.buckets, Centroids(np.ones(rules.buckets), np.zeros((0, rules.buckets)), [])
    n_languages = rows.agg(F.count_distinct("lang")).first()[0]
    if not n_languages:
        return none
    most = max(1, min(rules.per_language, rules.sample // n_languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for lang, draw, raw in zip(batch.column("lang").to_pylist(), batch.column("draw").to_pylist(), raw_texts(batch)):
                if (g := grams(raw, buckets)) is not None:
                    gram, count = np.unique(g, return_counts=True)
                    for x, y in zip(out, (lang, draw, gram.astype("<u4").tobytes(), count.astype("<u4").tobytes())):
                        x.append(y)
            kinds = pa.string(), pa.int64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["lang", "draw", "grams", "counts"])

    by_lang: dict[str, list[np.ndarray]] = {}
    sample = drawn(rows, "lang", ["text"], most, rules.longest).select("lang", "draw", "text")
    for r in sample.mapInArrow(run, "lang string, draw long, grams binary, counts binary").orderBy("lang", "draw").collect():
        own = by_lang.setdefault(r["lang"], [])
        if len(own) < most:
            x = np.zeros(buckets, np.float32)
            x[np.frombuffer(r["grams"], "<u4")] = np.frombuffer(r["counts"], "<u4")
            own.append(x)
    if not by_lang:
        return none
    languages, vectors, seen, total = [], [], np.zeros(rules.buckets), 0
    for own in by_lang.values():
        seen += (np.stack(own) > 0).sum(0)
        total += len(own)
    idf = np.log((1 + total) / (1 + seen)) + 1
    for k, lang in enumerate(sorted(by_lang)):
        x = np.log1p(np.stack(by_lang[lang])) * idf.astype(np.float32)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        for c in _clusters(x, rules.clusters, k):
            languages.append(lang)
            vectors.append(c)
    return Centroids(idf, np.stack(vectors), languages)


def identify(docs: DataFrame, centroids: Centroids, text_col: str = "text", rules: LanguageRules = LanguageRules(), out: str = "language") -> DataFrame:
    """``docs`` with the struct ``out``: lang_pred, score, rejected; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(centroids)
    return annotate(docs, text_col, FIELDS, lambda: lambda raws: shared.value.score(raws, rules), out)
