"""Divergence of sources against its definition in plain integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import divergence
from tests.llm import helpers


def expected(rows, min_docs):
    """(lang, source, part, item, value, rank) of (text, lang, source)."""
    rows = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", helpers.lower(t)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {x for _, x, _ in rows}:
        docs = Counter(t for w, x, _ in rows if x == lang for t in {*w})
        kept = sorted((t for t, n in docs.items() if n >= min_docs), key=str.encode)
        count = {s: Counter(t for w, x, y in rows if x == lang and y == s for t in w) for s in {y for _, x, y in rows if x == lang}}
        total = sum(count.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in count.items()}, shares(total)
        for s in count:
            pairs = sorted(((o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in count if o != s), key=lambda x: (-x[1], x[0].encode()))
            over = sorted(((t, p[s][t] - q[t]) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda x: (-x[1], x[0].encode()))[: divergence.TOP]
            out += [(lang, s, part, item, v, k) for part, found in (("pair", pairs), ("term", over)) for k, (item, v) in enumerate(found, 1)]
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def _rows(seed, n, sources, vocabulary):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(sources)
        weight = [1 + 5 * (hash_ % 3 == len(source or "") % 3) for hash_ in range(len(vocabulary))]
        rows.append((" ".join(rng.choices(vocabulary, weight, k=rng.randrange(40))), lang, source))
    return rows


VOCABULARY = [*helpers.WORDS, "Éclair", "éclair", "日本", "ﬁ", "\U0001f600", "Z", "z", "zz", "a", "aa"]


@pytest.mark.parametrize(("chunk", "sources"), [(4096, 256), (3, 2), (1, 1)])
def test_by_definition(spark, monkeypatch, chunk, sources):
    """One chunk and one block, many small ones, and chunks of one or two terms with blocks of one source; ties, nulls and groups without terms."""
    monkeypatch.setattr(divergence, "SOURCES", sources)
    rows = _rows(chunk, 160, ["s1", "s2", "s33", "", None, "é", "z"], VOCABULARY)
    rows += [(None, "en", "silent"), ("", "en", "silent"), ("...", "xx", "only"), ("rare words", "fr", "a"), ("other", "fr", "b"), ("more", "fr", "c")] + rows[:20]
    df = spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], "text string, lang string, source string, n long, term string, rank string").repartition(5)
    assert got(divergence.source_divergence(df, min_docs=3, chunk=chunk)) == expected(rows, 3)


def test_more_than_the_top(spark):
    rows = [(" ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(s, 300, 1 + s)), "en", f"s{s % 2}") for s in (0, 1, 2, 3)] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    found = divergence.source_divergence(df, min_docs=2, chunk=17)
    assert got(found) == expected(rows, 2) and found.where("part = 'term'").groupBy("source").count().agg({"count": "max"}).first()[0] == 50


def test_empty(spark):
    found = divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string"))
    assert found.count() == 0 and dict(found.dtypes)["value"] == "bigint" and dict(found.dtypes)["rank"] == "int"


def test_shares_are_exact():
    rng = random.Random(2)
    for top in (10, 10**6, 10**12, 10**15):
        counts = [rng.randrange(top) for _ in range(50)]
        total = sum(counts) % (9 * 10**15 - 100) + max(counts) + 100
        assert divergence.shares(np.array(counts, np.int64), total).tolist() == [1 + 1_000_000_000 * (c + 5) // total for c in counts]


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    """A full table of terms goes on and starts anew, a group's terms in several batches."""
    import pyarrow as pa

    rows = _rows(7, 80, ["s1", "s2"], VOCABULARY)
    batch = pa.RecordBatch.from_pydict({"lang": [x or "" for _, x, _ in rows], "source": [y for *_, y in rows], "text": [t for t, *_ in rows]})
    sums = []
    for held in (1, 1 << 30):
        monkeypatch.setattr(divergence, "HELD_BYTES", held)
        monkeypatch.setattr(divergence, "slices", lambda batches: (b.slice(k, 7) for b in batches for k in range(0, b.num_rows, 7)))
        total = Counter()
        for out in divergence._counted(iter([batch])):
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in out.columns)):
                total[lang, source, term, "n"] += n
                total[lang, source, term, "docs"] += docs
        sums.append(total)
    assert sums[0] == sums[1] and sum(v for k, v in sums[0].items() if k[3] == "n") == sum(len(divergence.terms(t.encode())) for t, *_ in rows)
