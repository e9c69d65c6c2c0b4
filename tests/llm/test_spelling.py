"""Near words, forms and roots against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from cadenza.llm import spelling
from tests.llm import helpers


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, slip=31):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = helpers.lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if n >= 2 and len(w) >= 7}


def expected(count, factor=10):
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= factor * count[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(str((w, n, len(near[w]), form.get(w), count.get(form.get(w)), root(w))) for w, n in count.items())


def got(df):
    return sorted(str(tuple(r)) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def _words(spark, count):
    return spark.createDataFrame(list(count.items()), "word string, n long")


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in helpers.awkward()] + [(50, "Größenwahn größenwahn GRÖSSEN×÷mahnen mahnenn mahnenn naïveté naïveté naivete naivete " * 3), (None, "abcdefg abcdefg")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for slip in (None, 31, 2):
        words = spelling.vocabulary(df, slip=slip)
        assert {r["word"]: r["n"] for r in words.collect()} == counted(rows, slip)
    assert got(spelling.spelling_variants(words)) == expected(counted(rows, 2))
    none = spelling.spelling_variants(spelling.vocabulary(helpers.table(spark, [])))
    assert none.count() == 0 and none.columns == ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("limit", [256, 4])
def test_dense_families(spark, monkeypatch, limit):
    """Few letters, so that most words have many near ones and blocks are divided down to two letters; lengths from 1 up, and long words."""
    monkeypatch.setattr(spelling, "LIMIT", limit)
    rng, count = random.Random(limit), {}
    for _ in range(700):
        count["".join(rng.choice("abé") for _ in range(rng.randrange(5, 10)))] = rng.choice([2, 2, 3, 20, 200])
    for k in range(60):
        stem = "".join(rng.choice("xyz") for _ in range(rng.choice([30, 64, 65, 300])))
        for _ in range(3):
            at = rng.randrange(len(stem))
            count[rng.choice([stem, stem[:at] + stem[at + 1 :], stem[:at] + "ü" + stem[at + 1 :], stem[:at] + "w" + stem[at:]])] = rng.choice([2, 30])
    count |= {w: 5 for w in ("a", "b", "ab", "abc", "ac", "é")}
    assert got(spelling.spelling_variants(_words(spark, count))) == expected(count)


def test_a_huge_family_is_not_capped(spark, monkeypatch):
    """A thousand words that differ in their last two letters only."""
    monkeypatch.setattr(spelling, "LIMIT", 16)
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäå"
    count = {f"template{x}{y}": 2 + (x == "a" and y == "a") * 40 for x in letters for y in letters}
    found = {r["word"]: r for r in spelling.spelling_variants(_words(spark, count)).collect()}
    assert len(found) == 1024 and all(r["n_near"] == 62 for r in found.values())
    assert found["templateab"]["form"] == "templateaa" and found["templatebb"]["form"] is None and found["templateaa"]["root"] == "templateaa"


def test_chains_and_ties(spark):
    """Forms of forms, and the smallest of equal ones."""
    count = {"aaaaaaaa": 100_000, "aaaaaaab": 9000, "aaaaaabb": 700, "aaaaabbb": 60, "aaaabbbb": 5, "zzzzzzzzé": 50, "zzzzzzzze": 50, "zzzzzzzz": 5, "zzzzzzz": 2}
    assert got(spelling.spelling_variants(_words(spark, count))) == expected(count)
    rows = {r["word"]: r for r in spelling.spelling_variants(_words(spark, count)).collect()}
    assert rows["aaaabbbb"]["root"] == "aaaaaaaa" and rows["zzzzzzzz"]["form"] == "zzzzzzzze"
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(100)], "word string, form string")
    assert {r["root"] for r in spelling.roots(chain).collect()} == {"w100"}


def test_halves_meet():
    """Of two words one edit apart, a half of the shorter one's length is equal in front or behind."""
    rng = random.Random(1)
    for _ in range(3000):
        w = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 12)))
        at = rng.randrange(len(w) + 1)
        other = rng.choice([w[:at] + "c" + w[at:], w[:at] + w[at + 1 :], w[: max(0, at - 1)] + "c" + w[at:]])
        if one_edit(w, other):
            q = min(len(w), len(other)) // 2
            assert w[:q] == other[:q] or w[len(w) - q :] == other[len(other) - q :]
