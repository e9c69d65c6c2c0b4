"""SimHash fingerprints against their definition, links against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from cadenza.llm import simhash
from cadenza.llm.common import Scratch
from tests.llm import helpers


def plain(text):
    words = helpers.space_words(helpers.lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(prints):
    """The smallest place of each one's component, comparing all pairs."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    a = np.array(prints, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= 4) + i + 1:
            x, y = find(i), find(int(j))
            up[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(a))]


def expected(rows):
    root = components([plain(t) for _, t in rows])
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(str((i, f"{plain(t):016x}", least[r])) for r, (i, t) in zip(root, rows))


def got(df):
    return sorted(str((r["doc_id"], f"{r['fingerprint'] & (2**64 - 1):016x}", r["component_id"])) for r in df.collect())


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in helpers.awkward()]
    assert got(simhash.simhash_groups(helpers.table(spark))) == expected(rows)
    assert simhash.simhash_groups(helpers.table(spark, [])).count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    text = helpers.prose(5, 3000)
    for piece in (7, 1 << 16):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(text.encode()) == plain(text)
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \t ") == 0 and simhash.fingerprint("Ä b C".encode()) == plain("Ä b C")


def _linked(spark, prints):
    """Components by the links of the operator."""
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    pairs = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(df, Scratch(spark, "t")).collect()]
    place = {p: k for k, p in enumerate(prints)}
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(place[a]), find(place[b])
        up[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))], pairs


def _prints(seed, groups, size, bits):
    """Groups around random centres, each member with up to ``bits`` of them changed."""
    rng, out = random.Random(seed), set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(bits + 1))))
    return sorted(out)


@pytest.mark.parametrize(("limit", "block"), [(4096, 2048), (8, 4), (64, 16)])
def test_links_equal_all_pairs(spark, monkeypatch, limit, block):
    """Tight and loose groups; with small limits buckets are cut into pieces, and pieces into blocks."""
    monkeypatch.setattr(simhash, "LIMIT", limit)
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = sorted({*_prints(1, 40, 12, 5), *_prints(2, 3, 150, 4), *_prints(3, 300, 1, 0), 0, 2**64 - 1, 1, 15, 31})
    found, pairs = _linked(spark, prints)
    assert found == components(prints)
    assert len(pairs) <= 8 * len(prints) and len({*found}) > 300


def test_every_way_to_differ_in_four_bits(spark):
    """Pairs of exactly 4 and 5 bits, spread over the segments in all ways."""
    rng, prints, near = random.Random(4), [], []
    for k in range(600):
        p = rng.getrandbits(64)
        n = 4 + k % 2
        parts = [rng.randrange(3) for _ in range(n)]
        bits = set()
        for s in parts:
            low, width = simhash.CUTS[s]
            bits.add(rng.choice([b for b in range(low, low + width) if b not in bits]))
        prints += [p, p ^ sum(1 << b for b in bits)]
        near.append(n == 4)
    found, _ = _linked(spark, prints)
    assert [found[2 * k] == found[2 * k + 1] for k in range(600)] == near
    assert sum(w for _, w in simhash.CUTS) == 64 and len(simhash.CUTS) == 3


def test_forest_of_a_chain():
    n = 500
    x = np.arange(n - 1)
    order = np.random.default_rng(0).permutation(n)
    label = simhash.forest(order[x], order[x + 1], n)
    assert (label == 0).all() and (simhash.forest(np.zeros(0, int), np.zeros(0, int), 3) == np.arange(3)).all()


def test_hot_fingerprints(spark, monkeypatch):
    """Many copies of one text; every key counts as hot."""
    from cadenza.llm import near_dup

    monkeypatch.setattr(near_dup, "HOT", 3)
    rows = list(enumerate([helpers.prose(1, 50)] * 60 + [None] * 20 + [helpers.prose(k, 30) for k in range(2, 12)] + [helpers.prose(1, 50) + " x"]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(simhash.simhash_groups(df)) == expected(rows)
