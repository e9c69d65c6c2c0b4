"""Small tables with every awkward kind of row, and plain versions of the definitions."""

from __future__ import annotations

import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, language string, repetition string, n long, row long, tokens string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "ing", "er"]) for _ in range(n))


def awkward() -> list[tuple]:
    """(doc_id, text, ...): null and empty texts, null and repeated ids, repeated rows, a very long text and word."""
    texts = [
        (1, prose(1, 80)), (2, None), (3, ""), (4, " \t\n "), (None, prose(2, 60)), (5, prose(1, 80)), (5, prose(1, 80)), (6, "one"), (7, "x" * 30_000), (8, prose(3, 20_000)),
        (9, "Łódź 日本語 ΑΣ İ ﬁ \u0085 a\x1cb <|endoftext|> don't"), (10, "### 1234 $$$"), (11, prose(4, 40) + "\n" + prose(4, 40) + "\n" + prose(4, 40)),
    ]
    return [(i, t, "en", "clash", "clash", 1, 2, "clash") for i, t in texts]


def table(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = space_words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(rows: list[tuple]) -> list[tuple[int | None, int, int | None]]:
    """(doc_id, set size, component id) of every row, comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[find(i)] = find(j)
    ids: dict[int, list[int]] = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)]


def item_hits(text: str | None, items: list[tuple]) -> tuple[int, int, list[str]]:
    """Words, hit words and items found."""
    words = alnum_words(text)
    hit, found = set(), set()
    for item, body in items:
        w = alnum_words(body)
        if item is None or not w:
            continue
        size = min(10, len(w))
        wanted = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def repetition(text: str | None, least: int) -> tuple[int, int, int]:
    """Words in repeated windows of three, words covered by repeats of ``least`` words or more, the longest of them."""
    w = space_words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    base = {k for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    cover, top = set(), 0
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        if best >= least:
            cover.update(range(i, i + best))
            top = max(top, best)
    return len(base), len(cover), top
