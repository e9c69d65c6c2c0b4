"""Quality rules on repetition: a suffix array over the words of each text.

Suffixes of all texts of a slice are sorted together by prefix doubling, each
text apart. The ranks of every doubling step are kept, so that the longest
common prefix (LCP) of neighbours in the suffix array follows from log2 steps
of comparisons. LCP intervals of ``min_repeat`` words or more are the repeats; those
that are left-diverse are maximal. Each suffix gets the innermost interval that
holds it, and the span of that interval's length; the union of these spans is that
of all occurrences of all maximal repeats, as outer intervals are shorter and a
repeat that isn't left-diverse lies in the one a word before. The union may cover a
share of a text, and the longest interval have so many words, before it fails.

Ranks take 4 bytes a word for each doubling of the longest repeat of the slice, so a
text of 2 million words that is one loop takes about 200 MB.

Nulls and texts without words have all counts zero and fail the base rule.
Repeated rows are judged one by one. An empty table gives an empty table. Order
among equal repeats changes nothing.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from cadenza.llm.common import annotate, space_words

SYMBOLS = b"#*$%&|<>"
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_maximal_repeats long, covered_words long, longest_repeat long"
)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits: a text fails if repeats of ``min_repeat`` words or more cover over ``max_covered`` of its
    words, or if one repeat is longer than ``max_longest`` words."""

    min_words: int = 50
    base_window: int = 3
    max_base_percent: int = 50
    min_repeat: int = 8
    max_covered: float = 0.3
    max_longest: int = 100


def suffix_ranks(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of the slice, and for each step r the ranks by the first 2**r words.

    ``words`` are word ids, ``text`` the number of the text that holds each word (ascending).
    Equal ranks of step r mean that the 2**r words from there on are equal and in the same text.
    """
    n = len(words)
    kind = np.int32 if n < 2**31 - 2 else np.int64
    last = np.searchsorted(text, text, side="right") if n else np.zeros(0, np.int64)  # the end of each word's text
    key = text.astype(np.int64) * (int(words.max()) + 1 if n else 1) + words
    order = np.argsort(key, kind="stable")
    first = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    steps, h = [rank.astype(kind)], 1
    ends = np.r_[first[1:], True] if n else first
    active = order[~(first & ends)]  # in order of rank, groups of one left out
    while len(active):
        after = active + h
        inside = after < last[active]
        nxt = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        old = rank[active]
        by = np.lexsort((nxt, old)) if n >= 2**31 else np.argsort(old * (n + 1) + nxt, kind="stable")
        active, old, nxt = active[by], old[by], nxt[by]
        group = np.r_[True, old[1:] != old[:-1]]
        part = group | np.r_[True, nxt[1:] != nxt[:-1]]
        at = np.arange(len(active))
        start = np.maximum.accumulate(np.where(group, at, 0))
        rank[active] = old + np.maximum.accumulate(np.where(part, at, 0)) - start
        steps.append(rank.astype(kind))
        active = active[~(part & np.r_[part[1:], True])]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, steps


def lcp_of_neighbours(suffixes: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """LCP in words of each suffix with the one before it in the suffix array (0 for the first)."""
    n = len(suffixes)
    lcp = np.zeros(n, np.int64)
    pairs = np.flatnonzero(steps[0][suffixes[1:]] == steps[0][suffixes[:-1]]) + 1 if n > 1 else np.zeros(0, np.int64)
    a, b = suffixes[pairs - 1], suffixes[pairs]
    got = np.zeros(len(pairs), np.int64)
    for r in range(len(steps) - 1, -1, -1):
        x, y = a + got, b + got
        inside = np.maximum(x, y) < n
        same = inside & (steps[r][np.minimum(x, n - 1)] == steps[r][np.minimum(y, n - 1)])
        got += same.astype(np.int64) << r
    lcp[pairs] = got
    return lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, first, last) of every LCP interval of ``least`` words or more, and the number of the innermost one that
    holds each place of the suffix array (-1: none)."""
    found: list[list[int]] = []
    inner = np.full(len(lcp), -1, np.int64)
    stack: list[int] = []  # intervals that are open, outermost first
    before = -2
    for i in (*np.flatnonzero(lcp >= least).tolist(), len(lcp) + 1):
        if i != before + 1:  # below the least length in between
            for k in stack:
                found[k][2] = before
            stack = []
        if i >= len(lcp):
            break
        value, first = int(lcp[i]), i - 1
        while stack and found[stack[-1]][0] > value:
            k = stack.pop()
            found[k][2], first = i - 1, found[k][1]
        if not stack or found[stack[-1]][0] < value:
            stack.append(len(found))
            found.append([value, first, -1])
        now = stack[-1]
        if inner[i - 1] < 0 or found[inner[i - 1]][0] < value:
            inner[i - 1] = now
        inner[i] = now
        before = i
    return np.array(found, np.int64).reshape(-1, 3), inner


def covered(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n words the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _left_diverse(intervals: np.ndarray, suffixes, words, text) -> np.ndarray:
    """The text of each interval whose occurrences don't all follow the same word."""
    if not len(intervals):
        return np.zeros(0, np.int64)
    prev = np.where(np.r_[True, text[1:] != text[:-1]], -1, np.r_[-1, words[:-1]])[suffixes]
    differs = np.r_[0, np.cumsum((prev[1:] != prev[:-1]) | (prev[1:] < 0))]
    _, first, last = intervals.T
    return text[suffixes[first[differs[last] > differs[first]]]]


def judge(raws: list[bytes | None], rules: RepetitionRules) -> dict[str, list]:
    """The columns of FIELDS for a few texts."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids, counts, dup_lines = [], [], []
    for raw in raws:
        found = space_words(raw or b"")
        counts.append(len(found))
        ids.extend(map(number.__getitem__, found))
        lines = [x for x in (raw or b"").split(b"\n") if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    m = len(raws)
    words, n_words = np.array(ids, np.int64), np.array(counts, np.int64)
    text = np.repeat(np.arange(m), n_words)
    n = len(words)
    suffixes, steps = suffix_ranks(words, text)
    lcp = lcp_of_neighbours(suffixes, steps)
    again = lcp >= rules.base_window
    at = suffixes[again | np.r_[again[1:], False]] if n else suffixes
    base = np.bincount(text[covered(at, np.full(len(at), rules.base_window), n)], minlength=m)
    intervals, inner = lcp_intervals(lcp, rules.min_repeat)
    held = np.flatnonzero(inner >= 0)
    at, length = suffixes[held], intervals[inner[held], 0]
    spans = np.bincount(text[covered(at, length, n)], minlength=m)
    top = np.zeros(m, np.int64)
    np.maximum.at(top, text[suffixes[intervals[:, 1]]], intervals[:, 0])
    maximal = np.bincount(_left_diverse(intervals, suffixes, words, text), minlength=m)
    failed = (n_words < rules.min_words) | (100 * base > rules.max_base_percent * n_words)
    bad = (spans > rules.max_covered * n_words) | (top > rules.max_longest)
    chars = [len(x) - sum(x.count(c) for c in " \t\n\v\f\r") for x in ((raw or b"").decode() for raw in raws)]
    symbols = [len(raw) - len(raw.translate(None, SYMBOLS)) if raw else 0 for raw in raws]
    return {
        "n_words": counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": base, "base_failed": failed,
        "kept": ~failed & ~bad, "n_maximal_repeats": maximal, "covered_words": spans, "longest_repeat": top,
    }


def repetition_quality(
    docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text_col: str = "text", out: str = "repetition"
) -> DataFrame:
    """``docs`` with the counts and the verdict of every row in the struct ``out``; one pass, no shuffle."""
    return annotate(docs, text_col, FIELDS, lambda: lambda raws: judge(raws, rules), out)
