"""Matching of transcripts and aligned words: small helpers for one utterance each.

Texts are matched by their longest common block, then what lies left and right of it, and so on. Of several longest
blocks the one that starts first in the first text counts, of these the first in the second text. All runs of equal
characters are found at once from equal strings of a few; of texts with too many of these, a block at a time by a suffix
automaton of one side, in time linear in both.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from heapq import heappop, heappush

import numpy as np

from cadenza.functions.text import FIN, MID

DELETE_BELOW, INSERT_ABOVE = 0.10, 0.50
# From this length on, characters that make up over a hundredth of the second text only extend blocks.
POPULAR_FROM = 200
# Lengths of the equal strings that runs are found by, the next where the one before makes over MOST_PAIRS pairs.
SEEDS, MOST_PAIRS, MOST_CELLS = (4, 8, 16, 64), 1_000_000, 16_000_000


def _longest(a: list, b: list) -> tuple[int, int, int]:
    """(start in a, start in b, length) of the longest common block; zeros if there is none."""
    follow, link, length, first = [{}], [-1], [0], [0]  # states of the automaton of b; ``first`` is where its strings first end
    last = 0
    for end, c in enumerate(b):
        new = len(length)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        first.append(end)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(length)
                follow.append(follow[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                first.append(first[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    best, at, to, state, size = 0, 0, 0, 0, 0
    for end, c in enumerate(a):
        while state and c not in follow[state]:
            state = link[state]
            size = length[state]
        if c in follow[state]:
            state = follow[state][c]
            size += 1
        if size > best:
            best, at, to = size, end + 1 - size, first[state] + 1 - size
    return at, to, best


def _runs(a: str, b: str, least: int) -> list[tuple[int, int, int]] | None:
    """(-length, start in a, start in b) of all diagonal runs of equal characters that are ``least`` (a power of two) long, by size and place.

    None where equal strings of that length make over ``MOST_PAIRS`` pairs.
    """
    n, m = len(a) - least + 1, len(b) - least + 1
    if min(n, m) < 1:
        return []
    rank = np.unique(np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)[1].astype(np.int64)
    k = 1
    while k < least:  # ranks of strings twice as long
        rank = np.unique(rank[:-k] * len(a + b) + rank[k:], return_inverse=True)[1]
        k *= 2
    left, right = rank[:n], rank[len(a) :]
    order = np.argsort(right, kind="stable")
    first = np.searchsorted(right, left, "left", sorter=order)
    count = np.searchsorted(right, left, "right", sorter=order) - first
    if (total := int(count.sum())) > MOST_PAIRS:
        return None
    i = np.repeat(np.arange(n), count)
    j = order[np.repeat(first - np.cumsum(count) + count, count) + np.arange(total)]
    at = np.sort((j - i + n) * (n + 1) + i)  # by diagonals, and along them
    opens = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(opens, append=total) + least - 1
    i = at[opens] % (n + 1)
    j = at[opens] // (n + 1) - n + i
    at = np.lexsort((j, i, -size))
    return list(zip((-size[at]).tolist(), i[at].tolist(), j[at].tolist()))


def _rare_runs(a: str, b: str, often: set[str]) -> list[tuple[int, int, int]]:
    """The same for runs of any length of characters that aren't in ``often``."""
    where: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        if c not in often:
            where.setdefault(c, []).append(j)
    out = []
    for i, c in enumerate(a):
        before = a[i - 1] if i and a[i - 1] not in often else None
        for j in where.get(c, ()):
            if before is None or j == 0 or b[j - 1] != before:
                n = 1
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n] not in often:
                    n += 1
                out.append((-n, i, j))
    return sorted(out)


def _placed(a: str, b: str, runs: list[tuple[int, int, int]], least: int, often: set[str]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Blocks from all runs of ``least`` characters, longest first, and the fields (a0, a1, b0, b1) that are left.

    A run that a block has cut is put back with what is left of it in each field.
    """
    fields, starts, out = [(0, len(a), 0, len(b))], [0], []
    while runs:
        size, i, j = heappop(runs)
        end = i - size
        at = max(bisect_right(starts, i) - 1, 0)
        if not fields:
            break
        a0, a1, b0, b1 = fields[at]
        if i < a0 or end > a1 or j < b0 or j - size > b1:
            while at < len(fields) and fields[at][0] < end:
                a0, a1, b0, b1 = fields[at]
                first, last = max(i, a0, b0 + i - j), min(end, a1, b1 + i - j)
                if last - first >= least:
                    heappush(runs, (first - last, first, first + j - i))
                at += 1
            continue
        n = -size
        if often:
            while i > a0 and j > b0 and a[i - 1] == b[j - 1]:
                i, j, n = i - 1, j - 1, n + 1
            while i + n < a1 and j + n < b1 and a[i + n] == b[j + n]:
                n += 1
        out.append((i, j, n))
        both = [f for f in ((a0, i, b0, j), (i + n, a1, j + n, b1)) if f[0] < f[1] and f[2] < f[3]]
        fields[at : at + 1], starts[at : at + 1] = both, [f[0] for f in both]
    return out, fields


def _short(a: str, b: str, field: tuple[int, int, int, int], most: int) -> list[tuple[int, int, int]]:
    """Blocks of a field whose longest has ``most`` characters at most."""
    todo, out = [(*field, most)], []
    while todo:
        a0, a1, b0, b1, n = todo.pop()
        while (n := min(n, a1 - a0, b1 - b0)) > 0:
            if b1 - b0 == 1:
                i, j = a.find(b[b0], a0, a1), b0
            else:
                i = a0
                while i <= a1 - n and (j := b.find(a[i : i + n], b0, b1)) < 0:
                    i += 1
                i = i if i <= a1 - n else -1
            if i < 0:
                n -= 1
                continue
            out.append((i, j, n))
            if n > 1 and a0 < i and b0 < j:
                todo.append((a0, i, b0, j, n - 1))  # an equally long one would start first
            a0, b0 = i + n, j + n
    return out


def blocks(a: str, b: str, popular: bool = False) -> list[tuple[int, int, int]]:
    """Equal blocks (start in a, start in b, length) in order, none of them empty.

    With ``popular``, frequent characters of a long ``b`` don't start blocks, only extend them. Blocks of four characters or
    more come from all runs at once, shorter ones by search in what lies between; where equal strings are too many, the
    automaton gives one block after the other, which are the same.
    """
    if popular and len(b) >= POPULAR_FROM:
        counts = Counter(b)
        if often := {c for c, n in counts.items() if n > len(b) // 100 + 1}:
            return _popular_blocks(a, b, often, sum(n * counts[c] for c, n in Counter(a).items() if c not in often))
    todo, out = [(0, len(a), 0, len(b), False)], []
    while todo:
        a0, a1, b0, b1, short = todo.pop()  # short: no run as long as the first seed is left
        if short and (a1 - a0) * (b1 - b0) <= MOST_CELLS:
            out += _short(a, b, (a0, a1, b0, b1), SEEDS[0] - 1)
            continue
        x, y, found, left, placed = a[a0:a1], b[b0:b1], [], [], False
        for seed in () if short else SEEDS:
            if (runs := _runs(x, y, seed)) is not None:
                found, left = _placed(x, y, runs, seed, set())
                short = seed == SEEDS[0]
                placed = short or bool(found)
                break
        if not placed:
            i, j, n = _longest(list(x), list(y))
            found, left = [(i, j, n)] if n else [], [f for f in ((0, i, 0, j), (i + n, len(x), j + n, len(y))) if n and f[0] < f[1] and f[2] < f[3]]
        out += [(a0 + i, b0 + j, n) for i, j, n in found]
        todo += [(a0 + f[0], a0 + f[1], b0 + f[2], b0 + f[3], short) for f in left]
    return sorted(out)


def _popular_blocks(a: str, b: str, often: set[str], pairs: int) -> list[tuple[int, int, int]]:
    """Blocks where only other characters than ``often`` start one; ``pairs`` of equal such characters there are."""
    if pairs <= MOST_PAIRS:
        out, left = _placed(a, b, _rare_runs(a, b, often), 1, often)
        for a0, a1, b0, b1 in left:  # without a start, what is equal from the corner on counts
            n = 0
            while a0 + n < a1 and b0 + n < b1 and a[a0 + n] == b[b0 + n]:
                n += 1
            if n:
                out.append((a0, b0, n))
        return sorted(out)
    left = [None if c in often else c for c in a]
    right = [(j,) if c in often else c for j, c in enumerate(b)]  # a frequent one equals nothing
    todo, out = [(0, len(a), 0, len(b))], []
    while todo:
        a0, a1, b0, b1 = todo.pop()
        i, j, n = _longest(left[a0:a1], right[b0:b1])
        i, j = a0 + i, b0 + j
        while i > a0 and j > b0 and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < a1 and j + n < b1 and a[i + n] == b[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
            if a0 < i and b0 < j:
                todo.append((a0, i, b0, j))
            if i + n < a1 and j + n < b1:
                todo.append((i + n, a1, j + n, b1))
    return sorted(out)


def similarity(a: str, b: str) -> float:
    """Twice the matching characters over all characters, with the usual treatment of popular ones in long texts; 1 for two empty texts."""
    return 2 * sum(n for _, _, n in blocks(a, b, popular=True)) / (len(a) + len(b)) if a or b else 1.0


def match_chars(text: str, tokens: list[str]) -> tuple[list[int | None], float]:
    """For each character the token that holds it, and the share of tokens that were met; re-synchronises after gaps."""
    owner = [k for k, token in enumerate(tokens) for _ in token]
    out: list[int | None] = [None] * len(text)
    for a, b, n in blocks(text, "".join(tokens)):
        out[a : a + n] = owner[b : b + n]
    return out, len({k for k in out if k is not None}) / len(tokens) if tokens else 0.0


def match_tokens(text: str, tokens: list[str]) -> tuple[list[tuple[int, int | None]], int]:
    """Walk the text with a pointer into the tokens: (position, token or None) for each step, and how many were met."""
    steps, at, k = [], 0, 0
    while at < len(text):
        hit = k < len(tokens) and text.startswith(tokens[k], at)
        steps.append((at, k if hit else None))
        at += len(tokens[k]) if hit else 1
        k += hit
    return steps, k


def aligned_tokens(text: str, tokens: list[str]) -> list[tuple[int, int, int]]:
    """(step, start, end) of each token that the walk of :func:`match_tokens` meets: its step, and where it stands in the text.

    A walk waits for its next token, so each one met is the first after the one before, and from the first that isn't in the
    rest of the text on none is met.
    """
    out, step, at = [], 0, 0
    for token in tokens:
        found = text.find(token, at) if at < len(text) else -1
        if found < 0:
            break
        step += found - at
        at = found + len(token)
        out.append((step, found, at))
        step += 1
    return out


def repair_punctuation(text: str, items: list[tuple[str, float, float]], owner: list[int | None] | None = None) -> tuple[str, int, int]:
    """Marks by measured pauses: a mid mark over almost no pause goes, a long pause without a mark gets a full-width comma.

    Gives the text and the numbers of deleted and inserted marks. What stands before the first and after the last
    matched character stays. ``owner`` is what :func:`match_chars` gave, if it is known.
    """
    if owner is None:
        owner, _ = match_chars(text, [t for t, _, _ in items])
    known = [i for i, k in enumerate(owner) if k is not None]
    if not known:
        return text, 0, 0
    out, deleted, inserted = [text[: known[0] + 1]], 0, 0
    for i, j in zip(known, known[1:]):
        between = text[i + 1 : j]
        pause = items[owner[j]][1] - items[owner[i]][2]
        mids, fins = [c for c in between if c in MID], any(c in FIN for c in between)
        if not fins and mids and pause < DELETE_BELOW:
            between = "".join(c for c in between if c not in MID)
            deleted += len(mids)
        elif not fins and not mids and pause > INSERT_ABOVE:
            between += "，"
            inserted += 1
        out += [between, text[j]]
    return "".join([*out, text[known[-1] + 1 :]]), deleted, inserted


def pair_in_order(texts: list[str], groups: list[str], least: float = 0.85) -> list[int]:
    """For each text the group it belongs to, both in order and without punctuation; groups may be left out."""
    out: list[int] = []
    for g, whole in enumerate(groups):
        if len(out) < len(texts) and similarity(texts[len(out)], whole) >= least:
            out.append(g)
    if len(out) != len(texts):
        raise ValueError(f"only {len(out)} of {len(texts)} texts have a group")
    return out
