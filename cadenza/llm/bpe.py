"""Byte-pair encoding with word ends, by a segment tree over the ranks of adjacent pairs.

The leaves of the tree hold the merge rank of each symbol with its right
neighbour; the root yields the leftmost pair of lowest rank. A merge changes
three leaves, so a piece of m symbols takes O(m log m) steps, also a piece of
a hundred thousand characters without a space.

Texts are cut as the vocabulary file says: special tokens first, then NFC,
lower case, and the split pattern,
and each pre-token is encoded once and kept in a bounded cache.

Null counts as the empty text: no ids, decoded to the empty text. Repeated rows are
encoded alike, an empty table stays empty. Of pairs of one rank the leftmost merges
first, as the root of the tree says.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame

from cadenza.llm.common import annotate

#: Entries of a worker's cache of pre-tokens; it starts anew when full.
CACHE = 250_000
_NEVER = 1 << 62

# Code points that the installed tokenizers library doesn't count as letters or numbers yet,
# and those that it lower-cases while Python's older tables don't (first, last, distance to the small letter).
NOT_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7"
    " 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2"
    " 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2"
    " 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NOT_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
SMALL = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
_SMALL = {c: chr(c + d) for first, last, d in SMALL for c in range(first, last + 1)}


def _ranges(points: str) -> str:
    return "".join("-".join(f"\\U{int(x, 16):08X}" for x in p.split("-")) for p in points.split())


_RARE = re.compile(f"[{_ranges(NOT_LETTERS)}{_ranges(NOT_NUMBERS)}]").search
_CAPITAL = re.compile("[" + "".join(map(chr, _SMALL)) + "]").search


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or 256 and up in order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Merge the leftmost pair of lowest rank until no pair has one.

    ``ranks`` has the rank of the pair (a, b) under ``a << 20 | b``; ``merged`` the symbol that each rank makes.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length()
    get = ranks.get
    tree = [_NEVER] * (2 * size)
    for i in range(n - 1):
        r = get(symbols[i] << 20 | symbols[i + 1])
        if r is not None:
            tree[size + i] = r << 32 | i
    for p in range(size - 1, 0, -1):
        a, b = tree[2 * p], tree[2 * p + 1]
        tree[p] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = symbols[:]
    while (least := tree[1]) != _NEVER:
        i = least & 0xFFFFFFFF
        j = after[i]
        k = after[i] = after[j]
        now = symbols[i] = merged[least >> 32]
        symbols[j] = -1
        changed = [(i, _NEVER)]
        if k < n:
            before[k] = i
            r = get(now << 20 | symbols[k])
            changed = [(i, _NEVER if r is None else r << 32 | i), (j, _NEVER)]
        elif j < n - 1:
            changed.append((j, _NEVER))
        if (h := before[i]) >= 0:
            r = get(symbols[h] << 20 | now)
            changed.append((h, _NEVER if r is None else r << 32 | h))
        for leaf, value in changed:
            p = size + leaf
            if tree[p] == value:
                continue
            tree[p] = value
            while p > 1:
                other = tree[p ^ 1]
                if other < value:
                    value = other
                p >>= 1
                if tree[p] == value:
                    break
                tree[p] = value
    return [s for s in symbols if s >= 0]


class PairRanks:
    """Merge ranks of many pairs at once; ``1 << 40`` where a pair has none."""

    NONE = 1 << 40

    def __init__(self, ranks: dict[int, int], merged: list[int]):
        keys = np.fromiter(ranks, np.int64, len(ranks))
        by = np.argsort(keys)
        self.keys, self.ranks = keys[by], np.fromiter(ranks.values(), np.int64, len(ranks))[by]
        self.merged = np.array(merged, np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(left.shape, self.NONE)
        key = np.where((left < 0) | (right < 0), -1, left << 20 | right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)


def merge_all(pieces: np.ndarray, pairs: PairRanks) -> np.ndarray:
    """:func:`merge` for many short pieces side by side, each with a segment tree of its own.

    Row i of ``pieces`` holds the i-th symbol of each piece, or -1. Changed in place; -1 where a symbol is gone.
    """
    m, n = pieces.shape
    if m < 2:
        return pieces
    shift = m.bit_length()
    size = 1 << (m - 2).bit_length()
    never = pairs.NONE << shift
    tree = np.full((2 * size, n), never, np.int64)
    leaf = (pairs.of(pieces[:-1], pieces[1:]) << shift) | np.arange(m - 1)[:, None]
    tree[size : size + m - 1] = np.where(leaf >= never, never, leaf)
    for p in range(size - 1, 0, -1):
        np.minimum(tree[2 * p], tree[2 * p + 1], out=tree[p])
    after = np.repeat(np.arange(1, m + 2, dtype=np.int64)[:, None], n, 1)  # row m: no symbol
    before = np.repeat(np.arange(-1, m, dtype=np.int64)[:, None], n, 1)
    live = np.flatnonzero(tree[1] < never)
    while len(live):
        least = tree[1, live]
        i = least & ((1 << shift) - 1)
        now = pairs.merged[least >> shift]
        j = after[i, live]
        k = np.minimum(after[j, live], m)
        h = before[i, live]
        after[i, live] = k
        before[k, live] = i
        pieces[j, live] = -1
        pieces[i, live] = now
        right = np.where(k < m, pieces[np.minimum(k, m - 1), live], -1)
        left = np.where(h >= 0, pieces[np.maximum(h, 0), live], -1)
        some = h >= 0
        for at, rank, rows in ((j, np.full(len(j), pairs.NONE), live), (i, pairs.of(now, right), live), (h[some], pairs.of(left, now)[some], live[some])):
            p = size + np.minimum(at, size - 1)  # the last symbol has no leaf; that of the one before is set next
            tree[p, rows] = np.where(rank == pairs.NONE, never, (rank << shift) | at)
            for _ in range(size.bit_length() - 1):
                p = p >> 1
                tree[p, rows] = np.minimum(tree[2 * p, rows], tree[2 * p + 1, rows])
        live = live[tree[1, live] < never]
    return pieces


class WordBpe:
    """A vocabulary file of the JSON kind: BPE with a word-end suffix over byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self._cut_common, latin = regex.compile(pattern).findall, pattern
        for kind in (r"\p{L}", r"\p{N}", r"\s"):  # the classes spelt out, for the faster module
            own = "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c)))
            latin = latin.replace(f"[{kind}]", f"[{own}]").replace(kind, own)
        self._cut_latin = re.compile(latin).findall
        for kind, points in ((r"\p{L}", NOT_LETTERS), (r"\p{N}", NOT_NUMBERS)):
            pattern = pattern.replace(kind, f"[{kind}--[{_ranges(points)}]]")
        self._cut_rare = regex.compile(pattern, regex.V1).findall
        self._cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        chars = byte_symbols()
        self._inner, self._last = [vocab[c] for c in chars], [vocab[c + end] for c in chars]
        self._ranks, self._merged = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            self._ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
            self._merged.append(vocab[a + b])
        self._pairs = PairRanks(self._ranks, self._merged)
        self._bytes = np.array([self._inner, self._last], np.int64)
        self.cache: dict[str, bytes] = {}

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        """The special tokens and the pre-tokens of a text; only their order among each other is kept."""
        special = []
        if any(s in text for s in self.special):
            parts = self._cut_special(text)
            special = parts[1::2]
            return special, [p for part in parts[::2] for p in self._cut(part)]
        return special, self._cut(text)

    def _cut(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if text.isascii():
            return self._cut_latin(text.lower())
        text = unicodedata.normalize("NFC", text)
        if _latin(text):
            return self._cut_latin(text.lower())
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()  # sigma: each character by itself
        if _CAPITAL(text):
            text = text.translate(_SMALL)
        return (self._cut_rare if _RARE(text) else self._cut_common)(text)

    def piece_ids(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        raw = piece.encode()
        inner = self._inner
        symbols = [inner[b] for b in raw]
        symbols[-1] = self._last[raw[-1]]
        return merge(symbols, self._ranks, self._merged)

    def learn(self, pieces: set[str]) -> None:
        """Encode pre-tokens that the cache lacks; short ones side by side."""
        if len(self.cache) + len(pieces) > CACHE:
            self.cache.clear()
        by_size: defaultdict[int, list[str]] = defaultdict(list)
        for piece in pieces.difference(self.cache):
            by_size[(len(piece.encode()) - 1).bit_length()].append(piece)
        for bits, some in by_size.items():
            if bits > 6:
                self.cache.update((p, np.array(self.piece_ids(p), "<u4").tobytes()) for p in some)
                continue
            raws = [p.encode() for p in some]
            size = np.array([len(r) for r in raws])
            block = np.full((len(raws), 1 << bits), -1, np.int64)
            block[np.arange(1 << bits) < size[:, None]] = self._bytes[0][np.frombuffer(b"".join(raws), np.uint8)]
            block[np.arange(len(raws)), size - 1] = self._bytes[1][[r[-1] for r in raws]]
            done = merge_all(np.ascontiguousarray(block.T), self._pairs).T
            kept = done >= 0
            flat = done[kept].astype("<u4").tobytes()
            ends = (4 * np.cumsum(kept.sum(1))).tolist()
            self.cache.update(zip(some, (flat[x:y] for x, y in zip([0, *ends], ends))))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        cut = []
        for text in texts:
            parts = self._cut_special(text) if any(s in text for s in self.special) else [text]
            cut.append([x if k % 2 else self._cut(x) for k, x in enumerate(parts)])
        self.learn({p for parts in cut for pieces in parts[::2] for p in pieces})
        get = self.cache.__getitem__
        return [b"".join([self.special[x].to_bytes(4, "little") if k % 2 else b"".join(map(get, x)) for k, x in enumerate(parts)]) for parts in cut]

    def sizes(self, pieces: list[str]) -> list[int]:
        """How many ids each pre-token has."""
        out = []
        for start in range(0, len(pieces), CACHE // 2):
            some = pieces[start : start + CACHE // 2]
            self.learn(set(some))
            out.extend(len(self.cache[p]) // 4 for p in some)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, special ones too; the file names no decoder, so a space joins them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def bpe_round_trip(docs: DataFrame, path: str, text_col: str = "text", out: str = "bpe") -> DataFrame:
    """``docs`` with struct ``out``: ids (binary, little-endian unsigned 32-bit) and the text decoded from them."""

    def start() -> Callable:
        bpe = load(path)

        def work(raws):
            ids = bpe.encode_all([(raw or b"").decode() for raw in raws])
            return {"ids": ids, "decoded": [bpe.decode(x) for x in ids]}

        return work

    return annotate(docs, text_col, "ids binary, decoded string", start, out)
