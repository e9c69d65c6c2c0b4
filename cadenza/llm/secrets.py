"""Secret scans: base patterns, and a linear-chain conditional random field over the tokens of each line.

Tokens are runs of word characters (``A-Za-z0-9_+/.-`` and non-ASCII bytes) and
single delimiters. The field tags each as secret begin, inside or outside from
its shape (length, case, share of digits, changes of class, hexadecimal), the
words and delimiters around it, and a feature of the whole text. Viterbi decodes
line by line. A line whose every token is so unlikely to be secret that no path
but "all outside" can win keeps that path without decoding; the bound is exact.

The field is trained here: on windows of ``_WINDOW`` tokens around the lines of at
most ``sample`` texts, half of them with a base span that labels it, the others
without; on the same lines with generated secrets of other kinds put in
(access keys, hexadecimal and base64 strings, prefixed tokens); and with links, paths,
identifiers, versions and names that are no secrets. Texts with a base
span are sought among ``pool`` texts; both are drawn by a 64-bit hash of the text
from those of ``longest`` characters at most. These bounds hold for fitting only.

Null counts as the empty text: no spans. The base patterns' spans always stay;
the field adds those of its spans that overlap none. Spans are in code points,
end exclusive. Repeated rows have the same spans, and equal texts count once in
fitting; an empty table stays empty, and a field fitted to it still knows the
generated secrets. Of paths that score alike, Viterbi takes "outside" last.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, annotate, drawn, raw_texts, slices, taken

KINDS = ("assign", "access", "hex", "crf")
FIELDS = "spans array<struct<kind: string, start: long, end: long, secret: long>>"
# The base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Words that announce a secret, as parts of tokens.
KEYWORDS = (b"passw", b"pwd", b"secret", b"token", b"apikey", b"api_key", b"api-key", b"credential", b"bearer", b"private", b"auth", b"access_key", b"_key")

_SPACE, _WORD, _DELIMITER = 0, 1, 2
_TYPE = np.array([_SPACE if chr(b).isspace() and b < 0x80 else _WORD if b >= 0x80 or chr(b).isalnum() or chr(b) in "_+/.-" else _DELIMITER for b in range(256)], np.uint8)
_DELIMITERS = np.zeros(256, np.uint8)
for _k, _d in enumerate(b"=:\"'", 1):
    _DELIMITERS[_d] = _k
_FLAGS = {
    "digit": np.array([48 <= b < 58 for b in range(256)]),
    "upper": np.array([65 <= b < 91 for b in range(256)]),
    "lower": np.array([97 <= b < 123 for b in range(256)]),
    "hex": np.array([48 <= b < 58 or 97 <= b < 103 for b in range(256)]),
    "mark": np.array([chr(b) in "_+/.-" for b in range(256)]),
    "other": np.array([b >= 0x80 for b in range(256)]),
}
_CLASS = _FLAGS["digit"] * 1 + _FLAGS["upper"] * 2 + _FLAGS["lower"] * 3 + _FLAGS["mark"] * 4 + _FLAGS["other"] * 5
_LENGTHS = np.array([3, 6, 8, 12, 16, 20, 32, 64])
#: Values of each feature.
SIZES = (6, 9, 25, 48, 2, 14, 14, 7, 2, 4, 54, 72, 24, 12)


@dataclass
class Tokens:
    """Tokens of a buffer: byte offsets, the line of each, and their features."""

    start: np.ndarray
    end: np.ndarray
    line: np.ndarray
    features: np.ndarray


def tokenize(data: bytes, texts: np.ndarray) -> Tokens:
    """Tokens and features; ``texts`` has the offset where each text of the buffer starts."""
    b = np.frombuffer(data, np.uint8)
    kind = _TYPE[b]
    before = np.r_[np.uint8(_SPACE), kind[:-1]]
    start = np.flatnonzero((kind == _DELIMITER) | ((kind == _WORD) & (before != _WORD)))
    after = np.r_[kind[1:], np.uint8(_SPACE)]
    end = np.flatnonzero((kind == _DELIMITER) | ((kind == _WORD) & (after != _WORD))) + 1
    n = len(start)
    line = np.searchsorted(np.flatnonzero(b == 10), start)
    size = end - start
    word = kind[start] == _WORD

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flag, dtype=np.int32)]
        return total[end] - total[start]

    digit, upper, lower, hexes, mark = (count(_FLAGS[k][b]) for k in ("digit", "upper", "lower", "hex", "mark"))
    other = size - digit - upper - lower - mark
    c = _CLASS[b]
    change = np.r_[False, c[1:] != c[:-1]]
    total = np.r_[0, np.cumsum(change, dtype=np.int32)]
    changes = total[end] - total[np.minimum(start + 1, len(b))]

    low, key = data.lower(), np.zeros(n, bool)
    for name in KEYWORDS:
        at = low.find(name)
        while at >= 0:
            key[np.searchsorted(start, at, side="right") - 1] = True
            at = low.find(name, at + 1)

    sort = np.where(word, 0, 1 + _DELIMITERS[b[start]]).astype(np.int64)  # 0 word, 1 other delimiter, 2..5 = : " '
    share = np.where(digit == 0, 0, np.where(digit == size, 4, 1 + np.minimum(2, 4 * digit // np.maximum(size, 1))))
    case = np.where(other > 0, 4, np.where((upper > 0) & (lower > 0), 3, np.where(upper > 0, 2, np.where(lower > 0, 1, 0))))
    busy = np.searchsorted([1, 2, 4, 7, 12], changes, side="right")
    shape = busy * 8 + (hexes == size) * 4 + (mark > 0) * 2 + (size >= 20)
    around = sort * 2 + key

    def shifted(x: np.ndarray, by: int, empty: int) -> np.ndarray:
        """x of the token ``by`` places away; ``empty`` beyond the line."""
        at = np.arange(n) + by
        inside = (at >= 0) & (at < n)
        at = np.clip(at, 0, max(n - 1, 0))
        return np.where(inside & (line[at] == line), x[at], empty) if n else x

    near = shifted(key, -1, 0) | shifted(key, -2, 0) | shifted(key, -3, 0) | shifted(key, -4, 0)
    length = np.where(word, np.searchsorted(_LENGTHS, size, side="right"), 0)
    of_text = np.searchsorted(texts, start, side="right") - 1
    strange = np.bincount(of_text, (digit > 0) & (size >= 16) & (case != 4), len(texts)) / np.maximum(np.bincount(of_text, minlength=len(texts)), 1)
    file = np.searchsorted([0.0005, 0.01, 0.1], strange, side="right")[of_text] if n else np.zeros(0, int)
    both = np.minimum(length, 8) * 6 + np.minimum(share, 2) * 2 + near
    slash, dot, dash = (count(b == ord(x)) for x in "/.-")
    doubled = (size > 1) & (b[start] == ord("/")) & (b[np.minimum(start + 1, len(b) - 1)] == ord("/")) if n else np.zeros(0, bool)
    # what parts a token has: paths, links, versions and identifiers have many, and few changes of class within them
    parts = (np.minimum(slash, 2) * 3 + np.minimum(dot, 2)) * 8 + np.searchsorted([1, 2, 4], dash, side="right") * 2 + doubled
    restless = np.searchsorted([0.1, 0.2, 0.3, 0.4, 0.55], changes / np.maximum(size, 1), side="right")
    texture = np.where(word, restless * 4 + (slash > 0) * 2 + (size >= 20), 0)
    grouped = np.where(word, np.minimum(dash, 5) * 2 + (hexes + dash == size), 0)
    features = np.stack([sort, length, share * 5 + case, np.minimum(shape, 47), key, shifted(around, -1, 12), shifted(around, -2, 12), shifted(sort, 1, 6), shifted(key, -3, 0), file, both, parts, texture, grouped], 1)
    return Tokens(start, end, line, features.astype(np.int16))


@dataclass
class SecretField:
    """Weights of begin and inside for each value of each feature (outside is 0), and of each pair of tags."""

    weights: list[np.ndarray]
    pairs: np.ndarray  # from begin, inside, outside to the same; outside to inside can't be
    first: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 2))
        for g, w in enumerate(self.weights):
            out += w[features[:, g]]
        return out

    def decode(self, tokens: Tokens) -> list[tuple[int, int]]:
        """First and last token of each secret."""
        n = len(tokens.start)
        if not n:
            return []
        e = self.emissions(tokens.features)
        best = e.max(1)
        gain = max(0.0, float((self.pairs - self.pairs[2, 2]).max()), float((self.first - self.first[2]).max()))
        # A path with m tokens inside has 2m other pairs at most, so it can't win if each such token loses more.
        lines = np.unique(tokens.line[best > -2 * gain - 1e-9])
        found: list[tuple[int, int]] = []
        lo, hi = np.searchsorted(tokens.line, lines), np.searchsorted(tokens.line, lines, side="right")
        (bb, bi, bo), (ib, ii, io), (ob, _, oo) = self.pairs.tolist()
        fb, _, fo = self.first.tolist()
        for s, t in zip(lo.tolist(), hi.tolist()):
            rows = e[s:t].tolist()
            b, i, o = fb + rows[0][0], -1e18, fo
            back = []
            for eb, ei in rows[1:]:
                xb, yb, zb = b + bb, i + ib, o + ob
                xi, yi = b + bi, i + ii
                xo, yo, zo = b + bo, i + io, o + oo
                pb = 0 if xb >= yb and xb >= zb else 1 if yb >= zb else 2
                pi = 0 if xi >= yi else 1
                po = 2 if zo >= xo and zo >= yo else 0 if xo >= yo else 1
                back.append((pb, pi, po))
                b, i, o = max(xb, yb, zb) + eb, max(xi, yi) + ei, max(xo, yo, zo)
            tag = 2 if o >= b and o >= i else 0 if b >= i else 1
            if tag == 2 and all(p[2] == 2 for p in back):
                continue
            tags = [tag]
            for p in reversed(back):
                tag = p[tag]
                tags.append(tag)
            tags.reverse()
            k = 0
            while k < len(tags):
                if tags[k] == 2:
                    k += 1
                    continue
                j = k + 1
                while j < len(tags) and tags[j] == 1:
                    j += 1
                found.append((s + k, s + j - 1))
                k = j
        return found


def _hex_runs(raw: bytes) -> list[tuple[int, int]]:
    flag = _FLAGS["hex"][np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(np.r_[0, flag.astype(np.int8), 0]))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= LEAST["hex"]
    return list(zip(begin[long].tolist(), end[long].tolist()))


def base_spans(raw: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, where the secret itself starts) of the base patterns, in bytes."""
    out = []
    low = raw.lower()
    if any(name in low for name in _NAMES):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in raw:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", s, e, s) for s, e in _hex_runs(raw)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _labels(tokens: Tokens, spans: list[tuple[int, int]]) -> np.ndarray:
    """0 begin, 1 inside, 2 outside."""
    out = np.full(len(tokens.start), 2)
    for s, e in sorted(spans):
        inside = np.flatnonzero((tokens.start >= s) & (tokens.end <= e) | (tokens.start <= s) & (tokens.end >= e))
        inside = inside[out[inside] == 2]
        out[inside] = 1
        if len(inside):
            out[inside[0]] = 0
    return out


def generated(rng: random.Random) -> tuple[str, str]:
    """A secret and the text that announces it, maybe empty for shapes that speak for themselves."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    kinds = [
        lambda: some("0123456789abcdef", rng.choice((32, 40, 64))),
        lambda: some(letters + "+/", rng.randrange(28, 60)),
        lambda: some(letters, rng.randrange(20, 44)),
        lambda: rng.choice(("ghx_", "sk_live_", "pat-", "xkey-")) + some(letters, rng.randrange(24, 40)),
        lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16),
        lambda: some(letters, rng.randrange(8, 16)) + rng.choice("0123456789"),
    ]
    k = rng.randrange(len(kinds))
    name = rng.choice(("password", "passwd", "secret", "token", "api_key", "apikey", "auth_token", "private_key", "access_key", "client_secret", "bearer", "pwd", "credential"))
    lead = rng.choice((f"{name} = ", f"{name}=", f"{name}: ", f"{name}:", f'{name} = "', f"{name}='", f"{name} ", f'"{name}": "'))
    if k < 5 and rng.random() < 0.4:
        lead = ""
    return lead, kinds[k]()


def harmless(rng: random.Random) -> str:
    """A string that looks odd and is no secret: a link, a path, an identifier, a version, a name in code."""
    some = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"

    def name() -> str:
        """Letters in the order of words: consonants and vowels in turn, in some common spelling."""
        word = "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "s", "st"]) for _ in range(rng.randrange(1, 4)))
        return rng.choice((word, word, word, word.capitalize(), word.upper() if len(word) < 6 else word, word + rng.choice(digits)))

    def names(sign: str, low: int, high: int) -> str:
        return sign.join(name() for _ in range(rng.randrange(low, high)))

    host = lambda: names(".", 1, 3).lower() + rng.choice((".org", ".com", ".net", ".io", ".de", ".co.uk"))
    ending = lambda: rng.choice((".py", ".html", ".json", ".md", ".tar.gz", ".so", ".php", ".jpg", "", ""))
    uuid = lambda: "-".join(some("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))
    version = lambda: ".".join(str(rng.randrange(30)) for _ in range(rng.randrange(2, 5)))
    kinds = [
        lambda: rng.choice(("https://", "http://", "https://www.")) + host() + "/" + rng.choice((names("/", 1, 5), names("_", 1, 4), names("-", 2, 7))) + ending(),
        lambda: "https://" + host() + "/" + names("/", 1, 4) + f"?{name()}={rng.choice((name(), some(digits, 8)))}&{name()}={some(digits, 3)}#" + names("-", 1, 3),
        lambda: "https://" + host() + f"/{rng.randrange(1990, 2030)}/{rng.randrange(10, 13)}/" + names("-", 3, 9) + rng.choice(("", f"-{some(digits, 7)}")),
        lambda: rng.choice(("/", "./", "../", "~/", "/usr/", "/home/", "C:/")) + rng.choice((names("/", 2, 7), names("/", 1, 3) + version() + "/" + names("-", 1, 4))) + ending(),
        uuid, lambda: uuid().upper(), lambda: rng.choice(("urn:uuid:", "id ", "")) + uuid(),
        lambda: version() + rng.choice(("-", "+", "_", "-rc")) + rng.choice((names("-", 1, 3), names(".", 1, 3).upper(), some(digits, 8))) + rng.choice(("", "-" + some(digits, 8), ".post1")),
        lambda: names("_", 2, 6), lambda: names("_", 2, 6).upper(), lambda: "https://" + host() + "/" + some(small + small.upper() + digits + "_", rng.randrange(5, 13)), lambda: "".join(name().capitalize() for _ in range(rng.randrange(3, 6))), lambda: names("-", 3, 7), lambda: names(".", 3, 7),
        lambda: f"{some(digits, 4)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}:{some('012345', 2)}:{some('012345', 2)}" + rng.choice(("Z", ".000Z", "+00:00")),
        lambda: rng.choice(("978-", "ISBN 978-", "+49-", "DOI 10.")) + some(digits, 4) + rng.choice("-/") + some(digits, rng.randrange(4, 9)) + "-" + some(digits, 2),
        lambda: names(".", 1, 3).lower() + "@" + host(), lambda: some(small, rng.randrange(20, 45)) if rng.random() < 0.3 else names("", 4, 9).lower(),
        lambda: f"{name()}-{version()}-py3-none-any" + rng.choice((".whl", "", "_x86_64")),
    ]
    return rng.choice(kinds)()


_WINDOW = 40


@dataclass
class Examples:
    """Windows of tokens: features, labels, which places are taken, and whether the line has a base span."""

    features: np.ndarray
    labels: np.ndarray
    held: np.ndarray
    based: np.ndarray


def examples(texts: list[bytes], rng: random.Random) -> Examples:
    """Windows of lines of each text: two at random, the one of the longest token, and three with a base span; each as it
    is, around its longest token if it has no secret, with a generated secret, and with a :func:`harmless` string."""
    out = []
    for raw in texts:
        lines = [x for x in raw.split(b"\n") if x.strip()]
        longest = [max(lines, key=lambda x: max(map(len, x.split())))] if lines else []
        for line in rng.sample(lines, min(len(lines), 2)) + longest + [x for x in lines if base_spans(x)][:3]:
            for put in ("nothing", "secret", "harmless"):
                spans = [(s, e) for _, _, e, s in base_spans(line)]
                based, data, at = bool(spans), line, None
                if put != "nothing":
                    lead, piece = generated(rng) if put == "secret" else (rng.choice(("", "", "", "see ", "(", '"', "path = ", "url: ", "id=", "version: ")), harmless(rng))
                    at = rng.choice([m.start() for m in re.finditer(rb" ", line)] or [len(line)])
                    before = f" {lead}".encode()
                    close = rng.choice((b"", b'"', b".", b",")) if lead[-1:] not in ("'", '"') else lead[-1:].encode()
                    data = line[:at] + before + piece.encode() + close + line[at:]
                    at += len(before)
                    spans = [(x, y) for _, _, y, x in base_spans(data)]
                    if put == "secret" and not any(x < at + len(piece) and at < y for x, y in spans):
                        spans.append((at, at + len(piece)))
                tokens = tokenize(data, np.zeros(1, np.int64))
                y = _labels(tokens, spans)
                if not len(y):
                    continue
                marked = np.flatnonzero(y < 2)
                middle = int(marked[rng.randrange(len(marked))]) if len(marked) else int((tokens.end - tokens.start).argmax())
                if put == "harmless":
                    middle = min(int(np.searchsorted(tokens.start, at)), len(y) - 1)
                lo = max(0, min(middle - rng.randrange(5, _WINDOW - 5), len(y) - _WINDOW))
                if lo < len(y) and y[lo] == 1:
                    lo += 1
                if lo < len(y):
                    out.append((tokens.features[lo : lo + _WINDOW], y[lo : lo + _WINDOW], based))
    n, t = len(out), _WINDOW
    found = Examples(np.zeros((n, t, len(SIZES)), np.int64), np.full((n, t), 2), np.zeros((n, t), bool), np.array([x[2] for x in out], bool))
    for k, (f, labels, _) in enumerate(out):
        found.features[k, : len(labels)], found.labels[k, : len(labels)], found.held[k, : len(labels)] = f, labels, True
    return found


def _gradient(theta: np.ndarray, x: Examples, some: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Expected minus seen counts of some windows, by forward and backward sums over all of them at once."""
    size, t = int(offsets[-1]), _WINDOW
    feats, y, held = x.features[some] + offsets[:-1], x.labels[some], x.held[some]
    n = len(feats)
    w, pairs, first = theta[: 2 * size].reshape(2, size), theta[2 * size : 2 * size + 9].reshape(3, 3) + _NEVER, theta[2 * size + 9 :] + _NEVER_FIRST
    e = np.zeros((n, t, 3))
    for g in range(len(SIZES)):
        e[:, :, 0] += w[0][feats[:, :, g]]
        e[:, :, 1] += w[1][feats[:, :, g]]
    trans = np.exp(pairs)
    g = np.exp(e - e.max(2, keepdims=True))
    alpha = np.zeros((n, t, 3))
    alpha[:, 0] = np.exp(first) * g[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        new = (alpha[:, i - 1] @ trans) * g[:, i]
        alpha[:, i] = np.where(held[:, i, None], new / np.maximum(new.sum(1, keepdims=True), 1e-300), alpha[:, i - 1])
    beta = np.ones((n, t, 3))
    expected = np.zeros((3, 3))
    for i in range(t - 2, -1, -1):
        nxt = held[:, i + 1]
        into = g[:, i + 1] * beta[:, i + 1]
        joint = alpha[:, i, :, None] * trans * into[:, None, :]
        joint /= np.maximum(joint.sum((1, 2), keepdims=True), 1e-300)
        expected += joint[nxt].sum(0)
        b = into @ trans.T
        beta[:, i] = np.where(nxt[:, None], b / np.maximum(b.max(1, keepdims=True), 1e-300), beta[:, i + 1])
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(2, keepdims=True), 1e-300)
    out = np.zeros_like(theta)
    flat, own, tags = feats[held].reshape(-1), gamma[held], y[held]
    for k in (0, 1):
        weight = np.repeat(own[:, k] - (tags == k), len(SIZES))
        out[k * size : (k + 1) * size] = np.bincount(flat, weight, size)
    pair = held[:, 1:]
    out[2 * size : 2 * size + 9] = expected.reshape(-1) - np.bincount((y[:, :-1] * 3 + y[:, 1:])[pair], minlength=9)
    out[2 * size + 9 :] = gamma[:, 0].sum(0) - np.bincount(y[:, 0], minlength=3)
    return out / n


_NEVER = np.zeros((3, 3))
_NEVER[2, 1] = -1e4
_NEVER_FIRST = np.array([0, -1e4, 0])


def train(texts: list[bytes], steps: int = 160, seed: int = 3, batch: int = 400) -> SecretField:
    """Maximum likelihood by Adam over batches of windows of all texts; those with and those without a base span are in
    each batch in proportion to their number."""
    rng = random.Random(seed)
    x = examples(texts or [b"nothing to learn from"], rng)
    offsets = np.r_[0, np.cumsum(SIZES)]
    size = int(offsets[-1])
    theta = np.zeros(2 * size + 12)
    m = v = np.zeros_like(theta)
    order, at = np.zeros(0, np.int64), 0
    draw = np.random.default_rng(seed)
    for step in range(1, steps + 1):
        if at + batch > len(order):
            order, at = draw.permutation(len(x.based)), 0
        some = order[at : at + batch]
        at += batch
        gradient = _gradient(theta, x, some, offsets) + 1e-4 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        rate = 0.15 * min(1.0, 2 * (1 - (step - 1) / steps))
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w = theta[: 2 * size].reshape(2, size).T
    weights = [w[a:b].copy() for a, b in zip(offsets, offsets[1:])]
    return SecretField(weights, theta[2 * size : 2 * size + 9].reshape(3, 3) + _NEVER, theta[2 * size + 9 :] + _NEVER_FIRST)


def sampled_texts(docs: DataFrame, text_col: str = "text", sample: int = 1000, pool: int = 30_000, longest: int = 200_000) -> list[bytes]:
    """``sample`` texts at most, half of them with a base span; of each half no more than ``common.SAMPLE_CHARS`` characters in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            named = pa.array([bool(base_spans(raw)) for raw in raw_texts(batch)])
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("text"), named], names=["draw", "text", "named"])

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.lit(0).alias("kind")).where("text is not null")
    found = drawn(rows, "kind", ["text"], pool, longest).mapInArrow(run, "draw long, text string, named boolean")
    found = Scratch(docs.sparkSession, "secrets").write(found, "pool")
    return [r["text"].encode() for named in (True, False) for r in taken(found, "named", named, sample // 2)]


def fit(docs: DataFrame, text_col: str = "text", sample: int = 1000, pool: int = 30_000, longest: int = 200_000) -> SecretField:
    """A field from a bounded sample of the texts."""
    return train(sampled_texts(docs, text_col, sample, pool, longest))


def scan(raws: list[bytes | None], field: SecretField) -> list[list[dict]]:
    """All spans of each text, in code points, by start and kind."""
    texts = [raw or b"" for raw in raws]
    first = np.cumsum([0] + [len(x) + 1 for x in texts[:-1]])
    tokens = tokenize(b"\n".join(texts), first)
    added: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in field.decode(tokens):
        s, e = int(tokens.start[a]), int(tokens.end[b])
        k = int(np.searchsorted(first, s, side="right")) - 1
        added[k].append((s - int(first[k]), e - int(first[k])))
    out = []
    for raw, more in zip(texts, added):
        spans = base_spans(raw)
        new = [("crf", s, e, s) for s, e in more if not any(x[1] < e and s < x[2] for x in spans)]
        spans = sorted(spans + new, key=lambda x: (x[1], KINDS.index(x[0])))
        if spans and not raw.isascii():
            heads = [b & 0xC0 != 0x80 for b in raw]
            at = np.r_[0, np.cumsum(heads)].tolist()
            spans = [(k, at[s], at[e], at[v]) for k, s, e, v in spans]
        out.append([{"kind": k, "start": s, "end": e, "secret": v} for k, s, e, v in spans])
    return out


def find_secrets(docs: DataFrame, field: SecretField, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the struct ``out``: spans (kind, start, end, where the secret itself starts)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    return annotate(docs, text_col, FIELDS, lambda: lambda raws: {"spans": scan(raws, shared.value)}, out)


def redacted(text: str, spans: list[dict], mark: str = "[secret]") -> str:
    """The text with every secret itself replaced."""
    parts, at = [], 0
    for s, e in sorted((x["secret"], x["end"]) for x in spans):
        if e > at:
            parts += [text[at : max(s, at)], mark if s >= at else ""]
            at = e
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, field: SecretField, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with every secret itself replaced, and ``size_col``, if there, set anew where a text changed; one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 1 << 20):
            found = scan(raw_texts(batch, text_col), shared.value)
            if any(found):
                at = batch.schema.get_field_index(text_col)
                texts = [redacted(t, s) if s else t for t, s in zip(batch.column(at).to_pylist(), found)]
                columns = list(batch.columns)
                columns[at] = pa.array(texts, columns[at].type)
                if (k := batch.schema.get_field_index(size_col)) >= 0:
                    sizes = [len(t) if s else n for t, s, n in zip(texts, found, columns[k].to_pylist())]
                    columns[k] = pa.array(sizes, columns[k].type)
                batch = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            yield batch

    return docs.mapInArrow(run, docs.schema)
