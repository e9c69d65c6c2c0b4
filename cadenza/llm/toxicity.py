"""Toxicity by a support vector machine over a string-subsequence kernel, trained on labelled sentences.

A text is a bag of sentences, and a sentence a bag of windows: each word, two or
three neighbouring words read as one (so spaces are gaps), runs of words of
hardly more than one letter, and, within runs of over ``RUN`` letters, every
window of ``SLIDES`` letters. Words are runs of letters, and of digits and signs
that stand for letters beside one; whatever else stands between is a gap. Words
with such digits are read once with them as letters and once without them.
Runs without any letter are no words.

The kernel of two windows sums, over all subsequences of three characters that
span five at most, the product of their weights in both; a weight is DECAY to
the power of the span, so gaps and inserted characters cost but don't break a
match. It is divided by the norms that the lengths of both windows give.
``LANDMARKS`` windows give the Nyström map z(w) = K(L, L)**-1/2 k(L, w), in which
a linear machine with hinge loss is trained. As k(L, w) is linear in the
subsequence weights of w, the machine folds into one weight for each
subsequence; sums of these weights over a text give the margins of all of its
windows at once, without a kernel for each landmark.

A sentence scores as its best window and a text as its best sentence, or, where toxic texts
mostly have several telling words, as the second best of its different words, for which the
threshold is lower: one weak word that stands in a clean text by chance isn't enough. Labels
mark whole texts, so training is on bags (MI-SVM): it starts from sentences with
telling words, which labelled toxic texts have far more often than clean ones;
then each turn takes as positive examples the best windows of the best sentence
of each toxic text that the machine finds, and as negative ones those windows of
clean sentences that score best, besides everyday words. Windows of several
words, and those within long runs, have a bias of their own, so that the many
more of them in clean texts stay below the threshold. Scores are a logistic of
the margin, with 0.7 in the gap between both kinds of training texts.

Fitting takes samples bounded by these parameters: ``sampled_labels`` about 30,000
rows of each label, whose words are all counted; of them ``most`` texts of each
label, of ``longest`` characters at most, whose sentences are looked at one by one;
``most_witnesses`` telling words, ``most_words`` words of clean texts. Within them a
machine is trained on ``EXAMPLES`` positive windows, those of most texts first, and
a start of ``EVERYDAY`` words, to which each turn adds ``HARD`` windows of each kind.

Null and empty texts have no word and get the lowest score. Repeated rows score
alike. Ties between windows, sentences or landmarks don't change a score. Without
labels of both kinds every text gets the lowest score; an empty table stays empty.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, annotate, drawn, raw_texts, slices, taken

DECAY, SPAN = 0.6, 5
LANDMARKS, TURNS = 192, 4
EXAMPLES, EVERYDAY, HARD = 4000, 4000, 1000
LEAST = 3  # letters of a window
RUN, SLIDES = 12, (5, 6, 7, 8, 10, 12, 14)
JOINED, SPELT = 3, 16  # words read as one: neighbours, and those of hardly more than one letter each
PORTION, OVERLAP = 1 << 19, 400  # characters that are looked at together; of a longer text, those that two portions share
HELD = 300_000
FIELDS = "score double, predicted int"
THRESHOLD = 0.7
LOWEST = -4.0  # the margin of a text without a window
SAME = 1e-6  # margins of one word at two places are nearer than that

WORD, NEIGHBOURS, WITHIN = 0, 1, 2  # kinds of windows

# Characters that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_OTHER, _START, _END = 61, 62, 63  # classes of other digits, and of both ends of a word; 0 is a gap
_TABLE = 0x250
_CLASS, _SURE = np.zeros(_TABLE, np.uint8), np.zeros(_TABLE, bool)
for _c in range(_TABLE):
    _x = LOOKALIKES.get(chr(_c), chr(_c))
    _SURE[_c] = chr(_c).isalpha()
    if "a" <= _x <= "z":
        _CLASS[_c] = ord(_x) - 96
    elif _x.isalpha():
        _CLASS[_c] = 27 + ord(_x) % 33
    elif chr(_c) in "0123456789":
        _CLASS[_c] = _OTHER
#: Signs beyond the table that part words: combining, general and CJK punctuation, full-width signs.
_APART = ((0x300, 0x36F), (0x2000, 0x206F), (0x3000, 0x303F), (0xFE00, 0xFE0F), (0xFE30, 0xFE4F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20))
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_CODES = 1 << 18


@dataclass
class Words:
    """Letters of some texts in a row, as classes; where each word starts and ends in them, its sentence and its text."""

    letters: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sentence: np.ndarray
    text: np.ndarray


@dataclass
class Windows:
    """Windows of one kind: their letters, and the words that they start and end with; their text and sentence."""

    kind: int
    a: np.ndarray
    b: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    text: np.ndarray
    sentence: np.ndarray


def read(texts: list[str]) -> tuple[Words, Words]:
    """The words of some texts; and those with digits or signs in them, read without these, each a sentence of its own."""
    low = "\0".join(texts).lower() + "\0"
    points = np.frombuffer(low.encode("utf-32-le"), "<u4")
    inside = points < _TABLE
    near = np.where(inside, points, 0)
    kind, sure = _CLASS[near], _SURE[near]
    if not inside.all():
        far = ~inside
        for lo, hi in _APART:
            far &= (points < lo) | (points > hi)
        kind[far], sure[far] = 27 + points[far] % 33, True
    after = np.r_[points[1:], np.uint32(0)]
    bang = points == 33
    kind[bang & ~np.r_[sure[1:], False]] = 0  # at the end of a word it is a mark
    space = np.zeros(33, bool)
    space[[0, 9, 10, 11, 12, 13, 32]] = True
    mark = (points == 46) | (points == 63) | bang
    ends = (points == 10) | (points == 13) | (points == 0) | (mark & space[np.minimum(after, 32)] & (after < 33)) | (points == 0x3002)
    some = kind > 0
    edges = np.flatnonzero(np.diff(np.r_[0, some.astype(np.int8), 0]))
    start, end = edges[::2], edges[1::2]
    letters = np.r_[0, np.cumsum(sure & some, dtype=np.int64)]
    n_sure = letters[end] - letters[start]
    good = n_sure > 0
    start, end, n_sure = start[good], end[good], n_sure[good]
    sentence, text = np.cumsum(ends, dtype=np.int32)[start], np.cumsum(points == 0, dtype=np.int32)[start]

    def cut(start, end, keep, sentence, text) -> Words:
        mask = np.zeros(len(points) + 1, np.int8)
        mask[start], mask[end] = 1, -1  # words are apart by a gap at least
        mask = (np.cumsum(mask[:-1], dtype=np.int8) > 0) & keep
        at = np.r_[0, np.cumsum(mask, dtype=np.int64)]
        return Words(kind[mask], at[start], at[end], sentence, text)

    mixed = n_sure < end - start
    whole = cut(start, end, some, sentence, text)
    return whole, cut(start[mixed], end[mixed], sure, np.arange(int(mixed.sum()), dtype=np.int32), text[mixed])


def windows(words: Words, several: bool = True) -> Iterator[Windows]:
    """All windows of ``LEAST`` letters or more."""
    first, last, n = words.first, words.last, len(words.first)

    def made(kind: int, head: np.ndarray, tail: np.ndarray) -> Windows:
        return Windows(kind, first[head], last[tail], head, tail, words.text[head], words.sentence[head])

    size = last - first
    at = np.flatnonzero(size >= LEAST)
    yield made(WORD, at, at)
    if not several:
        return
    for k in range(2, SPELT + 1):
        if n < k:
            break
        length = last[k - 1 :] - first[: n - k + 1]
        fits = (words.sentence[k - 1 :] == words.sentence[: n - k + 1]) & (length >= LEAST)
        if k > JOINED:
            fits &= length <= k + 3
        at = np.flatnonzero(fits)
        yield made(NEIGHBOURS, at, at + k - 1)
    long = np.flatnonzero(size > RUN)
    for length in SLIDES:
        count = size[long] - length + 1
        count = np.maximum(count, 0)
        which = np.repeat(long, count)
        a = first[which] + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        yield Windows(WITHIN, a, a + length, which, which, words.text[which], words.sentence[which])


def _norms(edges: bool, most: int = 4096) -> np.ndarray:
    """The norm of a window by its length, as if its subsequences were all different."""
    length = np.arange(most)
    total = np.zeros(most)
    for j in range(2, SPAN):
        total += (j - 1) * DECAY ** (2 * (j + 1)) * (np.maximum(length - j, 0) + (2 * (length >= j) if edges else 0))
    return np.sqrt(np.maximum(total, 1e-9))


_NORM = {True: _norms(True), False: _norms(False)}


def norm(length: np.ndarray, edges: bool) -> np.ndarray:
    table = _NORM[edges]
    top = len(table) - 1
    return table[np.minimum(length, top)] * np.sqrt(np.maximum(length, top) / top)


def instance(words: Words, w: Windows, k: int) -> bytes:
    """A window by itself: its letters, between both ends where it has them."""
    raw = words.letters[w.a[k] : w.b[k]].tobytes()
    return raw if w.kind == WITHIN else bytes([_START]) + raw + bytes([_END])


def features(instances: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, code, weight) of the subsequences of each instance, divided by its norm; a code may come several times."""
    flat = np.frombuffer(b"\0".join(instances), np.uint8).astype(np.int64)
    number = np.cumsum(flat == 0)
    number, kind = number[flat > 0], flat[flat > 0]
    edges = np.array([x[:1] == bytes([_START]) for x in instances], bool)
    length = np.array([len(x) for x in instances], np.int64) - 2 * edges
    norms = np.where(edges, norm(length, True), norm(length, False))
    out: list[list[np.ndarray]] = [[], [], []]
    for i, j in _STEPS:
        n = len(kind) - j
        if n > 0:
            at = np.flatnonzero((number[:n] == number[j:]) & ~((kind[:n] == _START) & (kind[j:] == _END)))
            for x, y in zip(out, (number[at], (kind[at] * 64 + kind[at + i]) * 64 + kind[at + j], DECAY ** (j + 1) / norms[number[at]])):
                x.append(y)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)  # type: ignore[return-value]


@dataclass
class ToxicityModel:
    """The machine, folded into weights of subsequences, with a bias for each kind of window; what it was folded from;
    ``centre`` and ``steep`` make margins into scores."""

    weights: np.ndarray
    bias: np.ndarray
    landmarks: list[bytes] = field(default_factory=list)
    alpha: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: float = 0.0
    second: float = math.inf
    steep: float = 4.0

    def of_instances(self, instances: list[bytes]) -> np.ndarray:
        """Margins of single windows, with the bias of words."""
        out = np.full(len(instances), self.bias[WORD], np.float64)
        for at in range(0, len(instances), 20_000):
            number, code, weight = features(instances[at : at + 20_000])
            part = out[at : at + 20_000]
            part += np.bincount(number, weight * self.weights[code], len(part))
        return out

    def margins(self, words: Words, several: bool = True) -> Iterator[tuple[Windows, np.ndarray]]:
        """All windows with their margins, from running sums of the weights."""
        x = words.letters.astype(np.int32)
        n = len(x)
        w = self.weights
        sums = {}
        starts, ends = {}, {}
        for j in range(2, SPAN):
            own = np.zeros(max(0, n - j))
            front, back = np.zeros(len(words.first)), np.zeros(len(words.first))
            head = np.minimum(words.first[:, None] + np.arange(j), n - 1)
            tail = np.maximum(words.last[:, None] - j + np.arange(j), 0)
            for i in range(1, j):
                if n > j:
                    own += w[(x[: n - j] << 12) | (x[i : n - j + i] << 6) | x[j:]]
                if n:
                    front += w[(_START << 12) | (x[head[:, i - 1]] << 6) | x[head[:, j - 1]]]
                    back += w[(x[tail[:, 0]] << 12) | (x[tail[:, i]] << 6) | _END]
            decay = DECAY ** (j + 1)
            total = np.zeros(n + 1)
            total[1 : len(own) + 1] = np.cumsum(own * decay)
            total[len(own) + 1 :] = total[len(own)]
            sums[j], starts[j], ends[j] = total, front * decay, back * decay
        for some in windows(words, several):
            length = some.b - some.a
            m = np.zeros(len(length))
            for j in range(2, SPAN):
                m += sums[j][np.maximum(some.b - j, some.a)] - sums[j][some.a]
                if some.kind != WITHIN:
                    m += np.where(length >= j, starts[j][some.head] + ends[j][some.tail], 0.0)
            yield some, m / norm(length, some.kind != WITHIN) + self.bias[some.kind]

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Of each text the best margin of all windows, that of its words, and that of its words other than the best one."""
        out = np.full((3, len(texts)), LOWEST)
        for words, several in zip(read(texts), (True, False)):
            for some, m in self.margins(words, several):
                np.maximum.at(out[0], some.text, m)
                if some.kind == WORD:
                    before = out[1].copy()
                    np.maximum.at(out[1], some.text, m)
                    other = m < out[1][some.text] - SAME
                    np.maximum.at(out[2], some.text[other], m[other])
                    out[2] = np.where(before < out[1] - SAME, np.maximum(out[2], before), out[2])
        return out

    def margin(self, evidence: np.ndarray) -> np.ndarray:
        """How far each text is beyond the threshold: by its best window, or by two different words that each are weaker."""
        return np.maximum(evidence[0] - self.centre, evidence[2] - self.second)

    def probability(self, margin: float) -> float:
        x = self.steep * margin + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def together(evidence: np.ndarray, at: list[int] | np.ndarray, more: np.ndarray) -> None:
    """Put the evidence of parts of texts, the numbers of these in ``at``, to what is known of them."""
    for k, i in enumerate(at):
        first, word, second = more[:, k]
        best = max(evidence[1, i], word)
        weaker = [x for x in (evidence[1, i], evidence[2, i], word, second) if x < best - SAME]
        evidence[:, i] = max(evidence[0, i], first), best, max(weaker, default=LOWEST)


def portions(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, or overlapping parts of long ones, of about ``PORTION`` characters together; their numbers and themselves."""
    owner: list[int] = []
    held: list[str] = []
    n = 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(len(text), at + PORTION)
            if end < len(text):  # between words, if there is a gap
                end = max(text.rfind(" ", end - OVERLAP, end), text.rfind("\n", end - OVERLAP, end)) + 1 or end
            owner.append(i)
            held.append(text[at:end])
            n += end - at
            if n >= PORTION:
                yield owner, held
                owner, held, n = [], [], 0
            if end == len(text):
                break
            gap = text.find(" ", end - OVERLAP, end - OVERLAP // 2)
            at = gap if gap >= 0 else end - OVERLAP
    if held:
        yield owner, held


class Scorer:
    """Scores of whole texts, some at a time."""

    def __init__(self, model: ToxicityModel):
        self.model = model

    def __call__(self, raws: list[bytes | None]) -> dict[str, list]:
        found = evidence_of(self.model, [(raw or b"").decode() for raw in raws])
        scores = [self.model.probability(m) for m in self.model.margin(found).tolist()]
        return {"score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]}


def _hinge(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps on the examples within the margin."""
    z1 = np.c_[z, np.ones(len(z))]
    ridge = np.r_[np.full(z.shape[1], 1e-5), 1e-9]
    w = np.zeros(z1.shape[1])
    loss = math.inf
    for _ in range(60):
        slack = np.maximum(0, 1 - y * (z1 @ w))
        now = float((cost * slack**2).sum() + 0.5 * (ridge * w * w).sum())
        if now > loss - 1e-9 * abs(loss):
            break
        loss = now
        some = slack > 0
        x = z1[some] * np.sqrt(2 * cost[some])[:, None]
        gradient = ridge * w - 2 * z1[some].T @ (cost[some] * y[some] * slack[some])
        step = np.linalg.solve(x.T @ x + np.diag(ridge), gradient)
        rate = 1.0
        while rate > 1e-4:  # a full step may go too far
            new = w - rate * step
            if (cost * np.maximum(0, 1 - y * (z1 @ new)) ** 2).sum() + 0.5 * (ridge * new * new).sum() <= now:
                break
            rate /= 2
        w = new
    return w[:-1], float(w[-1])


def machine(positive: list[bytes], negative: list[bytes], gain: list[float], landmarks: list[bytes]) -> ToxicityModel:
    """A machine on windows of both kinds, folded; ``gain`` has the weight of each positive one."""
    number, code, weight = features(landmarks)
    used, column = np.unique(code, return_inverse=True)
    dense = np.zeros((len(landmarks), len(used)), np.float32)
    np.add.at(dense, (number, column), weight)
    values, vectors = np.linalg.eigh((dense @ dense.T).astype(np.float64))
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])  # K(L, L)**-1/2 on its range
    place = np.full(_CODES, -1)
    place[used] = np.arange(len(used))

    def mapped(some: list[bytes]) -> np.ndarray:
        out = []
        for at in range(0, len(some), 1000):
            part = some[at : at + 1000]
            number, code, weight = features(part)
            known = place[code] >= 0
            x = np.bincount(number[known] * len(used) + place[code[known]], weight[known], len(part) * len(used)).astype(np.float32).reshape(len(part), -1)
            out.append(x @ dense.T)
        return np.concatenate(out) @ root

    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    pull = np.sqrt(np.array(gain, float))
    cost = np.r_[0.5 * pull / pull.sum(), np.full(len(negative), 0.5 / len(negative))]
    v, bias = _hinge(mapped(positive + negative), y, cost)
    alpha = root @ v
    weights = np.zeros(_CODES, np.float64)
    weights[used] = dense.T @ alpha
    return ToxicityModel(weights, np.full(3, bias), landmarks, alpha)


def _words_of(texts: list[str]) -> list[set[bytes]]:
    """The distinct words of each text, as windows."""
    out: list[set[bytes]] = [set() for _ in texts]
    ends = bytes([_START]), bytes([_END])
    for words in read(texts):
        raw = words.letters.tobytes()
        for t, a, b in zip(words.text.tolist(), words.first.tolist(), words.last.tolist()):
            if b - a >= LEAST:
                out[t].add(ends[0] + raw[a:b] + ends[1])
    return out


@dataclass
class _Found:
    """Of some texts: the best margins by kind, and the best windows of the best sentence of each text."""

    best: np.ndarray
    window: list[bytes | None]


class _Bags:
    """The words of texts, read once."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.parts = [(np.array(owner), words, several) for owner, some in portions(texts) for words, several in zip(read(some), (True, False))]

    def latent(self, model: ToxicityModel) -> _Found:
        """The window that stands for each text: the best word, or the best of neighbouring words, of its best sentence."""
        best, window = np.full((3, self.n), LOWEST), [None] * self.n
        for owner, words, several in self.parts:
            for w, m in model.margins(words, several):
                text = owner[w.text]
                before = best.max(0)
                top = np.full(self.n, LOWEST)
                np.maximum.at(top, text, m)
                if w.kind != WITHIN:
                    for k in np.flatnonzero((m > before[text]) & (m == top[text])).tolist():
                        window[text[k]] = instance(words, w, k)
                best[w.kind] = np.maximum(best[w.kind], top)
        return _Found(best, window)

    def hardest(self, model: ToxicityModel, most: int) -> list[bytes]:
        """Of each kind the ``most`` distinct windows that score best."""
        pool: list[dict[bytes, float]] = [{}, {}, {}]
        least = [-math.inf] * 3
        for _, words, several in self.parts:
            for w, m in model.margins(words, several):
                own = pool[w.kind]
                at = np.flatnonzero(m > least[w.kind])
                if len(at) > 2 * most:
                    at = at[np.argpartition(-m[at], 2 * most)[: 2 * most]]
                for k in at.tolist():
                    own[instance(words, w, k)] = float(m[k])
                if len(own) > 3 * most:
                    kept = heapq.nsmallest(most, own, key=lambda x: (-own[x], x))
                    pool[w.kind] = {x: own[x] for x in kept}
                    least[w.kind] = own[kept[-1]]
        return [x for own in pool for x in heapq.nsmallest(most, own, key=lambda x: (-own[x], x))]


def train(witnesses: dict[bytes, float], toxic: list[bytes], clean: list[bytes], others: list[bytes] = (), seed: int = 7) -> ToxicityModel:
    """A model from telling words, with the number of toxic texts that have each, texts of both labels, and other words of
    clean texts; words as :func:`_words_of` gives them."""
    nothing = ToxicityModel(np.zeros(_CODES), np.full(3, -1.0), centre=1e6, steep=1.0)
    toxic, clean = [x.decode() for x in toxic], [x.decode() for x in clean]
    ill, well = _Bags(toxic), _Bags(clean)
    bags = [b for _, some in portions(toxic) for b in _words_of(some) if b]
    clear: Counter[bytes] = Counter(w for _, some in portions(clean) for b in _words_of(some) for w in b)
    if not bags or not clear:
        return nothing
    known = {w: n for w, n in witnesses.items() if w not in clear}
    if not known:  # too few texts for counts to tell
        seen = Counter(w for b in bags for w in b if w not in clear and len(w) > LEAST + 2)
        known = {w: float(n) for w, n in seen.items()}
    least = 3 if len(bags) >= 200 else 1
    common = max(known.values(), default=0.0) / 10
    sure = _cover(bags, known, least, 1) | _cover(bags, {w: n for w, n in known.items() if n >= common}, least, 3)
    if not sure:
        return nothing
    rng = np.random.default_rng(seed)
    everyday = sorted(clear.keys() | set(others), key=lambda w: (-clear[w], w))
    many = min(len(everyday), EVERYDAY * 3 // 8)
    negatives = dict.fromkeys(everyday[:many] + [everyday[i] for i in rng.integers(0, len(everyday), EVERYDAY - many)])
    examples, hard = dict(sure), []
    for _ in range(TURNS):
        positive = sorted(examples, key=lambda w: (-examples[w], w))[:EXAMPLES]
        bent = {v: examples[w] / 8 for w in positive[:200] for v in _bent(w, rng) if v not in clear}
        half = LANDMARKS // 2
        pick = list(negatives)
        some = [pick[i] for i in rng.permutation(len(pick))[:half]]
        landmarks = positive[: half // 2] + [positive[i] for i in sorted(rng.permutation(len(positive))[: half // 2])] + (hard[: half // 2] + some)[:half]
        against = [w for w in negatives if w not in examples and w not in bent]
        model = machine(positive + sorted(bent), against, [examples[w] for w in positive] + [bent[w] for w in sorted(bent)], list(dict.fromkeys(landmarks)))
        own = model.of_instances(everyday)
        hard = [everyday[i] for i in np.argsort(-own, kind="stable")[:HARD]]
        negatives.update(dict.fromkeys(hard))
        negatives.update(dict.fromkeys(x for x in well.hardest(model, HARD) if x not in sure))
        found = ill.latent(model)
        chosen = Counter(x for x, m in zip(found.window, found.best.max(0).tolist()) if x is not None and m > 0.5 and x not in clear)
        more = sorted(known.keys() - sure.keys())
        alike = {w: known[w] for w, m in zip(more, model.of_instances(more).tolist()) if m > 0.5} if more else {}
        examples = {w: float(n) for w, n in chosen.items() if n >= least} | alike | sure
    low, high = well.latent(model).best, ill.latent(model).best
    model.centre, width = _threshold(np.sort(low[WORD]), np.sort(high[WORD]))
    few, many = (evidence_of(model, texts)[2] for texts in (clean, toxic))
    model.second, _ = _threshold(np.sort(few), np.sort(many))
    if (many >= model.second).mean() >= 0.5:  # toxic texts mostly have several such words, so that one alone must be a clear one
        model.centre = max(model.centre, float(np.sort(low[WORD])[-1 - len(clean) // 600]) + 0.05)
    else:
        model.second = math.inf
    for kind in (NEIGHBOURS, WITHIN):  # at most one clean text of 2,000 may lie above
        top = np.sort(low[kind])[-1 - len(clean) // 2000]
        model.bias[kind] -= max(0.0, float(top) - (model.centre - 0.15 * width))
    model.steep = 8 / max(0.4, width)
    return model


def evidence_of(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    """See :meth:`ToxicityModel.evidence`; of whole texts, whatever their length."""
    found = np.full((3, len(texts)), LOWEST)
    for owner, some in portions(texts):
        together(found, owner, model.evidence(some))
    return found


def _bent(window: bytes, rng: np.random.Generator) -> list[bytes]:
    """A word with a letter put in here and there, with one doubled, and with one between all."""
    letters = window[1:-1]
    if len(letters) < 4:
        return []
    out = [b"\x18".join(letters[i : i + 1] for i in range(len(letters)))]
    for at in rng.permutation(len(letters) - 1)[:4] + 1:
        out.append(letters[:at] + bytes([int(rng.integers(1, 27))]) + letters[at:])
    at = int(rng.integers(1, len(letters)))
    out.append(letters[:at] + letters[at - 1 : at] + letters[at:])
    return [window[:1] + x + window[-1:] for x in out]


def _cover(bags: list[set[bytes]], known: dict[bytes, float], least: int, times: int) -> dict[bytes, float]:
    """Words that together explain the bags: again and again the one that most of the bags left over have.
    A bag is left over until ``times`` words explain it.

    Words that only happen to stand in copies of a text are passed over, as a more common one explains those.
    Counts of bags left over only fall, so a word is counted anew when it comes to the top of the heap.
    """
    holders: dict[bytes, set[int]] = {}
    for i, bag in enumerate(bags):
        for w in bag & known.keys():
            holders.setdefault(w, set()).add(i)
    left, out = {i: times for i in range(len(bags))}, {}
    heap = [(-len(h), -known[w], w) for w, h in holders.items()]
    heapq.heapify(heap)
    while heap:
        n, rank, word = heapq.heappop(heap)
        now = len(holders[word] & left.keys())
        if now < least:
            continue
        if now < -n:
            heapq.heappush(heap, (-now, rank, word))
            continue
        out[word] = known[word]
        for i in holders[word] & left.keys():
            left[i] -= 1
            if not left[i]:
                del left[i]
    return out


def _threshold(low: np.ndarray, high: np.ndarray) -> tuple[float, float]:
    """Where margins of clean and toxic texts part best, a wrong clean text counting five times, nearer to the toxic ones; the width of that gap."""
    points = np.unique(np.r_[low, high])
    cuts = np.r_[points[0] - 0.5, (points[1:] + points[:-1]) / 2, points[-1] + 0.5]  # between edges[i] and edges[i + 1]
    wrong = 5 * (1 - np.searchsorted(low, cuts) / len(low)) + np.searchsorted(high, cuts) / len(high)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    edges = np.r_[points[0] - 1, points, points[-1] + 1]
    lower, upper = edges[best[0]], edges[best[-1] + 1]
    return float(lower + 0.65 * (upper - lower)), float(upper - lower)


def _word_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts of the task have each word."""
    held: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        words = list(held[0].keys() | held[1].keys())
        columns = [pa.array(words, pa.binary()), *(pa.array([held[k][w] for w in words], pa.int64()) for k in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "toxic", "clean"])

    for batch in slices(batches):
        labels = batch.column("toxic").to_pylist()
        bags: list[set[bytes]] = [set() for _ in labels]
        for owner, some in portions([raw.decode() for raw in raw_texts(batch)]):
            for k, found in zip(owner, _words_of(some)):
                bags[k] |= found
        for label, bag in zip(labels, bags):
            held[label].update(bag)
        if len(held[0]) + len(held[1]) > HELD:
            yield out()
            held[0].clear()
            held[1].clear()
    yield out()


def sampled_labels(labels: DataFrame, most: int = 30_000) -> DataFrame:
    """(key, toxic) of about ``most`` distinct rows of each label, and no more than a quarter above: bounded, so they are broadcast."""
    rows = labels.where("toxic in (0, 1) and key is not null").select("key", F.col("toxic").cast("int").alias("toxic"))
    return F.broadcast(drawn(rows, "toxic", ["key"], most).select("key", "toxic"))


def fit(labelled: DataFrame, most: int = 1600, longest: int = 200_000, most_witnesses: int = 4000, most_words: int = 150_000) -> ToxicityModel:
    """A model from (text, toxic) rows; their words are counted over all of them, other bounds are those of the module."""
    rows = labelled.where("text is not null and toxic in (0, 1)").select("text", F.col("toxic").cast("int").alias("toxic"))
    words = rows.mapInArrow(_word_labels, "word binary, toxic long, clean long")
    words = Scratch(labelled.sparkSession, "toxicity").write(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "words")
    sample = drawn(rows, "toxic", ["text"], most, longest)
    texts = {label: [r["text"].encode() for r in taken(sample, "toxic", label, most)] for label in (0, 1)}
    counts = rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    counts = {r["toxic"]: r["n"] for r in counts}
    ratio = (counts.get(0, 0) + 1) / (counts.get(1, 0) + 1)
    telling = words.where((F.col("toxic") >= 3) & (F.col("toxic") * ratio >= 20 * (F.col("clean") + 1)))
    top = telling.orderBy(F.desc("toxic"), "word").limit(most_witnesses)
    witnesses = {bytes(r["word"]): float(r["toxic"]) for r in top.collect()}
    usual = words.where("toxic = 0")
    n = max(1, usual.count())
    below = -(1 << 63) + min((1 << 64) - 1, int((1 << 64) * most_words / n))
    others = usual.where(F.xxhash64("word") <= below).select("word").limit(2 * most_words)
    return train(witnesses, texts[1], texts[0], [bytes(r["word"]) for r in others.collect()])


def toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the struct ``out``: score and predicted; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text_col, FIELDS, lambda: Scorer(shared.value), out)
