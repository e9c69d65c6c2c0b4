"""Fitted operators: language and toxicity, on invented languages and insults."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import common, langid, toxicity
from tests.llm import helpers

SYLLABLES = {"aa": "ka to mi ru se no", "bb": "sch ein ung der ach zu", "cc": "que eau ou ai oi en"}
INSULTS = ["dolt", "nitwit", "blockhead", "scumbag"]


def made(lang, seed, n):
    r, s = random.Random(f"{lang}{seed}"), SYLLABLES[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_languages(spark):
    rows = [(k, made(lang, k, 40), lang) for lang in SYLLABLES for k in range(60)] + [(1, None, "aa"), (2, "xyz", None)]
    centroids = langid.fit(spark.createDataFrame(rows, "key long, text string, lang string"))
    assert set(centroids.languages) == set(SYLLABLES)
    test = [(k, made(lang, 1000 + k, 12), lang, *["z"] * 2, 1, 1, "z") for lang in SYLLABLES for k in range(30)]
    got = langid.identify(helpers.table(spark, test), centroids, out="found").collect()
    assert sum(r["found"]["lang_pred"] == r["lang"] for r in got) >= 85
    assert all(0 <= r["found"]["score"] <= 1 for r in got) and sum(r["found"]["rejected"] for r in got) == 0
    odd = {r["doc_id"]: r["found"] for r in langid.identify(helpers.table(spark), centroids, out="found").collect()}
    for k in (2, 3, 4, 10):
        assert (odd[k]["lang_pred"], odd[k]["score"], odd[k]["rejected"]) == ("und", 0.0, True)
    assert odd[6]["lang_pred"] in SYLLABLES


def test_languages_without_labels(spark):
    none = langid.fit(spark.createDataFrame([], "key long, text string, lang string"))
    assert {r["language2"]["lang_pred"] for r in langid.identify(helpers.table(spark), none, out="language2").collect()} == {"und"}


def _labelled():
    rng = random.Random(4)
    rows = []
    for k in range(400):
        text = helpers.prose(k, rng.randrange(20, 60))
        toxic = int(k % 5 == 0)
        if toxic:
            words = text.split()
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            text = " ".join(words)
        rows.append((k, text, toxic))
    return rows


def test_toxicity_held_out(spark):
    rows = _labelled()
    held = [r for r in rows if r[0] % 3 == 1]
    model = toxicity.fit(spark.createDataFrame([r for r in rows if r[0] % 3 != 1], "key long, text string, toxic int"))
    df = helpers.table(spark, [(k, t, *["z"] * 3, y, 1, "z") for k, t, y in held])
    got = toxicity.toxicity(df, model).collect()
    assert sum(r["toxicity"]["predicted"] == r["n"] for r in got) >= 0.97 * len(got)
    bent = {"you n.i.t.w.i.t there": 1, "a blockxhead here": 1, "alphas beta gammaing": 0}
    scored = toxicity.Scorer(model)([t.encode() for t in bent])
    assert scored["score"][0] > scored["score"][2] and scored["score"][1] > scored["score"][2]


def _telling(words=INSULTS):
    return {w: 20.0 for x in words for w in toxicity._words_of([x])[0]}


def _trained(rows):
    return toxicity.train(_telling(), [t.encode() for _, t, y in rows if y], [t.encode() for _, t, y in rows if not y])


def test_toxicity_of_digits():
    """Insults with look-alikes or inserted digits count, numbers and codes of clean texts don't."""
    rng = random.Random(8)
    model = _trained([(k, f"{t} v{k}.{rng.randrange(9)}.17 {rng.randrange(1, 90)}th {rng.randbytes(6).hex()} mp{k % 9}", y) for k, t, y in _labelled()])
    insults = [x.encode() for x in ("you n1tw1t there", "a n1twi7", "such n7i7t7w7i7t s", "a n2i2t2w2i2t", "nit4wit", "bl0ckh34d", "b1l1o1c1k1h1e1a1d")]
    assert toxicity.Scorer(model)(insults)["predicted"] == [1] * len(insults)
    clean = [x.encode() for x in ("v7.3.17", "12th", "1 2 3", "2024-01-03", "4711", "mp3", "a3f09c1d77be", rng.randbytes(6).hex())]
    assert toxicity.Scorer(model)(clean)["predicted"] == [0] * len(clean)


@pytest.fixture(scope="module")
def model():
    return _trained(_labelled())


def test_toxicity_across_gaps(model):
    """Insults broken by spaces, signs or single letters, with letters put in, and within sentences; not across sentences."""
    found = ["you nit wit there", "a block head", "n i t w i t", "n.i.t.w.i.t", "such a n-i-t-w-i-t!", "block,head", "nitxwit", "nittwit", "Alpha beta. Gamma NITWIT delta! Zeta."]
    assert toxicity.Scorer(model)([x.encode() for x in found])["predicted"] == [1] * len(found)
    assert toxicity.Scorer(model)([b"alpha betas", b"gammaing"])["predicted"] == [0, 0]
    apart = toxicity.read(["nit. wit.\nblock\nhead", "end"])[0]
    assert not any(len(w.a) for w in toxicity.windows(apart) if w.kind == toxicity.NEIGHBOURS)


def test_toxicity_in_long_runs(model):
    """An insult anywhere in a run without spaces is found, whatever joins the run; dashes in any number take no time."""
    rng = random.Random(9)
    words = helpers.prose(3, 300).split()
    for joint in ",/_":
        for at in (0, 150, 299):
            texts = [joint.join(words[:at] + more + words[at:]).encode() for more in ([], ["nitwit"])]
            assert toxicity.Scorer(model)(texts)["predicted"] == [0, 1]
    for at in (0, 401, 1203, 5000):
        signs = ["".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(n)) for n in (at, 600)]
        assert toxicity.Scorer(model)([x.join(signs).encode() for x in ("", "blockhead")])["predicted"] == [0, 1]
    glued = "x" * 401 + "blockhead" + "x" * 300
    assert toxicity.Scorer(model)([glued.encode(), glued.replace("blockhead", "").encode()])["predicted"] == [1, 0]
    start = time.perf_counter()
    toxicity.Scorer(model)([("intro " + "-" * 10_000 + "Title").encode(), (".-_*" * 50_000).encode()])
    assert time.perf_counter() - start < 1


def test_toxicity_of_long_texts(monkeypatch, model):
    """Parts of a long text overlap, so that nothing is lost where they meet."""
    monkeypatch.setattr(toxicity, "PORTION", 1000)
    words = helpers.prose(5, 600).split()
    for at in range(0, 600, 37):
        texts = [" ".join(words[:at] + more + words[at:]).encode() for more in ([], ["nit", "wit"])]
        assert toxicity.Scorer(model)(texts)["predicted"] == [0, 1]
    parts = [t for _, some in toxicity.portions(["y" * 5000]) for t in some]
    assert len(parts) > 4 and sum(map(len, parts)) > 5000


def test_toxicity_awkward_rows(spark):
    model = toxicity.fit(spark.createDataFrame(_labelled(), "key long, text string, toxic int"))
    rows = {r["doc_id"]: r["toxicity"] for r in toxicity.toxicity(helpers.table(spark), model).collect()}
    assert rows[2]["score"] == rows[3]["score"] and rows[2]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert toxicity.toxicity(helpers.table(spark, []), model).count() == 0


def test_toxicity_without_labels(spark):
    for rows in ([], [(1, "a b c", 1)], [(1, None, 0), (2, "x", None)]):
        model = toxicity.fit(spark.createDataFrame(rows, "key long, text string, toxic int"))
        assert toxicity.Scorer(model)([b"anything", None])["predicted"] == [0, 0]


def _plain_windows(text):
    """(kind, letters with their ends) of the windows of one text of small letters, spaces and full stops."""
    for sentence in re.split(r"[.?!](?=\s|$)|\n", text):
        words = re.findall("[a-z]+", sentence)
        for i in range(len(words)):
            for k in range(1, toxicity.SPELT + 1):
                x = "".join(words[i : i + k])
                if i + k <= len(words) and len(x) >= 3 and (k <= 3 or len(x) <= k + 3):
                    yield (0 if k == 1 else 1), "^" + x + "$"
            if len(words[i]) > toxicity.RUN:
                for n in toxicity.SLIDES:
                    yield from ((2, words[i][a : a + n]) for a in range(len(words[i]) - n + 1))


def _plain_vector(window):
    """Weights of its subsequences of three characters, by the definition of the kernel."""
    out, inner = {}, len(window.strip("^$"))
    for a, b, c in itertools.combinations(range(len(window)), 3):
        if c - a < toxicity.SPAN and not (window[a] == "^" and window[c] == "$"):
            key = window[a] + window[b] + window[c]
            out[key] = out.get(key, 0) + toxicity.DECAY ** (c - a + 1)
    edges = window[0] == "^"
    square = sum((j - 1) * toxicity.DECAY ** (2 * j + 2) * (max(0, inner - j) + (2 * (inner >= j) if edges else 0)) for j in range(2, toxicity.SPAN))
    return {k: v / square**0.5 for k, v in out.items()}


def _kernel(x, y):
    a, b = _plain_vector(x), _plain_vector(y)
    return sum(v * b.get(k, 0) for k, v in a.items())


def _plain(window):
    return "".join({62: "^", 63: "$"}.get(c, chr(96 + c)) for c in window)


def test_scores_are_those_of_the_unfolded_machine(model):
    """Kernels to the landmarks for each window of each sentence, the best of all, against the running sums."""
    marks = [_plain(x) for x in model.landmarks]
    for text in ("a nitwit here. blok head and", "the scumbagger of alphabetagammadelta", "n i t w i t s. it is", "gammaing alphas"):
        best, words = [toxicity.LOWEST] * 3, [toxicity.LOWEST] * 2
        for kind, window in set(_plain_windows(text)):
            margin = sum(a * _kernel(window, x) for a, x in zip(model.alpha, marks)) + model.bias[kind]
            best[kind] = max(best[kind], margin)
            words += [margin] * (kind == 0)
        want = [max(best), *sorted(words)[:-3:-1]]
        assert model.evidence([text])[:, 0] == pytest.approx(want, abs=1e-4)
        score = toxicity.Scorer(model)([text.encode()])["score"][0]
        assert score == pytest.approx(model.probability(max(want[0] - model.centre, want[2] - model.second)), abs=1e-3)


def test_two_weak_words_or_a_clear_one():
    """Parts of a text tell together what the whole text does; a word that comes back is one word."""
    model = toxicity.ToxicityModel(np.zeros(1), np.zeros(3), centre=2.0, second=1.0)
    found = np.full((3, 4), toxicity.LOWEST)
    toxicity.together(found, [0, 1, 1, 2, 2, 3], np.array([[2.5, 1.4, 1.4, 1.5, 1.4, 1.9], [2.5, 1.4, 1.4, 1.5, 1.4, 1.2], [0.1, -1.0, -2.0, 1.1, 0.0, 1.1]]))
    assert found.tolist() == [[2.5, 1.4, 1.5, 1.9], [2.5, 1.4, 1.5, 1.2], [0.1, -1.0, 1.4, 1.1]]
    assert (model.margin(found) >= 0).tolist() == [True, False, True, True]
    assert toxicity.ToxicityModel(np.zeros(1), np.zeros(3)).margin(found).max() == 2.5  # without a second threshold, the best window alone


def test_the_map_is_that_of_nystroem():
    """z(w) z(w') is k(w, L) K(L, L)**-1 k(L, w'), so the machine's margins come from weights in the landmarks' span."""
    marks = ["^nitwit$", "^dolt$", "^alphas$"]
    coded = [bytes({"^": 62, "$": 63}.get(c, ord(c) - 96) for c in x) for x in marks]
    model = toxicity.machine(coded[:2], coded[2:], [1.0, 1.0], coded)
    gram = np.array([[_kernel(a, b) for b in marks] for a in marks])
    margins = gram @ model.alpha + model.bias[0]
    assert model.of_instances(coded) == pytest.approx(margins, abs=1e-5) and margins[0] > 0.9 and margins[1] > 0.9 and margins[2] < -0.9


def test_cover_is_greedy():
    bags, known = [{b"a", b"b"}, {b"a"}, {b"a", b"c"}, {b"c"}, {b"d"}], {b"a": 3.0, b"b": 1.0, b"c": 2.0, b"d": 1.0}
    assert list(toxicity._cover(bags, known, 1, 1)) == [b"a", b"c", b"d"] and list(toxicity._cover(bags, known, 2, 1)) == [b"a"]


def test_samples_are_bounded(spark):
    """All ids null, or one row many times: no more rows than asked for come out, and some do."""
    same = spark.range(100_000).select(F.lit(7).cast("long").alias("key"), F.lit("a b c").alias("text"), F.lit(1).alias("toxic"))
    odd = spark.range(20_000).select(F.lit(None).cast("long").alias("key"), F.concat(F.lit("text "), "id").alias("text"), F.lit(0).alias("toxic"))
    sample = common.drawn(same.union(odd), "toxic", ["key", "text"], 100)
    assert [len(common.taken(sample, "toxic", k, 100)) for k in (0, 1)] == [100, 1] and sample.count() < 200
    again = common.drawn(odd.union(same).repartition(3), "toxic", ["key", "text"], 100)
    assert common.taken(sample, "toxic", 0, 100) == common.taken(again, "toxic", 0, 100)
    labels = toxicity.sampled_labels(same.union(odd.withColumn("key", F.col("text").substr(6, 9).cast("long"))), 1000)
    assert labels.where("toxic = 1").count() == 1 and 900 <= labels.where("toxic = 0").count() <= 1300
