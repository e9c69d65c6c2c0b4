"""Transcripts: column functions, matching, repair."""

import difflib
import random
import time
import tracemalloc
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from cadenza.functions import matching
from cadenza.functions import text as tx
from cadenza.operators import text
from cadenza.operators import words as words_


def test_join_and_strip(spark):
    rows = [(["你好。", "再见"],), (["你好", "再见"],), (["你好，", "再见"],), (["　 你好\t", "", " ", "!x"],), ([],), (["a\n"],)]
    df = spark.createDataFrame(rows, "p array<string>")
    assert [r[0] for r in df.select(tx.join_texts(F.col("p"))).collect()] == ["你好。再见", "你好,再见", "你好，再见", "你好,!x", "", "a"]


def test_characters(spark):
    df = spark.createDataFrame([("你好，SUV 3。",), ("㐀鿿",), ("",), (None,)], "t string")
    t = F.col("t")
    got = [tuple(r) for r in df.select(tx.has_chinese(t), tx.strip_punct(t), tx.n_chars(t)).collect()]
    assert got == [(True, "你好SUV3", 6), (True, "㐀鿿", 1), (False, "", 0), (None, None, None)]
    marks = spark.createDataFrame([("，。",), ("：",), ("",), ("x",)], "t string")
    assert [r[0] for r in marks.select(tx.boundary(t)).collect()] == ["fin", "mid", "none", "none"]


def test_tail_marks(spark):
    df = spark.createDataFrame([("好。 ", True), ("好。", False), ("好！", True), ("。好", True)], "t string, f boolean")
    assert [r[0] for r in df.select(tx.tail_mark(F.col("t"), F.col("f"))).collect()] == ["好,", "好。", "好！", "。好"]


def test_characters_find_their_tokens():
    owner, cover = matching.match_chars("买SUV了", ["买", "SUV", "了"])
    assert owner == [0, 1, 1, 1, 2] and cover == 1.0
    owner, cover = matching.match_chars("看A I吧", ["看", "AI", "吧"])
    assert owner[0] == 0 and owner[-1] == 2 and owner[2] is None and cover == 1.0
    assert matching.match_chars("", []) == ([], 0.0)


def test_pointer_walk_does_not_resynchronise():
    steps, met = matching.match_tokens("a, bc d", ["a", "bc", "x", "d"])
    assert met == 2 and [k for _, k in steps if k is not None] == [0, 1]


def test_popular_characters_count_less_in_long_texts():
    a, b = "ab" * 150, "ba" * 150
    assert matching.similarity(a, b) == difflib.SequenceMatcher(None, a, b).ratio() < difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@pytest.mark.parametrize(("text_", "gap", "want"), [("你，好", 0.05, ("你好", 1, 0)), ("你，好", 0.10, ("你，好", 0, 0)), ("你好", 0.51, ("你，好", 0, 1)), ("你好", 0.50, ("你好", 0, 0)), ("你。好", 0.01, ("你。好", 0, 0)), ("“你，好”", 0.05, ("“你好”", 1, 0))])
def test_marks_follow_pauses(text_, gap, want):
    assert matching.repair_punctuation(text_, [("你", 0.0, 0.3), ("好", round(0.3 + gap, 6), 0.9)]) == want


def test_repair_outcomes(spark):
    item = [("你", 0.0, 0.2), ("好", 1.0, 1.2)]
    rows = [("a", "你好", "你好", item), ("b", "旧", None, None), ("c", "完全不同的话", "你好", item), ("d", "你好", "你好", [*item, ("很", 2.0, 2.1)]), ("e", "hi", "hi", [("h", 0.0, 0.1), ("i", 0.1, 0.2)])]
    df = spark.createDataFrame(rows, f"id string, old string, text string, items {text.ITEMS}")
    got = {r["id"]: (r["text"], r["outcome"]) for r in text.repair(df).collect()}
    assert got == {"a": ("你，好", "repaired"), "b": ("旧", "no_alignment"), "c": ("完全不同的话", "unlike"), "d": ("你好", "not_covered"), "e": ("hi", "unlike")}


def test_pairing_in_order():
    assert matching.pair_in_order(["abcd", "efgh"], ["abcd", "zzzz", "efgi", "efgh"], 0.9) == [0, 3]
    with pytest.raises(ValueError):
        matching.pair_in_order(["abcd", "efgh"], ["efgh", "abcd"])


def test_groups_without_a_manifest(spark):
    texts = spark.createDataFrame([(1, 0, "你好，世界。"), (1, 1, "再见！")], "idx int, n int, text string")
    groups = spark.createDataFrame([(1, 0, "你好世界"), (1, 1, "別的"), (1, 2, "再见")], "idx int, gid long, text string")
    assert sorted(tuple(r) for r in text.pair_groups(texts, groups).collect()) == [(1, 0, 0), (1, 1, 2)]


def test_blocks_equal_the_usual_matching():
    """Against difflib: popular characters, ties, repeats, short and long texts."""
    rng = random.Random(11)
    wide = " etaoinshrdlu" + "".join(map(chr, range(200, 420)))
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "abcdefgh", wide])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(rng.choice([8, 40, 420]))))
        b = "".join(c for c in a if rng.random() > 0.1) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randrange(rng.choice([8, 40, 420]))))
        for popular in (False, True):
            want = SequenceMatcher(None, a, b, autojunk=popular)
            marks = [[None] * len(a), [None] * len(a)]
            for out, found in zip(marks, (matching.blocks(a, b, popular), want.get_matching_blocks())):
                for i, j, n in found:
                    out[i : i + n] = range(j, j + n)
            assert marks[0] == marks[1]
        assert matching.similarity(a, b) == want.ratio()


def test_long_transcripts_take_seconds():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    words = [rng.choice(vocabulary) for _ in range(18_000)]
    start = time.perf_counter()
    owner, coverage = matching.match_chars("".join(words), ["#" if k % 7 == 6 else w for k, w in enumerate(words)])
    assert len(owner) > 90_000 and 0.85 < coverage < 0.87 and time.perf_counter() - start < 60


def test_tokens_met_on_the_way():
    rng = random.Random(13)
    for _ in range(500):
        text = "".join(rng.choice("ab，") for _ in range(rng.randrange(12)))
        tokens = ["".join(rng.choice("ab") for _ in range(rng.randrange(3))) for _ in range(rng.randrange(6))]
        steps, met = matching.match_tokens(text, tokens)
        got = matching.aligned_tokens(text, tokens)
        assert [(k, at) for k, (at, token) in enumerate(steps) if token is not None] == [(step, start) for step, start, _ in got] and len(got) == met


def test_words_of_alignments(spark):
    """Too unlike, too little met, too few words, no alignment, repeated and null texts."""
    items = lambda s: [(c, 0.1 * k, 0.1 * k + 0.05) for k, c in enumerate(s)]
    texts = {"a": "甲，乙。丙", "b": "甲乙丙", "c": "甲乙丙丁戊", "d": "甲", "e": "甲乙", "f": None}
    heard = {"a": ("甲乙丙", items("甲乙丙")), "b": ("完全不同", items("甲乙丙")), "c": ("甲乙丙丁戊", items("甲乙己丁戊")), "d": ("甲", items("甲")), "f": (None, None), "g": ("甲", items("甲"))}
    metadata = spark.createDataFrame(list(texts.items()), "sid string, text string")
    alignments = spark.createDataFrame([(s, t, i) for s, (t, i) in heard.items()], "sid string, text string, items array<struct<token: string, start: double, end: double>>")
    scored = words_.walked(metadata, alignments)
    assert {r["sid"]: (r["n_items"], r["aligned"]) for r in scored.collect()} == {"a": (3, 3), "b": (3, 3), "c": (5, 2), "d": (1, 1), "f": (0, 0)}
    rows = sorted(tuple(r) for r in words_.judged(metadata, alignments).collect())
    assert rows == [("a", 0, "甲", 0, 50, "，"), ("a", 2, "乙", 100, 150, "。"), ("a", 4, "丙", 200, 250, "")]
    assert {r["sid"]: r["n"] for r in words_.heard(metadata, alignments).groupBy("sid").count().withColumnRenamed("count", "n").collect()} == {"a": 3, "b": 3, "c": 5}
    assert words_.judged(metadata.where("false"), alignments).count() == 0


def _peak_mb(spark, monkeypatch, make):
    """MB of Python objects at most while a step runs over one batch of all its rows, and the rows it gives."""
    steps = []
    with monkeypatch.context() as m:
        for name in ("mapInArrow", "mapInPandas"):
            m.setattr(type(spark.range(1)), name, lambda self, run, schema, name=name: (steps.append((name, self, run)), self.sparkSession.createDataFrame([], schema))[1])
        make()
    [(name, rows, run)] = steps
    table = rows.coalesce(1).toArrow().combine_chunks().to_batches()
    inputs = (part if name == "mapInArrow" else part.to_pandas() for part in table)
    tracemalloc.start()
    n = sum(len(part) for part in run(inputs))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak, n


def _many_turns(spark):
    item = "named_struct('token', concat('w', id, '-', k), 'start', double(k), 'end', double(k))"
    return spark.range(2000).selectExpr("id", "'x' as text", "'y' as old", f"transform(sequence(1, 200), k -> {item}) as items")


def test_repair_holds_a_few_rows(spark, monkeypatch):
    peak, n = _peak_mb(spark, monkeypatch, lambda: text.repair(_many_turns(spark), chinese_only=False))
    assert n == 2000 and peak < 8, peak


def test_walks_hold_a_few_rows(spark, monkeypatch):
    turns = _many_turns(spark).withColumnRenamed("id", "sid")
    peak, n = _peak_mb(spark, monkeypatch, lambda: words_.walked(turns, turns))
    assert n == 2000 and peak < 8, peak


def test_usual_turns_need_no_automaton(monkeypatch):
    calls = []
    monkeypatch.setattr(matching, "_longest", lambda a, b: calls.append((len(a), len(b))) or (0, 0, 0))
    rng = random.Random(13)
    words = ["".join(rng.choice(["th", "er", "on", "tion", "re", "he"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    heard = ["#" if k % 7 == 6 else w for k, w in enumerate(words)]
    matching.match_chars(" ".join(words), heard)
    matching.similarity(" ".join(words), " ".join(heard))
    assert not calls
