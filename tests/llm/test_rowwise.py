"""Operators that judge each row by itself, against plain versions."""

import hashlib
import itertools
import random
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import bpe, licenses, repetition, urls
from cadenza.llm.token_counts import token_counts
from tests.llm import helpers

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_repetition_matches_brute_force():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.choice((0, 1, 2, 7, 40, 90)))) for _ in range(30)]
    texts += ["x " * 50, "one two three four five six seven eight nine ten " * 3, "", helpers.prose(9, 120)]
    got = repetition.judge([t.encode() for t in texts], repetition.RepetitionRules())
    for k, t in enumerate(texts):
        assert (got["n_repeat_words"][k], got["covered_words"][k], got["longest_repeat"][k]) == helpers.repetition(t, 8)


def test_repetition_base_columns(spark):
    rows = [(1, "a\nb b\n\na\n \n# $ <x>\na", *["z"] * 3, 1, 1, "z"), (2, None, *["z"] * 3, 1, 1, "z")]
    got = {r["doc_id"]: r["repetition2"] for r in repetition.repetition_quality(helpers.table(spark, rows), out="repetition2").collect()}
    assert (got[1]["n_words"], got[1]["word_chars"], got[1]["n_symbols"], got[1]["n_dup_lines"]) == (8, 10, 4, 2)
    assert got[2]["n_words"] == 0 and got[2]["base_failed"] and not got[2]["kept"]


def test_repetition_keeps_prose_and_drops_loops():
    clean, loop = helpers.prose(3, 400), (helpers.prose(4, 25) + " ") * 12
    got = repetition.judge([clean.encode(), loop.encode()], repetition.RepetitionRules())
    assert got["kept"].tolist() == [True, False]


def test_bpe_awkward_rows(spark):
    df = bpe.bpe_round_trip(helpers.table(spark), PATH)
    for r in df.collect():
        want = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["bpe"]["ids"], "<u4").tolist() == want
        assert r["bpe"]["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("ab' <|>endofxΣσİéß\u0301\u1c89\ua7cb\x1c\x85 \n", max_size=60))
def test_bpe_is_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = bpe.load(PATH).encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want
    assert bpe.load(PATH).decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


def test_merging_side_by_side_is_merging_one_by_one():
    rng = random.Random(1)
    coder = bpe.load(PATH)
    pieces = {"".join(rng.choice("etaoinshrdl") for _ in range(rng.randrange(1, 70))) for _ in range(400)}
    coder.cache.clear()
    coder.learn(pieces)
    assert all(coder.cache[p] == np.array(coder.piece_ids(p), "<u4").tobytes() for p in pieces)


def test_bpe_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    coder = bpe.WordBpe(PATH)
    text = helpers.prose(7, 200)
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [200_000, 5, 0])
def test_token_counts(spark, most):
    got = token_counts(helpers.table(spark), PATH, max_broadcast=most, out="count").collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in helpers.awkward()]
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["count"]) for r in got) == sorted((i or -1, b, n) for i, b, n in want)
    assert {r["language"] for r in got} == {"clash"}


def test_empty_tables(spark):
    empty = helpers.table(spark, [])
    assert token_counts(empty, PATH).count() == 0
    assert bpe.bpe_round_trip(empty, PATH).count() == 0
    assert licenses.license_scan(empty).count() == 0
    assert repetition.repetition_quality(empty, out="r").count() == 0


def test_license_base_places():
    text = "CC-BY cc by CC BY all rights reserved. General Public License, all RIGHTS, reserved"
    got = licenses.scan(text.encode(), licenses.automaton())
    words = helpers.alnum_words(text)
    places = sorted(i for p in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"]) == (len(words), len(places), places[0], places[-1])
    assert got["base_labels"] == ["cc-by", "gpl", "reserved"] and got["score"] == 1.0


def test_license_rows(spark):
    rows = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(helpers.table(spark)).collect()}
    assert rows[2]["n_words"] == 0 and rows[2]["first_word"] is None and rows[2]["labels"] == [] and rows[2]["score"] == 0.0


def test_license_expressions():
    def value(e):
        return licenses.evaluate(licenses.read_expression(e)[0])

    assert value("MIT OR (Apache-2.0 AND GPL-3.0-only)") == ({"mit", "apache-2.0", "gpl-3.0-only"}, 0.2)
    assert value("GPL-2.0 WITH Classpath-exception-2.0 AND MIT") == ({"gpl-2.0", "mit"}, 0.4)
    assert value("MIT AND GPL-3.0 OR CC0-1.0")[1] == 0.1
    assert value("(MIT") == ({"mit"}, 0.2) and value("") == (set(), 0.0) and value("OR AND )") == (set(), 0.0) and value("MIT OR") == ({"mit"}, 0.2)
    got = licenses.scan(b"// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode", licenses.automaton())
    assert got["labels"] == ["apache-2.0", "mit"] and got["n_base"] == 0 and got["score"] == 0.2


def test_license_tags():
    """Tags in any spelling, known identifiers in prose, and none in other prose."""
    phrases = licenses.automaton()
    for text, labels in (
        ("SPDX_License_Identifier = (MIT OR Apache-2.0)", ["apache-2.0", "mit"]), ("spdx license identifier ISC", ["isc"]), ('"license-expression": "BSD-3-Clause AND MIT"', ["bsd-3-clause", "mit"]),
        ("Distributed under Apache-2.0 and gpl-3.0-or-later.", ["apache-2.0", "gpl-3.0-or-later"]), ("a license identifier is a word", []), ("mit dem Hund", []),
        ("SPDX-License-Identifier:\nMIT", []), ("SPDX-License-Identifier: LicenseRef-own", ["licenseref-own"]),
    ):
        got = licenses.scan(text.encode(), phrases)["labels"]
        assert [x for x in got if x not in ("apache-2.0", "gpl-3.0")] == [x for x in labels if x not in ("apache-2.0", "gpl-3.0")] and set(labels) <= set(got), text


def test_many_hits_and_long_hosts_take_linear_time():
    start = time.perf_counter()
    got = licenses.scan(b"all rights reserved cc by " * 200_000, licenses.automaton())
    assert got["n_base"] == 400_000 and (got["first_word"], got["last_word"]) == (0, 999_998)
    licenses.scan(b"SPDX-License-Identifier: MIT " * 50_000, licenses.automaton())
    file = urls.RuleFile(np.frombuffer(urls.pack([("org", "/", "allow"), ("b.example.org", "/x", "block")]), np.uint8))
    host = b"a." * 500_000 + b"b.example.org"
    assert file.string(file.match([(host, b"/xy")])[0]) == b"b.example.org/x" and file.match([(host + b".net", b"/")]) == [-1]
    assert time.perf_counter() - start < 5


def test_licence_lines_take_linear_time():
    """A hundred thousand tags on one line, with and without signs, and one expression of as many names."""
    phrases = licenses.automaton()
    for line in ("license-id:x or ", "license-id-x or ", "spdx-id x and ", "license id MIT or license-id-", "license id: mit with x and ( "):
        start = time.perf_counter()
        licenses.scan(line.encode() * 100_000, phrases)
        assert time.perf_counter() - start < 6, line
    start = time.perf_counter()
    names = [f"n{k}" for k in range(100_000)]
    got = licenses.scan(("SPDX-License-Identifier: " + " or ".join(names)).encode(), phrases)
    assert got["labels"] == sorted(names) and time.perf_counter() - start < 4
    text = b"license-id-foo or license-id-bar and license id: gpl-2.0-only or mit"
    assert licenses.scan(text, phrases)["labels"] == ["gpl-2.0-only", "mit"]
    assert licenses.evaluate(["a", "b", "c", "and", "with", "d", "or"]) == ({"a", "d"}, 0.25)


def test_base_places_by_brute_force():
    rng = random.Random(3)
    vocabulary = "cc by general public license all rights reserved x é1".split()
    phrases = licenses.automaton()
    for _ in range(200):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        got = licenses.scan(rng.choice(" ,-").join(words).encode(), phrases)
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert got["n_base"] == len(places) and got["base_labels"] == sorted({x for _, x in places})
        assert (got["first_word"], got["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))


def _intervals(words, least):
    """(length, occurrences) of the repeats that can't be longer: for each pair of places, what is equal from there on."""
    out = {}
    for i, j in itertools.combinations(range(len(words)), 2):
        k = 0
        while j + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        if k >= least:
            key = tuple(words[i : i + k])
            out.setdefault(key, {p for p in range(len(words) - k + 1) if tuple(words[p : p + k]) == key})
    return out


def test_verdicts_come_from_intervals():
    """Intervals, maximal ones, covered words and verdicts by brute force, on texts full of nested repeats."""
    rng = random.Random(6)
    rules = repetition.RepetitionRules(min_words=5, max_base_percent=100, min_repeat=3, max_covered=0.5, max_longest=9)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(40)] + [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(20)] + ["x " * 30]
    got = repetition.judge([t.encode() for t in texts], rules)
    for k, t in enumerate(texts):
        words = t.split()
        found = _intervals(words, 3)
        cover = {p + d for key, at in found.items() for p in at for d in range(len(key))}
        maximal = sum(len({words[p - 1] if p else (p,) for p in at}) > 1 for at in found.values())
        top = max(map(len, found), default=0)
        kept = len(words) >= 5 and len(cover) <= 0.5 * len(words) and top <= 9
        assert (got["covered_words"][k], got["longest_repeat"][k], got["n_maximal_repeats"][k], bool(got["kept"][k])) == (len(cover), top, maximal, kept)


def test_sha_columns(spark, tmp_path):
    from cadenza.llm import queries

    helpers.table(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op3_bpe_round_trip(spark, str(tmp_path)).collect():
        if r["doc_id"] in (2, 3):
            assert r["n_tokens"] == 0 and r["ids_sha256"] == hashlib.sha256(b"").hexdigest() == r["decoded_sha256"]


def test_clashing_columns_are_replaced(spark):
    """Results take the place of columns of their names; all others stay."""
    rows = [(1, "All rights reserved", "en", "x", "x", 1, 2, "x")]
    df = helpers.table(spark, rows)
    got = licenses.license_scan(df, out="Language").first()
    assert got["Language"]["n_base"] == 1 and got["repetition"] == "x" and len(got) == len(df.columns)
    assert token_counts(df, PATH, out="n").first()["n"] == 3
    assert repetition.repetition_quality(df).first()["repetition"]["n_words"] == 3
    with pytest.raises(ValueError):
        licenses.license_scan(df, out="TEXT")
