"""Every opN_ query over a whole table of awkward rows: contract columns, their types, and plain versions or SQL."""

import hashlib
import json
import math
import re
import zlib

import duckdb
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from cadenza.llm import langid, licenses, queries
from tests.llm import helpers
from tests.llm.test_search import _base

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
LONG = helpers.prose(77, 30)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, repeated rows, ties, very long texts and clashing names; the first two columns are read."""
    out = str(tmp_path_factory.mktemp("tables"))
    texts = [(i, t) for i, t, *_ in helpers.awkward()]
    texts += [(20, "my Password: 'hunter22' " + "ab12" * 9 + " AKIA" + "Q" * 16), (21, "cc by, CC-BY! All rights\nreserved"), (22, LONG + " " + helpers.prose(78, 60)), (22, LONG)]
    texts += [(30 + k, helpers.prose(k, 40) + (" dolt " if k % 3 == 0 else " ")) for k in range(60)] + [(100, "a b c d e f g h " * 40), (101, "x\n" * 90 + "# y\n"), (102, "  ")]
    rows = [(i, t, None if k % 7 == 0 else ("en", "de")[k % 2], "clash", 1, "clash", "clash") for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, row string")
    docs.write.parquet(f"{out}/documents.parquet")
    labels = [(i, 1, int("dolt" in (t or ""))) for i, t in texts if i is not None] + [(None, None, 1), (5, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, LONG), (2, "one"), (None, "x y"), (3, None), (1, LONG)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    urls = ["https://a.Example.ORG/es/1", None, "", "no url", "http://example.org/en/12?q#f", "http://m.com/fr/" + "p" * 50_000, "http://" + "a." * 9000 + "com/de/", "http://x.com/de/", "http://x.com/de/"]
    spark.createDataFrame([(k % 8, u, "<p>") for k, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{out}/pages.parquet")
    return out, texts


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder[0]}/{t}.parquet/*.parquet')")
    df = queries.queries()[name](spark, folder[0])
    columns = sorted(df.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, (tuple(r[i] for i in at) for r in want.fetchall())))


def _rows(spark, folder, name, schema):
    df = queries.queries()[name](spark, folder[0])
    assert dict(df.dtypes).items() >= dict(x.split(":") for x in schema.split()).items()
    rows = df.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in folder[1])
    return rows


def _matched(rows, folder, made):
    """The rows, in any order, are those that ``made`` gives for each text."""
    want = sorted(json.dumps([i, *made(t or "")]) for i, t in folder[1])
    columns = [c for c in rows[0].asDict() if c != "doc_id"]
    assert sorted(json.dumps([r["doc_id"], *(r[c] for c in columns)]) for r in rows) == want


def test_op3(spark, folder):
    rows = _rows(spark, folder, "op3_bpe_round_trip", "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string")

    def made(text):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        return len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), _sha(LIBRARY.decode(ids, skip_special_tokens=False))

    _matched(rows, folder, made)


def test_op4(spark, folder):
    rows = _rows(spark, folder, "op4_toxicity", "doc_id:bigint held_out:boolean score:double predicted:int")
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["predicted"] == by_id[3]["predicted"] == 0
    assert all(by_id[30 + k]["predicted"] == int(k % 3 == 0) for k in range(60))


def test_op6(spark, folder):
    rows = _rows(spark, folder, "op6_secret_scan", "doc_id:bigint n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string")
    texts = {}
    for i, t in folder[1]:
        texts.setdefault(i, []).append(t or "")
    for r in rows:
        assert any(
            [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in base) for k in ("assign", "access", "hex")]
            and r["base_sha256"] == _sha(",".join(f"{k}:{s}:{e}" for k, s, e in base)) and {f"{k}:{s}:{e}" for k, s, e in base} <= set(r["spans"].split(","))
            for base in map(_base, texts[r["doc_id"]])
        )


def test_op8(spark, folder):
    """Cosines to all centroids, feature by feature."""
    rows = _rows(spark, folder, "op8_language_id", "doc_id:bigint held_out:boolean lang_pred:string score:double")
    texts = {i: t for i, t in folder[1]}
    c = queries.language_centroids(spark, folder[0])
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 5 == 0)
        text = texts[r["doc_id"]]
        if r["doc_id"] in (5, 22, None):
            continue
        if not any(x.isalpha() for x in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        low = re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode()).strip()
        raw = b" " + b" ".join(low.split()) + b" "
        counts = {}
        for k in range(len(raw) - 2):
            b = ((raw[k] | raw[k + 1] << 8 | raw[k + 2] << 16) * 2654435761 % 2**32 >> 16) % langid.LanguageRules().buckets
            counts[b] = counts.get(b, 0) + 1
        x = {b: math.log1p(n) * float(c.idf[b]) for b, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        cos = [sum(v * float(c.vectors[b, k]) for b, v in x.items()) / norm for k in range(len(c.languages))]
        assert r["score"] == pytest.approx(max(cos), abs=1e-4)
        assert max(v for v, lang in zip(cos, c.languages) if lang == r["lang_pred"]) == pytest.approx(max(cos), abs=1e-4)


def test_op9(spark, folder):
    rows = _rows(spark, folder, "op9_token_counts", "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean")

    def made(text):
        n = len(LIBRARY.encode(text, add_special_tokens=False).ids)
        return len(text.encode()), n, n > 2048

    _matched(rows, folder, made)


def test_op10(spark, folder):
    rows = _rows(spark, folder, "op10_license_scan", "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string labels:string score:double")
    texts = {}
    for i, t in folder[1]:
        texts.setdefault(i, []).append(t)
    for r in rows:
        ok = False
        for t in texts[r["doc_id"]]:
            words = helpers.alnum_words(t)
            at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
            first, last = (min(at)[0], max(at)[0]) if at else (None, None)
            ok |= (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(words), len(at), first, last, ",".join(sorted({x for _, x in at})))
        assert ok and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_op11(spark, folder):
    from tests.llm.test_simhash import expected

    rows = _rows(spark, folder, "op11_simhash", "doc_id:bigint fingerprint:string component_id:bigint")
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in rows) == expected(folder[1])


def test_op12(spark, folder):
    from tests.llm.test_spelling import counted, expected

    df = queries.queries()["op12_spelling_variants"](spark, folder[0])
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert sorted(str(tuple(r)) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()) == expected(counted(folder[1]))


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string"), ("pages", "page_id long, url string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
