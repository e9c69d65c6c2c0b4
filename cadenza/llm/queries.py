"""The registered queries: each operator over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import langid, secrets, toxicity
from cadenza.llm.bpe import bpe_round_trip
from cadenza.llm.common import crc32_mod
from cadenza.llm.decontaminate import find_items
from cadenza.llm.divergence import source_divergence
from cadenza.llm.licenses import license_scan
from cadenza.llm.near_dup import near_duplicates
from cadenza.llm.repetition import repetition_quality
from cadenza.llm.simhash import simhash_groups
from cadenza.llm.spelling import spelling_variants, vocabulary
from cadenza.llm.token_counts import token_counts
from cadenza.llm.urls import url_filter

TOKENIZER = "word_bpe_49k.json"
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", "doc_id", "text")


def op1_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words")
    return repetition_quality(_texts(spark, sf_dir)).select("doc_id", *(f"repetition.{c}" for c in columns))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_texts(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(_texts(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    n_tokens = (F.octet_length("bpe.ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", n_tokens, F.sha2("bpe.ids", 256).alias("ids_sha256"), F.sha2(F.encode("bpe.decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    held_out = crc32_mod(F.col("doc_id"), 3) == 1
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out)
    labels = toxicity.sampled_labels(labels.select(F.col("doc_id").alias("key"), "toxic"))
    labelled = docs.withColumnRenamed("doc_id", "key").join(labels, "key").select("text", "toxic")
    found = toxicity.toxicity(docs, toxicity.fit(labelled))
    return found.select("doc_id", held_out.alias("held_out"), "toxicity.score", "toxicity.predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(_texts(spark, sf_dir), _table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("leaks.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    listed = F.sha2(F.encode(F.array_join("leaks.items", ","), "UTF-8"), 256).alias("items_sha256")
    return found.select("doc_id", "leaks.n_words", n_hit.alias("n_hit"), F.size("leaks.items").cast("long").alias("n_items"), listed, (n_hit > 0).alias("contaminated"))


def secret_field(spark: SparkSession, sf_dir: str) -> secrets.SecretField:
    """Trained on ``documents``."""
    return secrets.fit(_texts(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_texts(spark, sf_dir), secret_field(spark, sf_dir)).withColumn("spans", F.col("secrets.spans"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    counts = [number(k) for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES).select("page_id", "url_rule.*")


def language_centroids(spark: SparkSession, sf_dir: str) -> langid.Centroids:
    """Fitted to the rows of ``documents`` that aren't held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang").where(crc32_mod(F.col("doc_id"), 5) != 0)
    return langid.fit(docs.select("text", "lang"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(_texts(spark, sf_dir), language_centroids(spark, sf_dir))
    held_out = (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "language.lang_pred", "language.score", "language.rejected")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(_texts(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = [F.array_join(f"licenses.{c}", ",").alias(c) for c in ("base_labels", "labels")]
    return license_scan(_texts(spark, sf_dir)).select("doc_id", "licenses.n_words", "licenses.n_base", "licenses.first_word", "licenses.last_word", *joined, "licenses.score")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return simhash_groups(_texts(spark, sf_dir)).select("doc_id", digits, "component_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(_texts(spark, sf_dir), slip=31)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents", "text", "lang", "source"))


def queries() -> dict:
    return {
        "op1_repetition_quality": op1_repetition_quality,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_bpe_round_trip": op3_bpe_round_trip,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_secret_scan": op6_secret_scan,
        "op7_url_filter": op7_url_filter,
        "op8_language_id": op8_language_id,
        "op9_token_counts": op9_token_counts,
        "op10_license_scan": op10_license_scan,
        "op11_simhash": op11_simhash,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_source_divergence": op13_source_divergence,
    }


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM d),
seen AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k FROM w, (VALUES (3), (8), (101)) s(n), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p) WHERE len(w) > n),
again AS (SELECT r, n, p FROM (SELECT *, count(*) OVER (PARTITION BY r, n, k) AS c FROM seen) WHERE c > 1),
cover AS (SELECT r, n, count(DISTINCT q) AS c FROM (SELECT r, n, unnest(range(p, p + n)) AS q FROM again WHERE n < 101) GROUP BY r, n),
counts AS (SELECT d.doc_id, d.r, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(x) - len(list_distinct(x)) AS BIGINT) AS n_dup_lines,
                  coalesce(a.c, 0) AS n_repeat_words, coalesce(b.c, 0) AS covered_words, EXISTS (SELECT 1 FROM again g WHERE g.r = d.r AND g.n = 101) AS too_long
           FROM d JOIN w ON w.r = d.r JOIN lines ON lines.r = d.r LEFT JOIN cover a ON a.r = d.r AND a.n = 3 LEFT JOIN cover b ON b.r = d.r AND b.n = 8),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, covered_words,
       NOT base_failed AND NOT too_long AND covered_words <= CAST(0.3 AS DOUBLE) * n_words AS kept FROM judged
"""

OP5_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item_id, CASE WHEN len(w) <= 10 THEN w ELSE w[p:p + 9] END AS k
        FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(k) AS n FROM win),
seen AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
         FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p) WHERE len(w) >= n),
hit AS (SELECT s.r, s.n, s.p, item_id FROM seen s JOIN (SELECT item_id, array_to_string(k, ' ') AS k FROM win) USING (k)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP2_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS k FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
e AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.k = b.k AND a.r < b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (WITH RECURSIVE t(a, b) AS (SELECT r, r FROM d UNION SELECT t.a, x.b FROM t JOIN both_ways x ON x.a = t.b) SELECT * FROM t)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id, coalesce(d.doc_id = min(o.doc_id), min(o.doc_id) IS NULL AND d.r = min(o.r)) AS kept
FROM d LEFT JOIN n ON n.r = d.r JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id
"""

OP7_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
      FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.rverdict, 'allow') AS verdict
FROM h LEFT JOIN (SELECT DISTINCT * FROM m WHERE k = 1) m ON m.page_id = h.page_id AND m.host = h.host AND m.path = h.path
"""

OP12_SQL = r"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, CAST(i AS BIGINT) AS x FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM bits WHERE k < 8),
tab AS MATERIALIZED (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
own AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run), '..'), lambda x: CAST('0x' || x AS BIGINT))),
                             lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM own, tab),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed) GROUP BY word HAVING sum(n) >= 2 AND length(word) >= 7),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT x.word, y.word AS other FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION SELECT c.word, w.word FROM cut c JOIN v w ON w.word = c.a || c.b UNION SELECT w.word, c.word FROM cut c JOIN v w ON w.word = c.a || c.b),
best AS (SELECT near.word, other, v.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) AS k FROM near JOIN v ON v.word = other),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form, CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best ON best.word = v.word AND k = 1),
ends AS (SELECT word, word AS at, form AS ahead FROM forms UNION ALL SELECT e.word, f.word, f.form FROM ends e JOIN forms f ON f.word = e.ahead)
SELECT f.word, f.form, e.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word AND e.ahead IS NULL
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT d.lang, d.source, coalesce(any_value(x.n), 0) AS n FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) x ON x.lang = d.lang AND x.source = d.source GROUP BY d.lang, d.source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.n + 5 * l.v)::HUGEINT AS BIGINT) AS p,
             CAST(1 + (1000000000 * (k.n + 5)::HUGEINT) // (l.n + 5 * l.v)::HUGEINT AS BIGINT) AS q
      FROM g JOIN kept k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY x.lang, x.source, y.source),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
               LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_repetition_quality": OP1_SQL, "op2_near_duplicates": OP2_SQL, "op5_decontamination": OP5_SQL, "op7_url_filter": OP7_SQL, "op12_spelling_variants": OP12_SQL, "op13_source_divergence": OP13_SQL}
