"""A training-text pipeline: each stage works on all documents that the one before kept.

1. ``language``: documents that the language identifier rejects (no letter, or
   too far from every centroid) go.
2. ``near_duplicates``: one document of each group of near-duplicates stays.
3. ``decontaminate``: documents that hold a window of a benchmark item go.
4. ``secrets``: secrets are replaced by ``[secret]`` and ``n_chars`` follows the
   text; no document goes.
5. ``encode``: the ids of each document and the text decoded from them.

All stages but the last return the columns of ``documents``. Null texts and
texts without words are rejected by the first stage; an empty table stays empty.
Models are fitted to the tables in ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import langid, queries
from cadenza.llm.bpe import bpe_round_trip
from cadenza.llm.common import Scratch, fresh
from cadenza.llm.decontaminate import find_items
from cadenza.llm.near_dup import drop_near_duplicates
from cadenza.llm.secrets import redact_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = fresh("language", docs.columns)
    found = langid.identify(docs, queries.language_centroids(spark, sf_dir), out=out)
    return found.where(~F.col(f"`{out}`.rejected")).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = fresh("leaks", docs.columns)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return find_items(docs, benchmark, out=out).where(F.size(f"`{out}`.spans") == 0).drop(out)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs, queries.secret_field(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(docs.select("doc_id", "text"), public_tokenizers.path(queries.TOKENIZER))
    n_tokens = (F.octet_length("bpe.ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", n_tokens, F.col("bpe.ids").alias("ids"), F.col("bpe.decoded").alias("decoded"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("encode", encode)]

#: SQL can't express the fitted models of the first and the fourth stage, nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
