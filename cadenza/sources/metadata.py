"""Text files of a corpus: metadata, file lists, alignments, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = (
    "episode string, file string, n_seg_vad int, n_clusters int, main_cluster int, target_found boolean,"
    " spk_clusters map<string, struct<dur: double, n: int, ref_dist: double>>, kept int, dropped_asr int,"
    " segments array<struct<i: int, start: double, end: double, text: string, logprob: double, kept: boolean, cluster: int>>"
)


def first_pipe(line: Column) -> tuple[Column, Column]:
    """What stands before and behind the first pipe; without one, the second part is null."""
    parts = F.split(line, r"\|", 2)
    return parts[0], F.get(parts, F.lit(1))


def parse_metadata(lines: DataFrame, column: str = "line") -> DataFrame:
    sid, text = first_pipe(F.col(column))
    return lines.select(sid.alias("sid"), text.alias("text"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return parse_metadata(spark.read.text(path).withColumnRenamed("value", "line"))


def filelist_lines(meta: DataFrame, speaker: str, language: str = "ZH") -> DataFrame:
    """wavs/<sid>.wav|speaker|language|text; line breaks in texts become spaces."""
    text = F.regexp_replace("text", r"[\r\n]+", " ")
    return meta.select("sid", F.concat(F.lit("wavs/"), F.col("sid"), F.lit(f".wav|{speaker}|{language}|"), text).alias("line"))


def parse_filelist(lines: DataFrame) -> DataFrame:
    parts = F.split("line", r"\|", 4)
    return lines.select(F.regexp_extract(parts[0], r"([^/]*)\.wav$", 1).alias("sid"), parts[1].alias("speaker"), parts[2].alias("language"), F.get(parts, F.lit(3)).alias("text"))


def write_lines(lines: DataFrame, path: str) -> None:
    """(sid, line) as text, sorted by sid over all files; no single task writes everything."""
    lines.repartitionByRange("sid").sortWithinPartitions("sid").select("line").write.mode("overwrite").text(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(path, multiLine=True)


def report_segments(reports: DataFrame) -> DataFrame:
    """A row for each segment, in integer milliseconds; reports without segments have none."""
    s = reports.select(F.col("episode").alias("idx"), F.explode("segments").alias("s"))
    return s.select("idx", F.col("s.i").cast("long").alias("i"), F.round(F.col("s.start") * 1000).cast("long").alias("start_ms"), F.round(F.col("s.end") * 1000).cast("long").alias("end_ms"), F.col("s.text").alias("text"), F.col("s.kept").alias("kept"), F.col("s.cluster").alias("cluster"))


def read_alignments(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """id, text, items ARRAY<STRUCT<token, start, end>>; of repeated ids the last line counts.

    Items are JSON arrays of mixed types, so they are read as strings and cast. A corrupt line is an error, or is
    left out when not ``strict`` (to resume after a crash). Of files that :func:`append_alignments` wrote, later runs count
    as later lines.
    """
    lines = spark.read.text(path)
    run = F.col("run").cast("long") if "run" in lines.columns else F.lit(0)
    raw = lines.select(F.struct(run.alias("run"), F.monotonically_increasing_id().alias("line")).alias("n"), "value")
    kind = "id string, text string, items array<array<string>>"
    d = raw.select("n", F.from_json("value", kind, {"mode": "FAILFAST" if strict else "PERMISSIVE"}).alias("d")).where("d.id is not null")
    last = d.groupBy("d.id").agg(F.max_by("d", "n").alias("d"))
    item = F.transform("d.items", lambda x: F.struct(x[0].alias("token"), x[1].cast("double").alias("start"), x[2].cast("double").alias("end")))
    return last.select("d.id", "d.text", item.alias("items"))


def append_alignments(rows: DataFrame, path: str, run: int) -> None:
    """(id, text, items) as JSON lines of run ``run``, beside those of other runs; items are [token, start, end].

    A run that is written again replaces its own lines only, so a job that died half-way is simply repeated. What is left
    to do is :func:`cadenza.operators.removal.todo` against ``read_alignments(path, strict=False)``.
    """

    def quoted(c: Column) -> Column:
        """A JSON string; null stays null."""
        one = F.to_json(F.array(c))
        return F.when(c.isNotNull(), one.substr(F.lit(2), F.length(one) - 2))

    def item(x: Column) -> Column:
        parts = (F.coalesce(p, F.lit("null")) for p in (quoted(x["token"]), x["start"].cast("string"), x["end"].cast("string")))
        return F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))

    items = F.concat(F.lit("["), F.array_join(F.transform("items", item), ", "), F.lit("]"))
    fields = F.concat_ws(", ", *(F.concat(F.lit(f'"{n}": '), F.coalesce(v, F.lit("null"))) for n, v in (("id", quoted(F.col("id"))), ("text", quoted(F.col("text"))), ("items", items))))
    rows.select(F.concat(F.lit("{"), fields, F.lit("}")).alias("value")).write.mode("overwrite").text(f"{path}/run={run}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id a line; blank lines are ignored."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


def first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The first n ids in order: the selector's own limit."""
    return ids.select("id").distinct().orderBy("id").limit(n)
