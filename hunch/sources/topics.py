"""Topic and judgement files.

Line order inside a file is kept as ``(file_path, file_block_start, row id)``: the row
id from ``monotonically_increasing_id`` grows with the position inside a split, so
"the last line wins" is an ordinary ``max_by`` per (file, qid) — no global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

TOPIC_SCHEMA = "query_id STRING, query STRING"


def _with_order(df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` with the ``file`` they came from and their order in it (a folder may add columns of
    any name, so only these are taken)."""
    return df.select(*cols, F.col("_metadata.file_path").alias("file"),
                     F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_ord"))


def read_topics(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """S08 + V22: ``(file, qid, query)``; a repeated id keeps its last line. Parsing is
    FAILFAST: a bad line raises, as the reference's reader does."""
    raw = spark.read.schema(TOPIC_SCHEMA).option("mode", "FAILFAST").option("pathGlobFilter", glob).json(path)
    t = _with_order(raw, "query_id", "query")
    return t.groupBy("file", F.col("query_id").alias("qid")).agg(F.max_by("query", "_ord").alias("query"))


def read_qrels(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """S09 + V21: ``(file, qid, docid, rel)`` from blank-separated lines; lines with fewer
    than four fields are skipped, the fourth is cast to INT (a bad value raises), and
    one document per question is kept — the last line's."""
    lines = _with_order(spark.read.option("pathGlobFilter", glob).text(path), "value")
    parts = F.split(T.strip(F.col("value")), r"[\s\p{Z}]+")
    p = lines.withColumn("_p", parts).filter(F.size("_p") >= 4)
    p = p.select("file", "_ord", F.col("_p")[0].alias("qid"), F.col("_p")[2].alias("docid"),
                 F.col("_p")[3].cast("int").alias("rel"))
    return p.groupBy("file", "qid").agg(F.max_by(F.struct("docid", "rel"), "_ord").alias("j")) \
        .select("file", "qid", "j.docid", "j.rel")


def paired_topics(topics: DataFrame, qrels: DataFrame) -> DataFrame:
    """``(file_pos, qid, query, expected_docid)``. The i-th query file (sorted by name) goes
    with the i-th judgement file; unmatched extra files are ignored. Equal ids in two files stay
    apart. Numbering the files is a window over one row a file."""
    qf = topics.select("file").distinct().withColumn("file_pos", F.row_number().over(Window.orderBy("file")))
    rf = qrels.select(F.col("file").alias("rfile")).distinct().withColumn("file_pos", F.row_number().over(
        Window.orderBy("rfile")))
    pairs = qf.join(rf, "file_pos")
    t = topics.join(pairs, "file")
    j = qrels.withColumnRenamed("file", "rfile").select("rfile", "qid", F.col("docid").alias("expected_docid"))
    return t.join(j, ["rfile", "qid"], "left").select(F.col("file_pos").cast("bigint"), "qid", "query", "expected_docid")


def pair_files(topics: DataFrame, qrels: DataFrame) -> DataFrame:
    """The pairing without the questions' texts."""
    return paired_topics(topics, qrels).drop("query")
