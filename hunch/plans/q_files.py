"""Queries for topic/judgement files (S08-S10): files are written from ``benchmark``
and the passage judgements into the shared folder, then read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index as X
from ..session import fresh_path
from ..sources import topics as TP
from ..sources.tables import passage_judgements, read_table
from .file_runs import run_files
from .q_search import _JUDGED, _sql
from .registry import register

_JUDGED_SQL = """judged AS (SELECT CAST(b.item_id AS VARCHAR) AS qid, max(CAST(d.doc_id AS VARCHAR)) AS docid
            FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY 1)"""


def _write_topics(spark, sf_dir, by_file: bool, query_id: str = "item_id"):
    """Topic JSONL from ``benchmark``; every fifth passage also gets an earlier draft line
    with the same id, which the later line must override. ``query_id``: a SQL expression over item_id."""
    b = read_table(spark, sf_dir, "benchmark")
    final = b.select("item_id", F.lit(1).alias("v"), F.col("text").alias("query"))
    draft = b.filter(F.col("item_id") % 5 == 0).select("item_id", F.lit(0).alias("v"),
                                                       F.concat(F.lit("draft: "), "text").alias("query"))
    lines = final.unionByName(draft).withColumn("file", F.concat(F.lit("q_"), (F.col("item_id") % 3).cast("string")))
    dealt = lines.repartition("file") if by_file else lines.repartitionByRange("item_id")
    out = dealt.sortWithinPartitions("file", "item_id", "v").select(
        "file", F.to_json(F.struct(F.expr(query_id).cast("string").alias("query_id"), "query")).alias("value"))
    path = fresh_path(spark, "topics")
    if by_file:
        out.write.partitionBy("file").text(path)
    else:
        out.select("value").write.text(path)
    return path


def _write_qrels(spark, sf_dir, without: str | None = None, query_id: str = "item_id"):
    """Judgement lines ``qid 0 docid 1`` per (passage, containing document), ordered by
    document within a passage, plus one three-field line per passage (skipped by the
    reader), and a leading tab on every other line. File ``r_i`` holds the passages of query
    file ``q_i``; ``without`` leaves one file out; ``query_id`` as for the topics."""
    idx = X.load_index(spark, sf_dir)
    j = passage_judgements(spark, sf_dir, idx.postings, idx.term_stats)
    own = F.expr(query_id).cast("string")
    good = j.withColumn("item_id", F.col("qid").cast("bigint")).select("qid", "docid", F.concat_ws(" ", own, F.lit("0"), "docid", F.lit("1")).alias("value"))
    bad = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("qid"), F.lit("").alias("docid"),
        F.concat_ws(" ", own, F.lit("0"), F.lit("x")).alias("value"))
    lines = good.unionByName(bad).withColumn("file", F.concat(F.lit("r_"), (F.col("qid").cast("bigint") % 3).cast("string")))
    lines = lines.withColumn("value", F.when(F.length("docid") % 2 == 0, F.concat(F.lit("\t"), "value")).otherwise(F.col("value")))
    if without:
        lines = lines.filter(F.col("file") != without)
    path = fresh_path(spark, "qrels")
    # The writer needs rows ordered by the partition column; leading the sort with it
    # keeps the line order inside each file exactly as written (no re-sort by the writer). One
    # task a file name, so that each is a single file, as judgement files are.
    lines.repartition("file").sortWithinPartitions("file", "qid", "docid").select("file", "value") \
        .write.partitionBy("file").text(path)
    return path


@register("topics_last_wins", "SELECT CAST(item_id AS VARCHAR) AS qid, text AS query FROM benchmark")
def topics_last_wins(spark, sf_dir):
    """S08 + V22: topics read back from JSONL; a repeated id keeps its last line."""
    t = TP.read_topics(spark, _write_topics(spark, sf_dir, by_file=False))
    return t.select("qid", "query")


@register("qrels_parse", f"WITH {_JUDGED_SQL} SELECT qid, docid, 1 AS rel FROM judged")
def qrels_parse(spark, sf_dir):
    """S09 + V21: judgement lines parsed back, short lines skipped, last line per id."""
    q = TP.read_qrels(spark, _write_qrels(spark, sf_dir))
    return q.select("qid", "docid", "rel")


_PAIRED_SQL = f"""WITH {_JUDGED_SQL}
SELECT (b.item_id % 3 + 1)::BIGINT AS file_pos, CAST(b.item_id AS VARCHAR) AS qid, j.docid AS expected_docid
FROM benchmark b LEFT JOIN judged j ON j.qid = CAST(b.item_id AS VARCHAR) WHERE b.item_id % 3 IN (0, 1)"""


@register("paired_files", _PAIRED_SQL)
def paired_files(spark, sf_dir):
    """Three query files paired by sorted name with two judgement files; the third
    query file has no partner and is ignored."""
    t = TP.read_topics(spark, _write_topics(spark, sf_dir, by_file=True))
    q = TP.read_qrels(spark, _write_qrels(spark, sf_dir, without="r_2"))
    return TP.pair_files(t, q)


_IN_FILE = "item_id DIV 3"  # ids count from 0 in each of the three files, so equal ids occur in all

_RUNS_SQL = f""", {_JUDGED},
runs AS (SELECT CAST(q.item_id % 3 + 1 AS BIGINT) AS file_pos, CAST(q.item_id // 3 AS VARCHAR) AS qid, found.expected_docid, found.found_rank
         FROM found JOIN benchmark q ON CAST(q.item_id AS VARCHAR) = found.qid WHERE q.item_id % 3 IN (0, 1))"""


def _file_runs(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        topics = TP.read_topics(spark, _write_topics(spark, sf_dir, by_file=True, query_id=_IN_FILE))
        qrels = TP.read_qrels(spark, _write_qrels(spark, sf_dir, without="r_2", query_id=_IN_FILE))
        _RUNS[key] = run_files(topics, qrels, X.load_index(spark, sf_dir))
    return _RUNS[key]


_RUNS: dict = {}


@register("file_runs_found", _sql(f"{_RUNS_SQL} SELECT file_pos, qid, expected_docid, found_rank FROM runs"))
def file_runs_found(spark, sf_dir):
    """S10 + E01 + E02: every question of two paired files that share ids, through lists, fusion and judgement."""
    return _file_runs(spark, sf_dir)["found"]


@register("file_runs_accuracy", _sql(f"""{_RUNS_SQL}
SELECT file_pos, count(found_rank)::BIGINT AS hits, count(expected_docid)::BIGINT AS judged,
       round(CASE WHEN count(expected_docid) > 0 THEN count(found_rank)::DOUBLE / count(expected_docid)::DOUBLE * 100.0 END, 2) AS accuracy
FROM runs GROUP BY ROLLUP (file_pos)"""))
def file_runs_accuracy(spark, sf_dir):
    """S10 + E03 + E04: accuracy per file pair and overall (file_pos NULL)."""
    return _file_runs(spark, sf_dir)["accuracy"]
