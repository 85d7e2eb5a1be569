"""Evaluation of a folder of query files against a folder of judgement files.

Questions of all file pairs run through one flow. Their key is ``file_pos:qid``, so equal
ids in two files stay two questions in lists, fusion and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators.index import Index
from ..session import cut_lineage
from ..sources.topics import paired_topics
from . import search as S


def run_files(topics: DataFrame, qrels: DataFrame, idx: Index, fl: S.Flavour = S.MAIN) -> dict:
    """``{'found', 'accuracy', 'results'}`` of the paired files of ``topics(file, qid, query)`` and
    ``qrels(file, qid, docid, rel)``: per question ``file_pos, qid, expected_docid, found_rank``;
    accuracy per pair and overall; the rendered results under ``file_pos, qid``. Questions
    without an id and files without a partner take no part."""
    runs = paired_topics(topics, qrels).filter("qid IS NOT NULL")
    runs = cut_lineage(runs.withColumn("run", F.concat_ws(":", "file_pos", "qid")), "runs")
    asked = runs.select(F.col("run").alias("qid"), "query")
    flow = S.search(asked, idx, fl)
    judged = runs.filter("expected_docid IS NOT NULL").select(F.col("run").alias("qid"), F.col("expected_docid").alias("docid"))
    found = _by_file(E.found_rank(asked, judged, flow["fused"]))
    return {"found": found, "accuracy": E.accuracy(found), "results": _by_file(flow["results"])}


def _by_file(df: DataFrame) -> DataFrame:
    """``df`` with its key ``file_pos:qid`` taken apart."""
    at = F.locate(":", F.col("qid"))
    return df.select(F.expr("substring_index(qid, ':', 1)").cast("bigint").alias("file_pos"), F.substring(F.col("qid"), at + 1, F.length("qid")).alias("qid"),
                     *(c for c in df.columns if c != "qid"))
