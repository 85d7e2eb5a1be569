"""Evaluation aggregates (E01-E04, P11): was the judged document in the fused list?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_judgement(qrels: DataFrame, order_col: str = "line_no") -> DataFrame:
    """One expected document per question — the last line wins."""
    return qrels.groupBy("qid").agg(F.max_by("docid", order_col).alias("docid"))


def found_rank(topics: DataFrame, judged: DataFrame, fused: DataFrame) -> DataFrame:
    """E01 + E02: ``(qid, expected_docid, found_rank)``; rank NULL when absent,
    expected NULL when the question has no judgement."""
    t = topics.select("qid").join(judged.withColumnRenamed("docid", "expected_docid"), "qid", "left")
    f = fused.select("qid", F.col("docid").alias("expected_docid"), F.col("rank").alias("found_rank"))
    return t.join(f, ["qid", "expected_docid"], "left").select("qid", "expected_docid", "found_rank")


def status(found: DataFrame) -> DataFrame:
    """``found`` / ``not_in_top`` / ``no_judgement`` per question."""
    st = (F.when(F.col("expected_docid").isNull(), F.lit("no_judgement"))
          .when(F.col("found_rank").isNotNull(), F.lit("found")).otherwise(F.lit("not_in_top")))
    return found.select("qid", "expected_docid", "found_rank", st.alias("status"))


def accuracy(found: DataFrame, file_col: str = "file_pos") -> DataFrame:
    """E03 + E04: per file and overall (``file_pos`` NULL): hits, judged, accuracy %
    (NULL when nothing was judged)."""
    g = found.rollup(file_col).agg(
        F.count_if(F.col("found_rank").isNotNull()).cast("bigint").alias("hits"),
        F.count_if(F.col("expected_docid").isNotNull()).cast("bigint").alias("judged"))
    pct = F.try_divide(F.col("hits").cast("double"), F.col("judged").cast("double")) * F.lit(100.0)
    return g.withColumn("accuracy", F.round(pct, 2))
