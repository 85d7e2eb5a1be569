"""Reciprocal Rank Fusion.

Input: ranked lists ``(qid, sub_ord, docid, rank)``. Every list is at most 100 long, so
the ``groupBy(qid, docid)`` aggregate and the per-question window see bounded groups;
the aggregate still combines map-side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def rrf_scores(lists: DataFrame, c: int = C.RRF_C_MAIN) -> DataFrame:
    """``(qid, docid, score, first_sub_ord, first_rank)``; score = sum of
    1/(c + rank) over the lists holding the document (rank counted from 1). The first
    position in list order is kept for the tie rule."""
    agg = lists.groupBy("qid", "docid").agg(
        F.sum(F.lit(1.0) / (F.lit(float(c)) + F.col("rank"))).alias("score"),
        F.min(F.struct("sub_ord", "rank")).alias("first"))
    return agg.select("qid", "docid", "score", F.col("first.sub_ord").alias("first_sub_ord"),
                      F.col("first.rank").alias("first_rank"))


def fused_top(scores: DataFrame, k: int = C.FUSED_DEPTH, places: int = 9) -> DataFrame:
    """Best ``k`` per question; ties go to the document met first (list order,
    then rank) — the order a stable sort of the insertion-ordered dict gives."""
    s = scores.withColumn("score", F.round("score", places))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("first_sub_ord").asc(),
                                          F.col("first_rank").asc())
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .withColumn("rank", F.col("rank").cast("bigint"))


def rrf(lists: DataFrame, c: int = C.RRF_C_MAIN, k: int = C.FUSED_DEPTH) -> DataFrame:
    """``(qid, docid, score, rank)`` fused top ``k``."""
    return fused_top(rrf_scores(lists, c), k).select("qid", "docid", "score", "rank")
