"""Rendered results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import joins as J


def attach_contents(fused: DataFrame, corpus: DataFrame) -> DataFrame:
    """Look the fused ids up in the raw store, without shuffling the store. Ids missing from
    the store get no row (ranks are fixed before, V17).

    The fused side is at most 50 rows per question. When it is small enough (rows and bytes
    counted) it is broadcast to an inner join, so the corpus is only scanned. Otherwise its
    distinct document ids are counted and broadcast as a semi-join filter on the corpus scan,
    so only the needed documents are shuffled; failing both, a plain shuffle join."""
    docs = corpus.select("docid", "contents")
    if J.fits_broadcast(fused):
        return docs.join(F.broadcast(fused), "docid")
    ids = fused.select("docid").distinct()
    if J.fits_broadcast(ids):
        docs = docs.join(F.broadcast(ids), "docid", "left_semi")
    return fused.join(docs, "docid")


def render(fused: DataFrame, corpus: DataFrame, topics: DataFrame) -> DataFrame:
    """``(qid, rank, docid, score, score_text, title, snippet)``. The rank is the
    fused rank, fixed before documents missing from the store are skipped (V17)."""
    j = attach_contents(fused, corpus).join(topics.select("qid", "query"), "qid")
    j = j.filter(F.col("contents").isNotNull())
    j = T.with_snippet(j, "contents", "query")
    return j.select("qid", "rank", "docid", "score", T.score_text("score").alias("score_text"),
                    T.title_of("contents").alias("title"), "snippet")
