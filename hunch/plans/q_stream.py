"""Streaming flow key."""

from __future__ import annotations

from ..operators import index as X
from ..session import fresh_path
from ..sources.tables import read_table
from ..streaming import search_stream as SS
from .q_search import _sql
from .registry import register


@register("search_stream", _sql("SELECT qid, docid, score, rank FROM fused"))
def search_stream(spark, sf_dir):
    """Passages read as a file stream, answered per micro-batch by the main flow;
    the written results are read back (same rows as ``search_main``)."""
    idx = X.load_index(spark, sf_dir)
    schema = read_table(spark, sf_dir, "benchmark").schema
    out = SS.run_search_stream(spark, SS.question_stream(spark, sf_dir, schema), idx, fresh_path(spark, "stream-out"))
    return spark.read.parquet(out).select("qid", "docid", "score", "rank")
