"""Sinks (S04-S07, S12, S13). Every writer takes a target path; paths for scratch
output come from ``hunch.session.fresh_path`` (the shared checkpoint folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C

RUN_TAG = "hunch"


def write_chunks(lines: DataFrame, path: str, mode: str = "ignore") -> None:
    """One output folder per chunk (``chunk_no=n``), lines in input order inside.
    The chunk number is the partition directory; the file name is Spark's."""
    lines.repartition("chunk_no").sortWithinPartitions("line_no") \
        .select("chunk_no", "value").write.mode(mode).partitionBy("chunk_no").text(path)


def write_converted_jsonl(docs: DataFrame, path: str, mode: str = "ignore") -> None:
    """S05 + S06: ``{"id": ..., "contents": ...}`` lines; ``mode='ignore'`` skips the
    stage when the output already exists (build once)."""
    docs.select(F.to_json(F.struct(F.col("id"), F.col("contents"))).alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "ignore", sort_by: str | None = None) -> None:
    """A derived table as Parquet, optionally sorted within files for min/max pruning."""
    if sort_by:
        df = df.sortWithinPartitions(sort_by)
    df.write.mode(mode).parquet(path)


def result_lines(results: DataFrame) -> DataFrame:
    """The three display lines of a rendered result as one text value; null parts are empty."""
    rank, docid, score, title, snippet = (F.concat(F.lit(label), F.coalesce(F.col(c).cast("string"), F.lit("")))
                                          for label, c in zip(C.RESULT_LABELS, ("rank", "docid", "score_text", "title", "snippet"), strict=True))
    return results.select("qid", "rank", F.concat(rank, docid, score, F.lit("\n"), title, F.lit("\n"), snippet).alias("value"))


def write_result_lines(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S12 sink: the display lines of ``results`` as text files, questions in order over the part
    files and results by rank inside a question. One range shuffle by question and rank, so many results of one
    question may spread over several files."""
    result_lines(results).repartitionByRange("qid", "rank").sortWithinPartitions("qid", "rank") \
        .select("value").write.mode(mode).text(path)


def run_lines(fused: DataFrame, tag: str = RUN_TAG) -> DataFrame:
    """``qid Q0 docid rank score tag`` per fused result (score to the 9 places it
    was rounded to, which prints identically in every engine)."""
    return fused.select(F.concat_ws(" ", F.col("qid"), F.lit("Q0"), F.col("docid"), F.col("rank").cast("string"),
                                    F.format_string("%.9f", F.col("score")), F.lit(tag)).alias("line"))
