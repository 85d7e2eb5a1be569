"""Questions arriving as a stream, answered per micro-batch.

The reference reads one question at a time from a terminal until a blank line. Here
questions arrive as files; each micro-batch is one set-at-a-time run of the search
flow against the static index tables. Fusion is per question, so per-batch results
equal the batch flow's. Every epoch writes its own folder with ``overwrite``, so a
batch replayed after a failure replaces its earlier output instead of duplicating it.
The working tables of a batch are deleted when its results are written, so that a stream
which never ends does not fill the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import Index
from ..plans import search as S
from ..session import fresh_path, working_tables


def question_stream(spark: SparkSession, sf_dir: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Passage files as a stream of ``(qid, query)``; blank questions are dropped."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    src = reader.parquet(f"{sf_dir.rstrip('/')}/benchmark*.parquet")
    q = src.select(F.col("item_id").cast("string").alias("qid"), F.col("text").alias("query"))
    return q.filter(F.col("query").isNotNull() & (F.trim("query") != ""))


def run_search_stream(spark: SparkSession, questions: DataFrame, idx: Index, out_path: str,
                      fl: S.Flavour = S.MAIN, checkpoint: str | None = None) -> str:
    """Run the stream to the end of the available input (``availableNow``; the source's own limits,
    such as files per trigger, cut it into micro-batches); fused results land in ``out_path/epoch=N``. Returns ``out_path``."""
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        with working_tables(batch.sparkSession):
            fused = S.search(batch, idx, fl)["fused"]
            fused.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    ckpt = checkpoint or fresh_path(spark, "stream-ckpt")
    q = (questions.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path
