"""The stages of the corpus pipeline: each applies one operator to ``documents`` rows.

All but the last return the columns they got. A row without an id cannot be judged by any
operator and does not survive the first stage.

What an operator writes on its way belongs to a scope of its stage. The scope goes when a later
stage is called on other rows that are not read from it: by then the stage's result has been
written, so the shared folder holds the working tables of one stage at a time. Rows that
repeat an id are judged together by ``near_duplicates`` and ``benchmark_leaks`` (an id goes if
any of its rows has to); null and empty texts are nobody's duplicate and hold no passage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scope, remove_path
from . import common as C

_PENDING: dict[str, list[tuple[list[str], Scope]]] = {}  # by application: input files and scope of earlier stages


def _release(spark: SparkSession, files: list[str] | None) -> None:
    """Delete the scopes of stages whose results have been written: those that read other files than
    ``files`` and hold none of them (None: all)."""
    old = _PENDING.pop(spark.sparkContext.applicationId, [])
    keep = [(f, s) for f, s in old if files is not None and (f == files or s.holds(files))]
    for entry in old:
        if entry not in keep:
            entry[1].delete(spark)
    _PENDING[spark.sparkContext.applicationId] = keep


def stage(fn: Callable) -> Callable:
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        C.ship(spark)
        files = sorted(docs.inputFiles())
        _release(spark, files)
        scope = Scope()
        _PENDING[spark.sparkContext.applicationId].append((files, scope))
        with scope.open():
            return fn(spark, docs, sf_dir)
    return run


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").select(docs.columns)


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without any letter (no language); the others get their predicted language, or
    keep their own when no labelled row could train a model."""
    from .langid import language_id
    found = language_id(docs).filter("has_letter").groupBy("doc_id").agg(F.min(F.expr("nullif(lang_pred, 'und')")).alias("__lang"))
    return docs.join(found, "doc_id").withColumn("lang", F.coalesce("__lang", F.col("lang").cast("string"))).select(docs.columns)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut out; a document that loses all its text goes."""
    from .linededup import line_dedup
    # one result for each id and text: rows that repeat an id keep their own texts
    kept = line_dedup(docs, with_hash=True).filter("n_dropped < n_lines").dropDuplicates(["doc_id", "h"]) \
        .select("doc_id", F.col("h").alias("__h"), F.col("text").alias("__text"))
    hashed = docs.withColumn("__h", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    out = hashed.join(kept, ["doc_id", "__h"]).withColumn("text", F.col("__text")).withColumn("n_chars", F.length("__text").cast("long"))
    return out.filter(F.length(F.btrim("text", F.lit(" \t\n\x0b\f\r"))) > 0).select(docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the smallest id of each group stays."""
    from .jaccard import jaccard_components
    return _keep(docs, jaccard_components(docs, k=5, num=80, den=100).filter("doc_id = component_id"))


@stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    from .decontam import decontaminate
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _keep(docs, decontaminate(docs, items).filter("n_hit = 0"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 1024 tokens."""
    from .packing import pack_documents
    return pack_documents(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("benchmark_leaks", benchmark_leaks), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str, stages) -> DataFrame:
    """Each stage over all rows that its predecessor kept, written to the shared folder between stages;
    a stage's rows are deleted when the next one's are written."""
    docs, last = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, one in stages:
        path = C.fresh_path(spark, f"stage-{name}")
        one(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove_path(spark, last)
        docs, last = spark.read.parquet(path), path
    _release(spark, None)
    return docs
