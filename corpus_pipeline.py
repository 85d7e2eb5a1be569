"""The corpus pipeline: language ID, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); a stage takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which ``run`` writes to the shared folder as Parquet and rereads as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hunch.llm import stages as S

STAGES = S.STAGES
ORACLE_SQL = None  # language identification has no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    return S.run(spark, sf_dir, STAGES)
