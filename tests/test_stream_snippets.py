"""Stream/batch equality (R07 = R05) and Unicode-aware snippet word boundaries."""

import os

from pyspark.sql import functions as F

from hunch.functions import text as T
from hunch.operators import index as X
from hunch.plans import search as S
from hunch.session import app_scratch, cut_lineage, fresh_path, working_tables
from hunch.sources.tables import benchmark_topics, read_table
from hunch.streaming import search_stream as SS

from .conftest import SF_SMALL


def test_stream_equals_batch(spark):
    idx = X.load_index(spark, SF_SMALL)
    batch = S.search(benchmark_topics(spark, SF_SMALL), idx)["fused"]
    schema = read_table(spark, SF_SMALL, "benchmark").schema
    out = SS.run_search_stream(spark, SS.question_stream(spark, SF_SMALL, schema), idx, fresh_path(spark, "t-stream"))
    streamed = spark.read.parquet(out).select("qid", "docid", "score", "rank")
    a = sorted(tuple(r) for r in batch.collect())
    b = sorted(tuple(r) for r in streamed.collect())
    assert a == b and len(a) > 0


def test_snippet_unicode_word_boundaries(spark):
    df = spark.createDataFrame([("épaçment la ment ment, der die", "ment der die")], "c string, q string")
    got = df.select(T.snippet(F.col("c"), F.col("q")).alias("s")).first()["s"]
    # 'ç' is a letter, so "épaçment" holds no whole-word "ment"
    assert got == "épaçment la **ment** **ment**, **der** **die**"


def test_micro_batches_leave_no_working_tables(spark, tmp_path):
    """Four epochs, one file each: the results of all of them, and no folder besides."""
    idx = X.load_index(spark, SF_SMALL)
    schema = read_table(spark, SF_SMALL, "benchmark").schema
    t = read_table(spark, SF_SMALL, "benchmark").orderBy("item_id").limit(4).collect()
    for i, r in enumerate(t):
        spark.createDataFrame([r], schema).coalesce(1).write.parquet(f"{tmp_path}/benchmark_{i}.parquet")
    scratch = app_scratch(spark)
    out = fresh_path(spark, "t-epochs")
    ckpt = fresh_path(spark, "t-ckpt")
    before = set(os.listdir(scratch))
    stream = SS.question_stream(spark, str(tmp_path), schema, files_per_batch=1)
    SS.run_search_stream(spark, stream, idx, out, checkpoint=ckpt)
    assert len([d for d in os.listdir(out) if d.startswith("epoch=")]) == 4
    assert set(os.listdir(scratch)) - before <= {os.path.basename(out), os.path.basename(ckpt)}
    assert spark.read.parquet(out).select("qid").distinct().count() == 4


def test_scope_owns_what_is_made_in_it(spark):
    with working_tables(spark) as scope:
        kept = cut_lineage(spark.range(5), "inner")
        assert kept.count() == 5 and scope.holds(kept.inputFiles()) and not scope.holds(["/x/inner/y"])
        paths = list(scope.paths)
    assert len(paths) == 1 and not os.path.exists(paths[0])
    outside = cut_lineage(spark.range(3), "outer")
    assert outside.count() == 3
