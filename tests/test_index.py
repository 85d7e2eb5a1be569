"""The index is built once to a path, opened without analysing, and scored without moving scores."""

import os

import pytest
from pyspark.sql import functions as F

from hunch.operators import index as X
from hunch.operators import rank as R
from hunch.plans.q_index import passage_subqueries
from hunch.session import fresh_path

from .conftest import SF_SMALL


def test_build_skip_and_open(spark, monkeypatch):
    corpus = X.corpus_from_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    path = fresh_path(spark, "t-index")
    assert X.open_index(spark, path) is None
    a = X.build_index(spark, corpus, path)
    monkeypatch.setattr(X, "analysed", None)      # a second build may not analyse anything
    other = spark.newSession()
    b = X.build_index(other, corpus, path)
    assert (a.n_docs, a.avg_dl) == (b.n_docs, b.avg_dl)
    assert a.postings.count() == b.postings.count() > 0
    assert b.corpus.filter(F.col("contents").isNotNull()).count() == a.n_docs
    assert b.vectors().count() == b.postings.select("docid").distinct().count()


def test_scores_do_not_move(spark):
    idx = X.load_index(spark, SF_SMALL)
    hits = R.score_bm25(R.query_terms(passage_subqueries(spark, SF_SMALL)), idx, broadcast_ok=True)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    body = plan[:plan.index("FileScan parquet spark_catalog")]
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning(qid" not in body


def _corpus(spark, folder, rows):
    spark.createDataFrame(rows, "docid string, contents string").write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def test_manifest(spark, tmp_path):
    """A path serves the same corpus and options only; a build that was cut off is written anew."""
    path = fresh_path(spark, "t-manifest")
    one = _corpus(spark, f"{tmp_path}/one", [("d1", "red cars"), ("d2", "blue car")])
    two = _corpus(spark, f"{tmp_path}/two", [("d1", "red cars"), ("d2", "blue car"), ("d3", "green")])
    a = X.build_index(spark, one, path, stop=[])
    assert X.build_index(spark, spark.read.parquet(f"{tmp_path}/one"), path, stop=[]).fingerprint == a.fingerprint
    for corpus, how in ((two, {}), (one, {"stemmer": "porter"}), (one, {"stop": ["red"]}), (one, {"recipe": "other"})):
        with pytest.raises(X.IndexMismatch):
            X.build_index(spark, corpus, path, **{"stop": [], **how})
    b = X.build_index(spark, two, path, stop=[], on_mismatch="rebuild", store_vectors=True)
    assert b.n_docs == 3 and sorted(r["docid"] for r in b.doc_stats.collect()) == ["d1", "d2", "d3"]
    assert {r["term"] for r in b.postings.collect()} == {"red", "cars", "blue", "car", "green"}
    assert sorted((r["docid"], r["vector"]) for r in spark.read.parquet(f"{path}/vectors").collect())[1] == ("d2", {"blue": 1, "car": 1})
    # the same files with other content: another index, not the old buckets of the catalog
    again = _corpus(spark, f"{tmp_path}/two", [("d9", "only this"), ("d8", "one more")])
    c = X.build_index(spark, again, path, stop=[], on_mismatch="rebuild")
    assert c.n_docs == 2 and {r["term"] for r in c.postings.collect()} == {"only", "this", "one", "more"}
    for f in os.listdir(f"{path}/meta"):   # as after a crash before the manifest
        os.unlink(f"{path}/meta/{f}")
    os.rmdir(f"{path}/meta")
    assert X.open_index(spark, path) is None
    assert X.build_index(spark, again, path, stop=[]).n_docs == 2
    rows = spark.createDataFrame([("d1", "a"), ("d2", "b")], "docid string, contents string")  # not from files: known by its rows
    plain = fresh_path(spark, "t-rows")
    assert X.build_index(spark, rows, plain).fingerprint == X.build_index(spark, rows.orderBy("contents"), plain).fingerprint
    with pytest.raises(X.IndexMismatch):
        X.build_index(spark, rows.limit(1), plain)


def test_lasting_index_folder(spark, tmp_path):
    """With ``spark.hunch.index.dir`` an index outlives the application's scratch folder."""
    spark.conf.set("spark.hunch.index.dir", str(tmp_path))
    try:
        home = X.index_home(spark, "key")
    finally:
        spark.conf.unset("spark.hunch.index.dir")
    assert home == f"{tmp_path}/key" and X.index_home(spark, "key") != home


def test_a_rare_term_reads_its_directory_only(spark):
    idx = X.load_index(spark, SF_SMALL)
    rare = idx.term_stats.filter("df = 1").orderBy("term").first()["term"]
    q = spark.createDataFrame([("q", 1, rare)], "qid string, sub_ord int, text string")
    qt = R.query_terms(q)
    fits, parts = R.query_parts(qt, idx)
    assert fits and len(parts) == 1
    hits = R.top_k(R.score_bm25(qt, idx), 50)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan[plan.index("PartitionFilters"):].split("]")[0]
    above, below = plan.split(", 50, Partial", 1)
    assert "Exchange hashpartitioning(qid" in above
    assert "Exchange" not in below[:below.index("FileScan parquet spark_catalog")] and "Bucketed: true" in plan
    assert hits.count() == 1
    scanned = idx.of_terms(parts)
    read = {f for f in (r["f"] for r in scanned.select(F.col("_metadata.file_path").alias("f")).distinct().collect())}
    every = {r["f"] for r in idx.postings.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert 0 < len(read) <= len(every) / 8 and all(f"part={parts[0]}/" in f for f in read)


def test_postings_hold_positions(spark):
    corpus = spark.createDataFrame([("d1", "b a b b"), ("d2", "")], "docid string, contents string")
    idx = X.build_index(spark, corpus, fresh_path(spark, "t-pos"), stop=[])
    assert sorted((r["term"], r["tf"], r["dl"], r["positions"]) for r in idx.postings.collect()) == [("a", 1, 4, [1]), ("b", 3, 4, [0, 2, 3])]
    assert idx.n_docs == 2
