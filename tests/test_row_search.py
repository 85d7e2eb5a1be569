"""Spans, postings and scores made in a document's own row equal those made by groups over all rows."""

from pyspark.sql import functions as F

from hunch.operators import annotate as A
from hunch.operators import decompose as D
from hunch.operators import index as X
from hunch.operators import rank as R
from hunch.session import fresh_path
from hunch.sources import tables as TB

ROWS = [("d1", "red cars and red dogs"), ("d2", "blue cars"), ("d2", "blue dogs run"), (None, "red cars"), (None, "red birds"),
        ("d3", None), ("d4", "")] + [(f"copy{i:02d}", "red cars and red dogs") for i in range(9)]


def _rows(df):
    return sorted(map(repr, df.collect()))


def _index(spark):
    return X.build_index(spark, spark.createDataFrame(ROWS, "docid string, contents string"), fresh_path(spark, "t-rows"), stop=[])


def test_spans_without_tokens(spark):
    t = spark.createDataFrame([("a", "We met Anna Lee Ray in Boston. The Acme Company was there in 1994."), ("b", None), ("c", "no name here"),
                               ("r", "Anna Lee sang."), ("r", "Bob Ray sat in May 1995 and Paris."), (None, "New York at midnight")], "qid string, query string")
    found = A.spans(t)
    assert _rows(found) == _rows(D.entity_spans(A.annotate(t))) and found.count() >= 5
    once = A.spans(t.filter("qid = 'a'"))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in once and "Exchange" not in once


def test_postings_by_row(spark):
    idx = _index(spark)
    cols = ["term", "docid", "tf", "dl", "positions"]
    assert _rows(idx.postings.select(*cols)) == _rows(X.postings(idx.tokens).select(*cols))
    assert {r["docid"] for r in idx.repeated.collect()} == {"d2", None}
    plan = X.row_postings(idx.tokens)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort" not in plan


def test_best_hits_equal_all_scores(spark, monkeypatch):
    idx = _index(spark)
    q = spark.createDataFrame([("q1", 1, "red cars"), ("q1", 2, "dogs"), ("q2", 1, "blue dogs run red"), ("q3", 1, "unknown"), (None, 1, "birds")],
                              "qid string, sub_ord int, text string")
    qt = R.query_terms(q, stop=[])
    for k, cells, group in ((1, 4, 2), (3, 1 << 20, 4096), (50, 8, 1)):
        monkeypatch.setattr(R, "BLOCK_CELLS", cells)
        monkeypatch.setattr(R, "GROUP_LISTS", group)
        assert _rows(R.top_k(R.best_hits(qt, idx, k), k)) == _rows(R.top_k(R.score_bm25(qt, idx), k))
    red = spark.createDataFrame([(0, "red", 1.0)], "list bigint, term string, w double")
    one = R.row_scores(X.only(idx.tokens, idx.repeated, "left_anti").coalesce(1), red, 3, idx.avg_dl, 1.2, 0.75)
    assert {r["docid"] for r in one.collect()} == {"copy00", "copy01", "copy02"}  # of ten equal texts


def test_judgements_leave_postings_in_place(spark):
    idx = _index(spark)
    p = spark.createDataFrame([("q1", "cars and red"), ("q2", "blue dogs run"), ("q3", "red")], "qid string, passage string")
    docs = spark.createDataFrame(ROWS, "docid string, text string")
    found = TB.containing(p, docs, idx.postings, idx.term_stats)
    brute = p.join(docs, F.col("text").contains(F.col("passage"))).filter("docid IS NOT NULL").select("qid", "docid").distinct()
    assert _rows(found) == _rows(brute)
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
