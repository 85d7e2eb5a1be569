"""Containment of passages in texts: trigram and term probes against brute force, without a nested loop."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hunch.operators import index as X
from hunch.operators import joins as J
from hunch.session import fresh_path
from hunch.sources import tables as TB

DOCS = [("d1", "Red kite\nA red kite circles over the harbour."), ("d2", "The old mill grinds barley."), ("d3", None), ("d4", ""),
        ("d5", "naïve 日本語の文章 😀😀 kite"), ("d6", "kitekite the the"), ("d7", "x" * 50_000 + " end")]
PASSAGES = [("p1", "kite"), ("p2", "old mill"), ("p3", "e"), ("p4", "th"), ("p5", ""), ("p6", None), ("p7", "日本"), ("p8", "😀 k"),
            ("p9", "a red kite circles over"), ("p10", "A red kite circles over"), ("p11", "zebra"), ("p12", "kite\nA"), ("p13", "xx end"), ("p1", "barley.")]


def _brute(passages, docs):
    return {(q, d) for q, p in passages for d, t in docs if p is not None and t is not None and p in t}


def _pairs(df):
    rows = [tuple(x) for x in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _tables(spark, passages, docs):
    return spark.createDataFrame(passages, "qid string, passage string"), spark.createDataFrame(docs, "docid string, text string")


@pytest.mark.parametrize("bound", [None, 0])
def test_short_passages_equal_brute_force(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", bound)
        monkeypatch.setattr(J, "HOT_ROWS", 2)
    p, d = _tables(spark, PASSAGES, DOCS)
    assert _pairs(TB.containing(p, d)) == _brute(PASSAGES, DOCS)
    idx = X.build_index(spark, d.select("docid", d["text"].alias("contents")), fresh_path(spark, "t-contain"))
    assert _pairs(TB.containing(p, d, idx.postings, idx.term_stats)) == _brute(PASSAGES, DOCS)


def test_no_nested_loop_and_no_rows(spark):
    p, d = _tables(spark, PASSAGES, DOCS)
    plan = TB.containing(p, d)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert TB.containing(p.limit(0), d).count() == 0
    assert TB.containing(p, d.limit(0)).count() == 0


def test_only_rarest_trigrams_leave_the_scan(spark):
    docs = [(f"d{i}", "the common words of every text" + (" quartz" if i == 7 else "")) for i in range(200)]
    p, d = _tables(spark, [("p1", "text quartz"), ("p2", "words of a")], docs)
    assert _pairs(TB.trigram_candidates(p, d).select("qid", "docid")) == {("p1", "d7")}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab é", max_size=6), max_size=8), st.lists(st.text("ab é", max_size=12), max_size=8))
def test_any_texts(spark, passages, texts):
    passages, texts = [(f"p{i}", x) for i, x in enumerate(passages)], [(f"d{i}", x) for i, x in enumerate(texts)]
    assert _pairs(TB.containing(*_tables(spark, passages, texts))) == _brute(passages, texts)
