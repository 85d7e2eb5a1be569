"""The large-input strategies must give the same rows as the broadcast ones."""

from hunch.operators import index as X
from hunch.operators import joins as J
from hunch.operators import rank as R
from hunch.plans.q_index import passage_subqueries
from hunch.sources.tables import passage_judgements

from .conftest import SF_CHECK


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bm25_salted_shuffle_equals_broadcast(spark, monkeypatch):
    idx = X.load_index(spark, SF_CHECK)
    q = passage_subqueries(spark, SF_CHECK)
    a = _rows(R.bm25_search(q, idx, k=50))
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(J, "HOT_ROWS", 100)   # many hot terms, all salted by their own frequency
    b = _rows(R.bm25_search(q, idx, k=50))
    assert a == b and len(a) == 2000


def test_judgements_probe_route_equals_scan(spark, monkeypatch):
    idx = X.load_index(spark, SF_CHECK)
    a = _rows(passage_judgements(spark, SF_CHECK, None))
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 5)
    b = _rows(passage_judgements(spark, SF_CHECK, idx.postings))
    assert a == b and len(a) > 0


def test_attach_contents_routes_agree(spark, monkeypatch):
    from hunch.operators import present as P
    idx = X.load_index(spark, SF_CHECK)
    fused = R.bm25_search(passage_subqueries(spark, SF_CHECK), idx, k=50).select("qid", "docid", "score", "rank")
    a = _rows(P.attach_contents(fused, idx.corpus).select("qid", "docid", "contents"))
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 1500)   # fused (2000 rows) no longer fits, its ids do
    b = _rows(P.attach_contents(fused, idx.corpus).select("qid", "docid", "contents"))
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 0)
    c = _rows(P.attach_contents(fused, idx.corpus).select("qid", "docid", "contents"))
    assert a == b == c and len(a) == 2000


def test_lookup_broadcasts_the_fused_side(spark):
    from hunch.operators import present as P
    idx = X.load_index(spark, SF_CHECK)
    fused = R.bm25_search(passage_subqueries(spark, SF_CHECK), idx, k=50).select("qid", "docid", "score", "rank")
    plan = P.attach_contents(fused, idx.corpus)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "Join Inner" in plan
