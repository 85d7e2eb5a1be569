"""The driver contract: entry runs, every query has a callable, oracle keys are queries."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"qid", "docid", "score", "rank"}


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60
