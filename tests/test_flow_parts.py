"""A flow makes its parts when they are asked for."""

import pytest

from hunch.plans import search as S


def test_lists_need_no_index(spark):
    topics = spark.createDataFrame([("a", "Anna Lee ran in 1994.")], "qid string, query string")

    def idx():
        raise RuntimeError("opened")
    flow = S.search(topics, idx)
    assert set(flow) == {"decomposition", "lists", "hits", "fused", "results"}
    rows = {r.sub_ord: r.text for r in flow["lists"].collect()}
    assert '"Anna Lee"^4' in rows[0] and '"1994"^2' in rows[0]
    assert flow["lists"] is flow["lists"]
    with pytest.raises(RuntimeError, match="opened"):
        flow["fused"]
    with pytest.raises(KeyError):
        flow["other"]
