import random

import pytest

from hunch.llm import common as C
from hunch.llm import jaccard as J

from . import util as U


def brute(texts, k, num, den):
    """(n_shingles, component) of each id (of its last row); rows of one id are one document."""
    return {i: (n, c) for i, n, c in brute_rows(texts, k, num, den)}


def brute_rows(texts, k, num, den):
    sets, every = {}, {}
    for i, t in texts:
        if i is not None:
            w = (t or "").encode().lower().split()
            s = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
            sets[len(every)] = s
            every[len(every)] = i
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and (every[a] == every[b] or n and den * n >= num * len(sets[a] | sets[b])):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    least = {}
    for a in sets:
        least[top(a)] = min(least.get(top(a), every[a]), every[a])
    return [(every[a], len(sets[a]), least[top(a)]) for a in sets]


@pytest.mark.parametrize("crowded", [4, 0])
def test_components_match_brute_force(spark, monkeypatch, crowded):
    C.ship(spark)
    monkeypatch.setattr(J, "CROSS_PER_MEMBER", crowded)  # 0: every contested key goes through crowds
    texts = U.odd_texts() + U.variants(60) + [(300 + i, U.words(n, 40 + i % 3, 9)) for i, n in enumerate(range(1, 40))]
    got = J.jaccard_components(U.docs(spark, texts), 4, 85, 100).collect()
    want = brute(texts, 4, 85, 100)
    assert len(got) == sum(i is not None for i, _ in texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_one_id_with_several_texts(spark):
    """The links of all texts of an id count, whatever other ids hold them; no text is overwritten."""
    C.ship(spark)
    a, b, c, e = (U.words(40, 70 + i) for i in range(4))
    texts = [(1, a), (5, a), (5, b), (5, c), (9, b), (11, c), (2, b), (20, e), (20, None), (21, e + " more"), (30, None), (30, "x y"), (30, "x  Y"), (40, U.words(30, 90)), (40, U.words(30, 91)), (40, U.words(30, 92))]
    for t in (texts, texts + [((1 << 63) - 1, a), (50, None)]):
        got = sorted(tuple(r) for r in J.jaccard_components(U.docs(spark, t), 4, 85, 100).collect())
        assert got == sorted(brute_rows(t, 4, 85, 100))


def test_empty(spark):
    C.ship(spark)
    assert J.jaccard_components(U.docs(spark, [])).count() == 0
    assert [tuple(r) for r in J.jaccard_components(U.docs(spark, [(3, None)])).collect()] == [(3, 0, 3)]


def test_bands_hold_every_linkable_pair():
    for num, den in ((80, 100), (85, 100)):
        tops = J.band_tops(num, den, 5000)
        band = lambda n: next(i for i, t in enumerate(tops) if n <= t)
        for small in range(1, 1500):
            assert band(small * den // num) - band(small) <= 1
        lo = 1
        for t in tops:
            m, q, x = J.allocate(lo, t, 1000, num, den)
            assert m >= 1 and 0 <= q <= m and x >= 0 and m + q - x == (den - num) * t // num + 1
            lo = t + 1


def test_crowds_make_no_rows_for_elements_of_one_set(spark, monkeypatch):
    """Unrelated texts under common boilerplate: what only one of them has is not dealt out."""
    monkeypatch.setattr(J, "CROSS_PER_MEMBER", 0)
    made, cut = {}, J.C.cut

    def counted(df, label):
        out = cut(df, label)
        made[label] = made.get(label, 0) + (out.count() if label in ("far", "crowd") else 0)
        return out
    monkeypatch.setattr(J.C, "cut", counted)
    common = " ".join(f"licence{i}" for i in range(120))
    rows = [(d, common + " " + " ".join(f"own{d}x{i}" for i in range(60))) for d in range(40)]
    rows += [(100, rows[7][1] + " more"), (101, rows[7][1].replace("own7x30", "other"))]
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=5).collect()}
    assert found == {**{d: d for d in range(40)}, 100: 7, 101: 7}
    assert made["crowd"] > 40 and made["far"] < 200  # all first elements would be about a fifth of a set for each


def test_few_unrelated_sets_under_common_keys_are_no_crowd(spark, monkeypatch):
    """A dozen texts that share boilerplate are compared by the counts of their shingles; no set is moved for it."""
    made, cut = {}, J.C.cut

    def counted(df, label):
        out = cut(df, label)
        made[label] = made.get(label, 0) + (out.count() if label in ("crowd", "cross", "plausible") else 0)
        return out
    monkeypatch.setattr(J.C, "cut", counted)
    common = " ".join(f"licence{i}" for i in range(120))
    rows = [(d, common + " " + " ".join(f"own{d}x{i}" for i in range(60))) for d in range(12)] + [(100, common + " end")]
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=5).collect()}
    assert found == {d: d for d, _ in rows}
    assert made["crowd"] == 0 and made["cross"] > 20 and made["plausible"] < made["cross"] / 4


def test_bins_lose_no_link(spark):
    C.ship(spark)
    texts = [t for t in U.variants(40) + U.odd_texts() if t[0] is not None] + [(900 + i, " ".join(["same"] * 3000 + [f"w{i}x{j}" for j in range(20 * i)])) for i in range(6)]
    d = spark.createDataFrame(list(dict(texts).items()), "doc_id long, text string")
    sets = J._candidate_sets(d, d.select(J.F.col("doc_id").alias("doc")), 4).cache()
    pairs = sets.select(J.F.col("doc").alias("a")).crossJoin(sets.select(J.F.col("doc").alias("b"))).filter("a < b")
    every = {tuple(r) for r in J.verify(pairs, sets, 80, 100).collect()}
    kept = {tuple(r) for r in J.plausible(pairs, sets, 80, 100).collect()}
    assert len(every) > 10 and every <= kept and len(kept) < pairs.count() / 2


def smallest_reachable(pairs):
    least = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def test_components_end_with_the_round_that_joins_all(spark, monkeypatch):
    """Any graph gives the smallest node reachable; no table is written for the start or to see that nothing changes."""
    r, written, cut = random.Random(3), [], C.cut
    monkeypatch.setattr(C, "cut", lambda df, label: written.append(label) or cut(df, label))
    path = list(range(60))
    r.shuffle(path)
    stars = [(10 * i, 10 * i + j) for i in range(5) for j in range(1, 9)] + [(7, 7), (8, 0), (1 << 62, -5)]
    every = [stars, list(zip(path, path[1:])), [(i, i - 1) for i in range(1, 40)] + [(39, 0)], [(900, i) for i in range(50)],  # noqa: B905
             [(r.randrange(300), r.randrange(300)) for _ in range(200)], []]
    for pairs in every:
        written.clear()
        found = {x["node"]: x["comp"] for x in C.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert found == smallest_reachable([p for p in pairs if p[0] != p[1]])
        if pairs is stars or not pairs:
            assert len(written) == 1


def test_few_tables_are_written(spark, monkeypatch):
    """Each written table costs a file for every shuffle partition, however few rows it has."""
    C.ship(spark)
    monkeypatch.setattr(J, "CROSS_PER_MEMBER", 0)
    written, cut = [], J.C.cut
    monkeypatch.setattr(J.C, "cut", lambda df, label: written.append(label) or cut(df, label))
    texts = [t for t in U.variants(60) if t[0] is not None]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(U.docs(spark, texts), 4, 85, 100).collect()}
    assert got == brute(texts, 4, 85, 100)
    assert "crowd" in written and "far" in written
    assert len([x for x in written if x != "cc"]) <= 17 and not {"several", "names", "met", "best", "ids", "comp", "joined"} & set(written)
