import math
import random

import numpy as np
from pyspark.sql import functions as F

from hunch.llm import common as C
from hunch.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, a long, w int, cell int, id long, v array<int>"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, 2, 3, 4, [5]) for i, v, k in rows], SCHEMA)


def brute(rows, step, n=5):
    dim = max((len(v) for _, v, _ in rows if v), default=0)
    ok = {(i, tuple(math.floor(256 * x) for x in v) + (0,) * (dim - len(v)), k) for i, v, k in rows
          if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in v)}
    out = []
    for i, q, k in ok:
        if i % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), j, m) for j, v, m in ok)
        for p, j, _ in [x for x in scored if x[2] == k and x[1] != i][:n]:
            near = [x for x in scored if x[2] != k and 80 * -p <= 100 * -x[0] <= 100 * -p][:n]
            out += [(i, j, r + 1, x[1], -p, -x[0]) for r, x in enumerate(near)]
    return sorted(out)


def mined(spark, rows, step, **how):
    return sorted(tuple(r) for r in N.hard_negatives(table(spark, rows), F.col("vec_id") % step == 0, **how).collect())


def test_matches_brute_force(spark):
    C.ship(spark)
    r = random.Random(3)
    noise = [(i, [r.gauss(0, 0.2) for _ in range(8)], r.randrange(3)) for i in range(400)]
    assert mined(spark, noise, 20) == brute(noise, 20)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    close = [(i, [x + r.gauss(0, 0.05) for x in centres[i % 6]], i % 4) for i in range(600)]
    assert mined(spark, close, 30, block=16, piece=4, first_budget=10) == brute(close, 30)  # several rounds, blocks and pieces


def test_odd_rows(spark):
    C.ship(spark)
    v = [0.5, -0.25, 0.1]
    rows = [(i, v, i % 2) for i in range(0, 60)]  # one vector in all of them, ties everywhere
    rows += [(100, [0.5, 0.5, 0.5], 0), (100, [0.5, 0.5, 0.5], 0), (100, [0.4, 0.5, 0.5], 0), (101, None, 1), (102, [0.5, None, 0.5], 1), (103, [0.5, float("nan"), 1.0], 1),
             (104, [float("inf"), 0.0, 0.0], 0), (105, v, None), (None, v, 1), (106, [], 1), (107, [0.9], 0), (110, [-1.0, -1.0, -1.0], 5), (120, [0.0, 0.0, 0.0], 0),
             (130, [1e200, 0.0, 0.0], 0), (140, [1e-200, 0.0, 0.0], 1)]
    assert mined(spark, rows, 10) == brute(rows, 10)
    one = [(i, [x / 7], i % 2) for i, x in enumerate(range(-9, 9))]
    assert mined(spark, one, 3) == brute(one, 3)
    assert mined(spark, [], 10) == mined(spark, [(1, v, 1)], 10) == mined(spark, [(10, v, 1)], 10) == mined(spark, [(10, None, 1)], 10) == []
    large = [(i, [2.0 ** (18 - i % 3), 3.3 * i, -1e5], i % 2) for i in range(40)]  # scores beyond 2 ** 53
    assert mined(spark, large, 5) == brute(large, 5)


def test_bounds_descend_and_hold():
    r = np.random.default_rng(5)
    x = r.integers(-200, 200, (300, 6)).astype(float)
    books = [N.kmeans(x[:, :3], 4), N.kmeans(x[:, 3:], 4)]
    (c1, r1), (c2, r2) = N.nearest_code(x[:, :3], books[0]), N.nearest_code(x[:, 3:], books[1])
    cell = c1 * len(books[1]) + c2
    cells = N.Cells(books, [{"cell": c, "n": int((cell == c).sum()), "r1": r1[cell == c].max(), "r2": r2[cell == c].max()} for c in np.unique(cell)])
    q = r.integers(-200, 200, 6)
    walk = list(cells.walk(q))
    assert sorted(w[1] for w in walk) == list(range(len(books[0]) * len(books[1])))
    bounds = [w[0] for w in walk]
    assert bounds == sorted(bounds, reverse=True)
    for bound, c, low, high in walk:
        s = x[cell == c] @ q
        assert not len(s) or low <= s.min() and s.max() <= min(high, bound)
