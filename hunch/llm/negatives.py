"""Operator 13: hard negatives over an inverted multi-index.

Vectors become integers (``floor(256 * x)``), so scores (inner products) are exact. Each half
of the axes has a codebook (k-means on at most ``SAMPLE_ROWS`` rows); a row lies in the cell
of its two codewords, and a cell knows how far its rows lie from either codeword. For an
anchor, ``q . c + |q| * radius`` bounds what half a row can score, and a heap over the two
descending lists of half bounds yields the cells by the sum of both: the multi-sequence walk.

The walk runs in rounds for all anchors at once: an anchor visits cells until its budget of
rows is spent, the visits meet the rows of the cells on Spark, and the best rows found raise
the score that a further cell must be able to reach. An anchor is certified when the next
bound lies below that score (or no cell is left), so results are exact: the bounds only save
work. Budgets grow by ``GROW``, so the rounds number the logarithm of the rows. Two walks are
taken: positives (same label, best first), then negatives (other label, in the score window
of each positive), which also pass over cells that lie wholly above the windows.

Cells are cut into blocks of about ``BLOCK`` rows and the anchors at a block into pieces of
about ``PIECE``: a task's group is (cell, block, piece), whatever the size of a cell. Rows of
equal label and vector score alike, so the index holds only the ``n + 1`` smallest ids of
them, which is all that can be among the first ``n``.

Rows: a null id cannot be addressed; null labels, null vectors and vectors with null or
non-finite components take no part, nor do components so large that an inner product could
pass 64 bits (beyond 1.4 million in 64 dimensions). Shorter vectors count as if followed by
zeros; empty vectors score 0. Exactly repeated rows count once; rows that repeat an id with
another label or vector are rows of their own (each an anchor, if the id is one), and a
positive's id always differs from the anchor's. Ties: smaller id first. No anchors, or an
empty table: no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

SAMPLE_ROWS, MAX_CODES, BLOCK, PIECE, FIRST, GROW = 20_000, 64, 4096, 512, 16_384, 8
LOW, HIGH = -(1 << 63), (1 << 63) - 1
ASK = "a long, anchor_id long, label long, v array<int>, lo array<long>, hi array<long>, at int, stop long"


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.int64).reshape(len(col), dim)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x`` (a fixed seed; empty clusters vanish)."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(13)
    points = np.unique(x, axis=0)
    c = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        own = nearest_code(x, c)[0]
        c = np.stack([x[own == i].mean(0) for i in np.unique(own)])
    return c


def nearest_code(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest centre, distance to it) of each row."""
    d = (c * c).sum(1)[None, :] - 2 * (x @ c.T)
    own = d.argmin(1)
    return own, np.sqrt(((x - c[own]) ** 2).sum(1))


class Cells:
    """The bounded directory of the index: codebooks, and rows and radii of each cell (at most MAX_CODES squared)."""

    def __init__(self, books: list[np.ndarray], found: list, block: int = BLOCK):
        self.books, self.block, k = books, block, len(books[1])
        self.rows, self.radius = np.zeros(len(books[0]) * k, np.int64), np.zeros((2, len(books[0]) * k))
        for r in found:
            self.rows[r["cell"]] = r["n"]
            self.radius[:, r["cell"]] = r["r1"], r["r2"]
        self.half = [b.shape[1] for b in books]
        by_code = self.radius.reshape(2, len(books[0]), k)
        self.reach = [by_code[0].max(1), by_code[1].max(0)]

    def blocks(self, cell: int) -> int:
        return -(-int(self.rows[cell]) // self.block)

    def walk(self, v: np.ndarray) -> Iterator[tuple[float, int, float, float]]:
        """(bound of this and all later cells, cell, least and greatest score in it), bounds descending."""
        q = [v[:self.half[0]].astype(float), v[self.half[0]:].astype(float)]
        mid, norm = [b @ x for b, x in zip(self.books, q, strict=True)], [float(np.sqrt(x @ x)) for x in q]
        # the rounding of sums in double precision is far below this
        slack = 1 + 1e-9 * sum(n * float((np.sqrt((b * b).sum(1)) + r).max()) for n, b, r in zip(norm, self.books, self.reach, strict=True))
        best = [m + n * r for m, n, r in zip(mid, norm, self.reach, strict=True)]
        order = [np.argsort(-b, kind="stable") for b in best]
        k = len(self.books[1])
        heap, pushed = [(-(best[0][order[0][0]] + best[1][order[1][0]]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            a, b = order[0][i], order[1][j]
            cell = int(a) * k + int(b)
            middle, spread = mid[0][a] + mid[1][b], norm[0] * self.radius[0, cell] + norm[1] * self.radius[1, cell]
            yield -bound + slack, cell, middle - spread - slack, middle + spread + slack
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(order[0]) and y < k and (x, y) not in pushed:
                    pushed.add((x, y))
                    heapq.heappush(heap, (-(best[0][order[0][x]] + best[1][order[1][y]]), x, y))


def _best(s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of at least the first ``n`` finite entries of each row of ``s``, ties in favour of earlier columns."""
    n = min(n, s.shape[1])
    edge = np.partition(s, s.shape[1] - n, 1)[:, s.shape[1] - n][:, None]
    take = (s >= edge) & (s > -np.inf)
    for r in np.flatnonzero(take.sum(1) > 4 * n):  # many ties at the edge
        first = np.argsort(-s[r], kind="stable")[:n]
        take[r] = False
        take[r, first] = s[r, first] > -np.inf
    return np.nonzero(take)


def _search(dim: int, n: int, same: bool):
    """Of one group of asks and rows: the first ``n`` rows of every window of every anchor."""
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        out, ask = [[], [], [], []], np.asarray(t["ask"])
        own, other = np.flatnonzero(ask), np.flatnonzero(~ask)
        if len(own) and len(other):
            other = other[np.argsort(np.asarray(t["id"])[other], kind="stable")]
            v, ids, label = _matrix(t["v"].chunk(0), dim), np.asarray(t["id"]), np.asarray(t["label"])
            q, x = v[own], v[other]
            if dim * float(abs(q).max(initial=0)) * float(abs(x).max(initial=0)) < 1 << 53:
                s = (q.astype(float) @ x.T.astype(float)).astype(np.int64)
            else:
                s = q @ x.T
            fits = (label[own][:, None] == label[other][None, :]) == same
            if same:
                fits &= ids[own][:, None] != ids[other][None, :]
            lo, hi = (np.asarray(t[c].chunk(0).take(pa.array(own)).flatten(), np.int64).reshape(len(own), -1) for c in ("lo", "hi"))
            a = np.asarray(t["a"])[own]
            # ranked as doubles only where these are exact, else by the place in the integer order
            key = s.astype(float) if abs(s).max(initial=0) < 1 << 53 else np.unique(s, return_inverse=True)[1].reshape(s.shape).astype(float)
            for w in range(lo.shape[1]):
                r, c = _best(np.where(fits & (s >= lo[:, w:w + 1]) & (s <= hi[:, w:w + 1]), key, -np.inf), n)
                for o, z in zip(out, (a[r], np.full(len(r), w), ids[other][c], s[r, c]), strict=True):
                    o.append(z)
        cols = [np.concatenate(o).astype(np.int64) if o else np.zeros(0, np.int64) for o in out]
        return pa.table({"a": cols[0], "w": cols[1].astype(np.int32), "id": cols[2], "s": cols[3]})
    return run


def _rounds(state: DataFrame, index: DataFrame, cells: Cells, dim: int, n: int, same: bool, piece: int, budget: int) -> DataFrame:
    """``(a, w, id, s)``: the first ``n`` rows in every window ``lo[w] <= score <= hi[w]`` of each ask."""
    best = None
    top = Window.partitionBy("a", "w").orderBy(F.desc("s"), "id")
    while True:
        def visit(batches: Iterator[pa.RecordBatch], budget: int = budget) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                at, more, cell, n_blocks = [], [], [], []
                for v, done, stop, hi in zip(_matrix(b.column("v"), dim), b.column("at").to_pylist(), b.column("stop").to_pylist(), b.column("hi").to_pylist(), strict=True):
                    spent, i, now, open_ = 0, 0, [], False
                    for i, (bound, c, low, high) in enumerate(cells.walk(v)):  # noqa: B007
                        if bound < stop:
                            break
                        if i < done:
                            continue
                        if spent >= budget:
                            open_ = True
                            break
                        if cells.rows[c] and high >= stop and low <= max(hi):
                            now.append(c)
                            spent += int(cells.rows[c])
                    at.append(i)
                    more.append(open_)
                    cell.append(now)
                    n_blocks.append([cells.blocks(c) for c in now])
                cols = [b.column(x) for x in ("a", "anchor_id", "label", "v", "lo", "hi")]
                yield pa.record_batch([*cols, pa.array(at, pa.int32()), b.column("stop"), pa.array(more), pa.array(cell, pa.list_(pa.int32())), pa.array(n_blocks, pa.list_(pa.int32()))],
                                      names=["a", "anchor_id", "label", "v", "lo", "hi", "at", "stop", "more", "cells", "n_blocks"])
        plan = C.cut(state.mapInArrow(visit, f"{ASK}, more boolean, cells array<int>, n_blocks array<int>"), "visits")
        asks = plan.select("a", "anchor_id", "label", "v", "lo", "hi", F.explode(F.arrays_zip("cells", "n_blocks")).alias("c")) \
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("c.n_blocks") - 1))).withColumn("cell", F.col("c.cells")).drop("c")
        load = asks.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("pieces"))
        asked = asks.join(load, ["cell", "block"]).select(
            "cell", "block", F.pmod(F.xxhash64("a"), F.col("pieces")).cast("int").alias("piece"), F.lit(True).alias("ask"), "a", F.col("anchor_id").alias("id"), "label", "v", "lo", "hi")
        held = index.join(load, ["cell", "block"]).select(
            "cell", "block", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(False).alias("ask"), F.lit(0).cast("long").alias("a"),
            F.col("vec_id").alias("id"), "label", "v", F.lit(None).cast("array<long>").alias("lo"), F.lit(None).cast("array<long>").alias("hi"))
        hits = asked.unionByName(held).groupBy("cell", "block", "piece").applyInArrow(_search(dim, n, same), "a long, w int, id long, s long")
        best = C.cut((hits if best is None else hits.unionByName(best)).withColumn("r", F.row_number().over(top)).filter(F.col("r") <= n).drop("r"), "best")
        # what a row must score to change a window: its floor, or the n-th score found so far
        reach = best.groupBy("a", "w").agg(F.count(F.lit(1)).alias("c"), F.min("s").alias("m")).filter(F.col("c") == n).groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("w", "m"))).alias("m"))
        floor = F.array_min(F.transform(F.col("lo"), lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("m", w), x))))
        state = C.cut(plan.filter("more").select("a", "anchor_id", "label", "v", "lo", "hi", "at").join(reach, "a", "left").withColumn("stop", floor).drop("m"), "asks")
        if state.isEmpty():
            return best
        budget *= GROW


def hard_negatives(vectors: DataFrame, is_anchor: Column, n: int = 5, share: tuple[int, int] = (80, 100), id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str | Column = "label", block: int = BLOCK, piece: int = PIECE, first_budget: int = FIRST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where
    ``is_anchor`` (a column over ``vec_id``): of each of its first ``n`` positives, the first ``n`` rows of
    other labels that score at most what the positive does and at least ``share`` of it."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("x"))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                 & F.coalesce(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    dim = v.agg(F.max(F.size("x"))).first()[0]
    if dim is None:
        return empty
    most = min(int(((HIGH / max(dim, 1)) ** 0.5)) - 1, (1 << 31) - 1)
    v = v.filter(F.forall("x", lambda x: F.abs(x) < most // 256)) \
        .select("vec_id", "label", F.concat(F.transform("x", lambda x: F.floor(x * 256).cast("int")), F.array_repeat(F.lit(0), F.lit(dim) - F.size("x"))).alias("v"))
    dim = max(dim, 1)
    v = v.withColumn("v", F.when(F.size("v") == 0, F.array(F.lit(0))).otherwise(F.col("v")))
    v = C.cut(v.withColumns({"h1": F.xxhash64("label", "v"), "h2": F.xxhash64(F.lit(13), "label", "v")}).dropDuplicates(["vec_id", "h1", "h2"]), "integers")
    small = Window.partitionBy("h1", "h2").orderBy("vec_id")
    rows = C.cut(v.withColumn("r", F.row_number().over(small)).filter(F.col("r") <= n + 1).select("vec_id", "label", "v"), "rows")
    anchors = v.filter(is_anchor).select(F.xxhash64("vec_id", "h1", "h2").alias("a"), F.col("vec_id").alias("anchor_id"), "label", "v")

    total = rows.count()
    if not total:
        return empty
    sample = _matrix(rows.orderBy(F.xxhash64(F.lit(7), "vec_id"), "vec_id", "label", "v").limit(SAMPLE_ROWS).select("v").toArrow()["v"].combine_chunks(), dim).astype(float)
    codes, cut_at = max(1, min(MAX_CODES, int(total ** 0.25))), dim // 2
    books = [kmeans(sample[:, :cut_at], codes), kmeans(sample[:, cut_at:], codes)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"), dim).astype(float)
                (c1, r1), (c2, r2) = nearest_code(x[:, :cut_at], books[0]), nearest_code(x[:, cut_at:], books[1])
                yield pa.record_batch([b.column("vec_id"), b.column("label"), b.column("v"), pa.array((c1 * len(books[1]) + c2).astype(np.int32)), pa.array(r1), pa.array(r2)],
                                      names=["vec_id", "label", "v", "cell", "r1", "r2"])
    index = C.cut(rows.mapInArrow(place, "vec_id long, label long, v array<int>, cell int, r1 double, r2 double"), "index")
    cells = Cells(books, index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect(), block)
    sizes = spark.createDataFrame([(int(c), cells.blocks(c)) for c in np.flatnonzero(cells.rows)], "cell int, n int")  # at most MAX_CODES squared rows
    index = index.join(F.broadcast(sizes), "cell").select(
        "vec_id", "label", "v", "cell", F.pmod(F.xxhash64(F.lit(3), "vec_id", "label", "v"), F.col("n")).cast("int").alias("block"))

    def ask(df: DataFrame, lo: Column, hi: Column, stop: Column) -> DataFrame:
        return C.cut(df.select("a", "anchor_id", "label", "v", lo.alias("lo"), hi.alias("hi"), F.lit(0).alias("at"), stop.alias("stop")), "asks")
    everything = [F.array(F.lit(x).cast("long")) for x in (LOW, HIGH)]
    first = ask(anchors, *everything, F.lit(LOW).cast("long"))
    positives = _rounds(first, index, cells, dim, n, True, piece, first_budget)
    by_score = Window.partitionBy("a").orderBy(F.desc("s"), "id")
    ranked = C.cut(positives.select("a", F.col("id").alias("positive_id"), F.col("s").alias("positive_score"), (F.row_number().over(by_score) - 1).alias("w")), "positives")
    num, den = share
    # the window of a positive: share * score <= negative score <= score (there is none below zero)
    least = F.when(F.col("positive_score") < 0, F.lit(HIGH)).otherwise(F.ceil(F.col("positive_score").cast("decimal(38,0)") * num / den).cast("long"))
    windows = ranked.withColumn("least", least).groupBy("a").agg(F.array_sort(F.collect_list(F.struct("w", "least", "positive_score"))).alias("p"))
    lo, hi = F.transform(F.col("p"), lambda p: p["least"]), F.transform(F.col("p"), lambda p: p["positive_score"])
    fill = lambda c, x: F.concat(c, F.array_repeat(F.lit(x).cast("long"), F.lit(n) - F.size("p")))
    second = ask(first.drop("lo", "hi", "at", "stop").join(windows, "a"), fill(lo, HIGH), fill(hi, LOW), F.array_min(lo))
    negatives = _rounds(second, index, cells, dim, n, False, piece, first_budget)
    by_score = Window.partitionBy("a", "w").orderBy(F.desc("s"), "id")
    return negatives.withColumn("rank", F.row_number().over(by_score)).join(ranked, ["a", "w"]).join(first.select("a", "anchor_id"), "a").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("s").alias("negative_score"))
