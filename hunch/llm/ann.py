"""Operator 10: nearest neighbours by shifted space-filling curves.

Every vector is projected ``N_CURVES`` times by a random rotation to ``DIMS`` axes, shifted
and put on a Hilbert curve. Spark range-partitions each ordering, which gives every vector
its rank on every curve. A query's candidates are the vectors within ``window`` ranks of it
on any curve; they are scored exactly and the lists of all curves merged. The orderings are
cut into blocks of bounded size and a query visits the blocks that its windows touch.

The window is measured, not set: for ``SAMPLE`` queries the true neighbours are found by a
scan of all vectors, and the window is the rank distance (on the best curve) that covers
``TARGET`` of them. Clustered data get small windows; data without any structure, where no
ordering helps, get large ones.

Equal vectors are one entry with its smallest ids, so a vector that a third of all rows
share is indexed once and its copies are each other's neighbours.

Results: for each query row its ``k`` nearest, fewer only if there are fewer candidates.
Null ids and vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do vectors whose length is not the most common one; any finite magnitude does. Ties: smaller id first.
Rows that repeat id and vector count once. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

U64 = np.uint64
N_CURVES, DIMS, BITS, SAMPLE, TARGET, MIN_WINDOW, MAX_BLOCK = 16, 6, 10, 200, 0.95, 64, 8192


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of grid points ``x`` [n, dims] with ``bits`` bits an axis: Gray-code
    transform of the transposed coordinates, then interleaved bits, all points at once."""
    x = x.astype(U64)
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        bit, low = U64(1 << b), U64((1 << b) - 1)
        for i in range(dims):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, U64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), U64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, dims - 1] >> U64(b)) & U64(1) != 0, U64((1 << b) - 1), U64(0))
    x ^= turn[:, None]
    key = np.zeros(len(x), U64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << U64(1)) | ((x[:, i] >> U64(b)) & U64(1))
    return key


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1. The largest component becomes 1 first, so no square over- or underflows."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(fine, F.lit(False)))


def _axes(dim: int, n_curves: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(10)
    axes = [np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :min(DIMS, dim)] for _ in range(n_curves)]
    return np.concatenate(axes, 1), rng.random((n_curves, min(DIMS, dim)))


def _true_neighbours(reps: DataFrame, sample: list[tuple[int, list[float]]], dim: int, k: int) -> DataFrame:
    """``(query, near)``: the k nearest entries of each sampled query, by a scan of all."""
    ids = np.array([s[0] for s in sample], np.int64)
    q = _unit(np.array([s[1] for s in sample], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            own = np.asarray(b.column("vec_id"))
            s = q @ _unit(_matrix(b.column("v"), dim)).T
            s[ids[:, None] == own[None, :]] = -np.inf
            top = np.argsort(-s, 1, kind="stable")[:, :k]
            yield pa.record_batch([pa.array(np.repeat(ids, top.shape[1])), pa.array(own[top].ravel()), pa.array(np.take_along_axis(s, top, 1).ravel())],
                                  names=["query", "near", "s"])
    w = Window.partitionBy("query").orderBy(F.desc("s"), "near")
    return reps.mapInArrow(run, "query long, near long, s double").filter(F.col("s") > float("-inf")) \
        .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("query", "near")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            n_curves: int = N_CURVES, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` (a column over ``vec_id``)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = _valid(vectors, id_col, vec_col)
    common = v.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return empty
    dim = int(common["dim"])
    v = v.filter(F.size("v") == dim).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(5), "v"))
    # the k + 1 smallest ids of each distinct vector; Spark limits them before the shuffle
    small = Window.partitionBy("h1", "h2").orderBy("vec_id")
    v = C.cut(v.dropDuplicates(["vec_id", "h1", "h2"]), "vectors")
    entries = C.cut(v.withColumn("r", F.row_number().over(small)).filter(F.col("r") <= k + 1), "entries")
    reps = C.cut(entries.filter("r = 1").select("vec_id", "v", "h1", "h2"), "reps")
    of_class = reps.select("h1", "h2", F.col("vec_id").alias("rep"))
    queries = C.cut(v.filter(is_query).select(F.col("vec_id").alias("query_id"), "h1", "h2").join(of_class, ["h1", "h2"]).select("query_id", "rep"), "queries")
    asked = C.cut(queries.select("rep").distinct(), "asked")

    axes, shift = _axes(dim, n_curves)
    low = min(DIMS, dim)

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = _unit(_matrix(b.column("v"), dim)) @ axes
                yield pa.record_batch([pa.array(np.arange(p.shape[1])), pa.array(p.min(0)), pa.array(p.max(0))], names=["a", "lo", "hi"])
    box = reps.mapInArrow(extent, "a long, lo double, hi double").groupBy("a").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("a").toArrow()
    lo, span = np.asarray(box["lo"]), np.maximum(np.asarray(box["hi"]) - np.asarray(box["lo"]), 1e-12)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            p = (_unit(_matrix(b.column("v"), dim)) @ axes - lo) / span
            for c in range(n_curves):
                cells = np.clip((p[:, c * low:(c + 1) * low] + shift[c]) / 2, 0, 1) * ((1 << BITS) - 1)
                yield pa.record_batch([b.column("vec_id"), pa.array(np.full(b.num_rows, c, np.int32)), pa.array(hilbert(cells, BITS).view(np.int64))],
                                      names=["vec_id", "curve", "key"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            yield pa.record_batch([b.column("vec_id"), b.column("curve"), b.column("part"), pa.array(np.arange(at, at + b.num_rows))],
                                  names=["vec_id", "curve", "part", "i"])
            at += b.num_rows
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "key", "vec_id"]
    placed = C.cut(reps.mapInArrow(keys, "vec_id long, curve int, key long").repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("part", F.spark_partition_id()).mapInArrow(number, "vec_id long, curve int, part int, i long"), "placed")
    seen = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("i0"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("i0")).alias("base"))
    ranks = C.cut(placed.join(seen, ["curve", "part"]).select("vec_id", "curve", (F.col("i") + F.col("base")).alias("pos")), "ranks")

    # the window that covers ``target`` of the true neighbours of some queries
    some = reps.join(asked, F.col("vec_id") == F.col("rep"), "left_semi").orderBy(F.xxhash64(F.lit(1), "vec_id")).limit(SAMPLE)
    sample = [(r["vec_id"], r["v"]) for r in some.select("vec_id", "v").collect()]
    if not sample:
        return empty
    true = C.cut(_true_neighbours(reps, sample, dim, k), "true")
    rq = ranks.select(F.col("vec_id").alias("query"), "curve", F.col("pos").alias("pq"))
    rn = ranks.select(F.col("vec_id").alias("near"), "curve", F.col("pos").alias("pn"))
    apart = true.join(rq, "query").join(rn, ["near", "curve"]).groupBy("query", "near").agg(F.min(F.abs(F.col("pq") - F.col("pn"))).alias("d"))
    need = apart.agg(F.percentile("d", target).alias("w")).first()["w"]
    window = max(MIN_WINDOW, int(np.ceil(need or 0)))
    block = int(min(max(window, 256), MAX_BLOCK))

    at = ranks.join(reps.select("vec_id", "v"), "vec_id")
    cand = at.select("curve", F.floor(F.col("pos") / block).alias("block"), "vec_id", "pos", "v", F.lit(False).alias("q"))
    near = at.join(asked.withColumnRenamed("rep", "vec_id"), "vec_id", "left_semi")
    blocks = F.sequence(F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / block), F.floor((F.col("pos") + window) / block))
    ask = near.select("curve", F.explode(blocks).alias("block"), "vec_id", "pos", "v", F.lit(True).alias("q"))

    def search(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        q = np.asarray(t["q"])
        ids, pos = np.asarray(t["vec_id"]), np.asarray(t["pos"])
        out = [[], [], []]
        if q.any() and not q.all():
            u = _unit(_matrix(t["v"].chunk(0), dim))
            own, other = np.flatnonzero(q), np.flatnonzero(~q)
            for i in range(0, len(own), 256):
                a = own[i:i + 256]
                s = u[a] @ u[other].T
                s[np.abs(pos[a][:, None] - pos[other][None, :]) > window] = -np.inf
                n = min(k + 1, len(other))
                top = np.argpartition(-s, n - 1, 1)[:, :n]
                best = np.take_along_axis(s, top, 1)
                ok = np.isfinite(best)
                out[0].append(np.repeat(ids[a], n)[ok.ravel()])
                out[1].append(ids[other][top][ok])
                out[2].append(best[ok])
        kinds = (np.int64, np.int64, np.float64)
        cols = [np.concatenate(x).astype(d) if x else np.zeros(0, d) for x, d in zip(out, kinds, strict=True)]
        return pa.table({"rep": cols[0], "near": cols[1], "score": cols[2]})
    hits = ask.unionByName(cand).groupBy("curve", "block").applyInArrow(search, "rep long, near long, score double")
    by_score = Window.partitionBy("rep").orderBy(F.desc("score"), "near")
    best = hits.groupBy("rep", "near").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= k + 1)
    members = entries.join(of_class, ["h1", "h2"]).select(F.col("rep").alias("near"), "vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return queries.join(best.select("rep", "near", "score"), "rep").join(members, "near").filter("query_id <> vec_id") \
        .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
