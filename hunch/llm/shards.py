"""Operator 3: shards of near-equal bytes by longest-processing-time scheduling.

Rows of equal text form a group that must stay together. Groups above ``total / FINE``
bytes, of which there are at most ``FINE``, are scheduled one by one; all smaller groups are
dealt by hash into ``FINE`` bundles. So the heap sees at most ``2 * FINE`` items whatever
the input, largest first, each to the least-loaded shard. Rows then look up their group or
their bundle (both lists have that bound and are broadcast), so a group of any size is
never gathered; slots are distributed ranks.

Results: one row per row with an id. Null text counts as empty: size 1, CRC 0. Repeated
rows share a group and get slots of their own. Empty table: no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

FINE = 1 << 16


def schedule(sizes: np.ndarray, names: list[np.ndarray], n_shards: int) -> np.ndarray:
    """The shard of each item: largest first (ties by name) to the least-loaded shard."""
    out = np.zeros(len(sizes), np.int32)
    heap = [(0, s) for s in range(n_shards)]
    for i in np.lexsort([*reversed(names), -sizes]).tolist():
        load, s = heapq.heappop(heap)
        out[i] = s
        heapq.heappush(heap, (load + int(sizes[i]), s))
    return out


def lpt_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, size, text_crc32, shard, slot``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    t = C.cut(C.id_text(docs).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(3), text).alias("g2")), "sizes")
    groups = C.cut(t.groupBy("g1", "g2").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    big = F.col("bytes") * FINE > total
    one = groups.filter(big).select("g1", "g2", "bytes").toArrow()
    many = groups.filter(~big).groupBy(F.pmod("g1", F.lit(FINE)).alias("bundle")).agg(F.sum("bytes").alias("bytes")).toArrow()
    k = one.num_rows
    name = [np.asarray(pa.chunked_array([*a.chunks, *b.chunks], pa.int64())) for a, b in
            ((one["g1"], many["bundle"]), (one["g2"], many["bundle"]))]
    sizes = np.asarray(pa.chunked_array([*one["bytes"].chunks, *many["bytes"].chunks], pa.int64()))
    shard = schedule(sizes, name, n_shards)
    of_group = spark.createDataFrame(pa.table({"g1": one["g1"], "g2": one["g2"], "s1": pa.array(shard[:k], pa.int32())}))
    of_bundle = spark.createDataFrame(pa.table({"bundle": many["bundle"], "s2": pa.array(shard[k:], pa.int32())}))
    dealt = t.join(F.broadcast(of_group), ["g1", "g2"], "left") \
        .join(F.broadcast(of_bundle), F.pmod("g1", F.lit(FINE)) == F.col("bundle"), "left") \
        .select("doc_id", "size", "text_crc32", F.coalesce("s1", "s2").alias("shard"))
    return C.gapless_rank(C.cut(dealt, "dealt"), "shard", ["doc_id"], "slot", C.buckets_for(spark))
