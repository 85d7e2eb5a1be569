"""Helpers that several operators share: shared-folder tables, hashing of words in numpy,
gapless ranks and connected components.

Row conventions of all operators: a row whose id is null cannot be addressed by any result
and is left out; a null text counts as an empty one; repeated rows are treated as separate
documents unless an operator says otherwise; only the named columns are read, so extra or
clashing columns do no harm.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scope, cut_lineage, fresh_path, shared_dir, ship  # noqa: F401

U64 = np.uint64


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (survives lost executors)."""
    return cut_lineage(df, f"llm-{label}")


def id_text(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)`` of the rows that have an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter(F.col("doc_id").isNotNull())


def buckets_for(spark: SparkSession) -> int:
    """A hash-bucket count that follows the session's shuffle width."""
    return max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---- hashing in numpy ------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds) over an uint64 array."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def odd_multipliers(n: int, salt: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) | U64(1)


class WordHasher:
    """64-bit hashes of the words of byte strings, A-Z lower-cased.

    ``separators``: the byte values that end a word. A word's hash is a sum of per-byte
    random values times per-position odd multipliers, finalised with its length, so two
    different words collide with probability about 2**-64.
    """

    def __init__(self, separators: Iterable[int], seed: int = 7):
        self.word = np.ones(256, dtype=bool)
        self.word[list(separators)] = False
        table = mix64(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93) + U64(seed))
        low = np.arange(256)
        low[65:91] += 32
        self.table, self.seed = table[low], seed
        self.mult = odd_multipliers(256, seed)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, first word of each text plus a total, byte start and end of each word
        within the joined buffer); texts are joined by a newline, which must be a separator."""
        n = len(texts)
        lens = np.fromiter(map(len, texts), np.int64, n)
        doc_at = np.zeros(n + 1, np.int64)
        np.cumsum(lens + 1, out=doc_at[1:])
        a = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        w = self.word[a]
        edge = np.diff(w.view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return np.zeros(0, U64), np.zeros(n + 1, np.int64), starts, ends
        length = ends - starts
        longest = int(length.max())
        if longest > len(self.mult):
            self.mult = odd_multipliers(longest, self.seed)
        first = np.zeros(len(starts), np.int64)
        np.cumsum(length[:-1], out=first[1:])
        total = int(length.sum())
        whole = np.int32 if total < 1 << 31 else np.int64
        rel = np.arange(total, dtype=whole)
        rel -= np.repeat(first.astype(whole), length)
        vals = self.table[a[w]]
        vals *= self.mult[rel]
        h = np.add.reduceat(vals, first)
        h = mix64(h + length.astype(U64) * U64(0x9E3779B97F4A7C15))
        return h, np.searchsorted(starts, doc_at), starts, ends


def give_back() -> None:
    """Hand memory that a task has freed back to the system: the Python worker is reused, and stays
    beside the executor while other tasks run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can do it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of each slice stays near ``limit`` bytes (one row at least);
    every row is passed on, a row longer than the limit makes a slice of its own."""
    import pyarrow.compute as pc
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype(np.int64)
        total = np.cumsum(size)
        i = 0
        while i < b.num_rows:
            base = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, base + limit, "right")))
            yield b.slice(i, j - i)
            i = j
    give_back()


def utf8(col: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes, null as empty."""
    return [x or b"" for x in col.cast(pa.large_binary()).to_pylist()]


#: Rows of a list of ids (8 bytes each) that may be broadcast; a longer list joins by shuffle.
BROADCAST_IDS = 1_000_000


def semi(big: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """``big`` rows whose ``on`` occurs in ``ids``: the id list is counted, broadcast while it has
    at most BROADCAST_IDS rows, else joined by shuffle. ``ids`` should be a written table."""
    few = ids.count() <= BROADCAST_IDS
    return big.join(F.broadcast(ids) if few else ids, on, "left_semi")


# ---- ranks and components --------------------------------------------------------------

def gapless_rank(df: DataFrame, group: str, order: list[str], out: str, n_buckets: int) -> DataFrame:
    """``out``: 0, 1, 2, ... within each ``group``, without sending a group through one task.

    Rows are dealt into hash buckets of ``order``; bucket counts are summed to offsets and
    each row adds its place in its own bucket, so the unit of work is (group, bucket). The
    order is that of (bucket, order columns): any fixed order, not the sorted one. ``df`` is
    read twice and should be a written table."""
    b = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(n_buckets)))
    counts = b.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(group, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    own = Window.partitionBy(group, "__b").orderBy(*order)
    r = b.withColumn("__r", F.row_number().over(own))
    return r.join(base, [group, "__b"]) \
        .withColumn(out, (F.col("__base") + F.col("__r") - 1).cast("long")).drop("__b", "__r", "__base")


def _alternate(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step over ``e(a, b)``, where a > b."""
    # large-star: larger neighbours of u go to min(u and its neighbours)
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    e = e.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    # small-star: smaller neighbours of u, and u itself (in the row of the smallest), go to the smallest of them
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    return e.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def parents(edges: DataFrame, label: str = "cc") -> DataFrame:
    """``(node, comp)`` for the nodes of ``edges(a, b)`` that are not the smallest of their component;
    ``comp`` is the smallest node reachable.

    Alternates large-star and small-star steps: every node sends its larger neighbours, then
    its smaller ones, to the smallest node it knows, until every node hangs below one that hangs
    below no other: these are the components, so no further step is taken to see that nothing changes.
    Each step is one aggregate (combined before the shuffle) and one join that Spark may split
    by skew; every second round is written to the shared folder. Nothing is collected but one row of counts."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    while True:
        e = cut(_alternate(_alternate(e)), label)
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
            e.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        open_ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")) \
            .filter("below > 1 OR below = 1 AND above = 1").agg(F.count(F.lit(1))).first()[0]
        if not open_ends:
            return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """``(node, comp)`` for the nodes of ``edges(a, b)``; ``comp`` is the smallest node reachable (see ``parents``)."""
    p = parents(edges, label)
    return p.unionByName(p.select(F.col("comp").alias("node"), "comp").distinct())


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def hexhash(col: Column) -> Column:
    return F.sha2(col, 256)
