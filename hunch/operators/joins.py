"""Join strategies whose choice depends on a checked size.

``broadcast`` is only applied after counting the side to be shipped; beyond the bound
the same join runs as a shuffle join, salted on the keys known to be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side above this many rows or bytes is shuffled instead.
BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES = 1_000_000, 64 << 20
# A join key with more rows than this is spread over as many tasks as it has multiples of it.
HOT_ROWS = 1_000_000


def _row_bytes(df: DataFrame):
    """Estimated bytes of a row: string lengths, a flat 16 for everything else (and its overhead)."""
    parts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16 if f.dataType.simpleString() == "string"
             else F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(16))
             if f.dataType.simpleString().startswith(("array", "map", "struct")) else F.lit(16) for f in df.schema.fields]
    return sum(parts, F.lit(0))


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and BROADCAST_MAX_BYTES bytes (measured, not
    estimated from statistics)."""
    return measured(df, max_rows=max_rows)[0]


def small(df: DataFrame) -> DataFrame:
    """``df`` for a join: marked for broadcast if it fits, else as it is."""
    return F.broadcast(df) if fits_broadcast(df) else df


def measured(df: DataFrame, gather: Column | None = None, max_rows: int | None = None) -> tuple[bool, list | None]:
    """Whether ``df`` may be broadcast and, if so, the distinct values of ``gather`` (a column with few
    values by construction), in one job."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    also = F.lit(None).cast("int") if gather is None else gather
    r = df.select(_row_bytes(df).cast("bigint").alias("b"), also.alias("g")).limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"), F.collect_set("g").alias("g")).first()
    fits = r["n"] <= max_rows and (r["b"] or 0) <= BROADCAST_MAX_BYTES
    return fits, sorted(r["g"]) if fits and gather is not None else None


def salted_join(small: DataFrame, big: DataFrame, key: str, hot: DataFrame, spread_col: str = "docid") -> DataFrame:
    """Inner equi-join on ``key`` for two sides too large to broadcast.

    ``hot(key, rows)`` lists the keys with more than HOT_ROWS rows of ``big`` (at most
    total / HOT_ROWS of them). Such a key is spread over ``ceil(rows / HOT_ROWS)`` salts by
    ``hash(spread_col)`` and the matching rows of ``small`` are repeated once a salt, so no
    task gets many more than HOT_ROWS rows of one key however frequent it is.
    """
    hot_k = hot.groupBy(key).agg(F.ceil(F.max("rows") / HOT_ROWS).cast("int").alias("_salts"))
    if fits_broadcast(hot_k):
        hot_k = F.broadcast(hot_k)
    b = big.join(hot_k, key, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.hash(F.col(spread_col)), F.col("_salts"))).otherwise(F.lit(0))
    ).drop("_salts")
    s = small.join(hot_k, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return b.join(s, [key, "_salt"]).drop("_salt")
