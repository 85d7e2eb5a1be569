"""Operator 5: line dedup over levelled sorted runs of line hashes (DataFrame functions only).

The state is a set of runs: tables ``(k1, k2, owner)`` bucketed and sorted by a 128-bit line
hash, with the document that owns the line. Documents come in batches of ascending ids. A
batch reduces its lines to one row per hash and smallest document, merge-anti-joins every
run (both sides are hash-dealt and sorted alike, so the runs are not shuffled again), and
what is left becomes a new run. A line stays where its document is the owner in the new
run; all its other copies go. When a level holds ``fanout`` runs they are merged into one
run of the next level, so a key is read from at most fanout * log(batches) runs.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased;
keys under ``min_chars`` code points are never dropped. Two different lines share a 128-bit
hash with negligible probability.

Results: one row per row with an id. Null or empty text is one empty line and keeps the
empty text. Repeated rows all own their lines, so none of them loses lines to the other.
Empty table: no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"
KEY = ["k1", "k2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


class LineRuns:
    """The runs of one corpus, by level; ``add`` takes the next batch of documents."""

    def __init__(self, spark: SparkSession, fanout: int = 2, min_chars: int = 10):
        self.spark, self.fanout, self.min_chars = spark, fanout, min_chars
        self.levels: list[list[str]] = [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, df: DataFrame) -> str:
        name = C.unique_name("line_run")
        if (scope := C.Scope.current()) is not None:
            scope.tables.append(name)
        df.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY) \
            .option("path", C.fresh_path(self.spark, name)).format("parquet").saveAsTable(name)
        return name

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            runs = self.levels[level]
            if len(runs) >= self.fanout:
                merged = self._write(reduce(DataFrame.unionByName, [self.spark.table(r) for r in runs]))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(merged)
                self.levels[level] = []
            level += 1

    def add(self, docs: DataFrame) -> DataFrame:
        """``docs(doc_id, text)``, all ids above those of earlier batches -> ``doc_id, h, n_lines,
        n_dropped, text`` with the kept lines and the hash of the given text. The new run is written here; the rows are lazy."""
        self._compact()
        d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
        each = d.select("doc_id", "h", F.posexplode(_lines(F.translate("text", UPPER, LOWER))).alias("pos", "line"))
        key = F.btrim("line", F.lit(BLANKS))
        lines = C.cut(each.select("doc_id", "h", "pos", key.alias("key")).filter(F.length("key") >= self.min_chars).select(
            "doc_id", "h", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(20261203), "key").alias("k2")), "lines")
        fresh = lines.groupBy(*KEY).agg(F.min("doc_id").alias("owner"))
        for run in (r for level in self.levels for r in level):
            fresh = fresh.join(self.spark.table(run).hint("merge"), KEY, "left_anti")
        run = self._write(fresh)
        self.levels[0].append(run)
        owned = self.spark.table(run).select(*KEY, F.col("owner").alias("doc_id"))
        # Joined with the document in the key: a line of a third of all documents is spread by document.
        gone = lines.join(owned, [*KEY, "doc_id"], "left_anti").groupBy("doc_id", "h").agg(F.collect_set("pos").alias("gone"))
        j = d.join(gone, ["doc_id", "h"], "left").withColumn("lines", _lines(F.col("text")))
        kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
        return j.select(
            "doc_id", "h", F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda p: F.get(F.col("lines"), p)), "\n")).alias("text"))


def line_dedup(docs: DataFrame, n_batches: int = 4, fanout: int = 2, min_chars: int = 10, with_hash: bool = False) -> DataFrame:
    """All of ``docs(doc_id, text)`` in ``n_batches`` batches of ascending ids (approximate
    quantiles cut them; any cut gives the same rows) -> ``doc_id, n_lines, n_dropped, text``, and with ``with_hash`` also ``h``,
    the hash of the given text (null as empty)."""
    d = C.id_text(docs)
    cuts = d.agg(F.percentile_approx("doc_id", [i / n_batches for i in range(1, n_batches)], 1000).alias("c")).first()["c"] or []
    edges = [None, *sorted(set(cuts)), None]
    runs, parts = LineRuns(docs.sparkSession, fanout, min_chars), []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        b = d if lo is None else d.filter(F.col("doc_id") > lo)
        parts.append(runs.add(b if hi is None else b.filter(F.col("doc_id") <= hi)))
    out = reduce(DataFrame.unionByName, parts)
    return out if with_hash else out.drop("h")
