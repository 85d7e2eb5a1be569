"""Corpus preparation.

Raw corpus lines are JSON objects ``{id, url, title, text}`` (every key optional);
they are parsed with a declared schema, filtered and turned into the converted
shape ``{id, contents = title\\nurl\\ntext}``. The size-bounded split (P06) reproduces
the greedy next-fit rule exactly without any single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..session import cut_lineage, fresh_path
from . import sinks

RAW_FIELDS = "id: STRING, url: STRING, title: STRING, text: STRING"


# --- S01 / S02 / S03 -----------------------------------------------------------------------

def read_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """S01 + S02: text lines of the matching files in a directory, with the file and the
    byte offset of the split they came from (stable line order inside a file)."""
    return spark.read.option("pathGlobFilter", glob).text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"))


def parse_raw(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Tolerant parse with a declared schema. Malformed lines (bad JSON, single quotes,
    text after the object, JSON that is not an object, blank lines) are dropped, never by
    looking at the id."""
    p = lines.withColumn("_j", T.parse_json_strict(F.col(value_col), RAW_FIELDS))
    keep = [c for c in lines.columns if c != value_col]
    return p.filter(F.col("_j").isNotNull()).select(*keep, "_j.id", "_j.url", "_j.title", "_j.text")


def convert(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(keep..., id, contents)``; id trimmed, rows without id or text dropped
    (whitespace-only text is kept), missing title/url become empty."""
    rid = T.strip(F.col("id"))
    whole = rid.isNotNull() & (rid != "") & F.col("text").isNotNull() & (F.col("text") != "")
    contents = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("url", F.lit("")), F.col("text"))
    return raw.filter(whole).select(*keep, rid.alias("id"), contents.alias("contents"))


def pages_as_raw(pages: DataFrame) -> DataFrame:
    """Raw records from ``pages``: id, url, title from the html ``<title>``, text = html."""
    return pages.select(F.col("page_id").cast("string").alias("id"), "url",
                        F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"),
                        F.col("html").alias("text"))


def raw_lines_from_documents(documents: DataFrame) -> DataFrame:
    """``(line_no, value)``: the documents as a raw JSONL corpus, one line per document
    in ``doc_id`` order."""
    return documents.select(F.col("doc_id").alias("line_no"),
                            F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text"))).alias("value"))


# --- S05 / S06 round trip -----------------------------------------------------------------------

def write_and_read_converted(spark: SparkSession, converted: DataFrame) -> DataFrame:
    """S05 -> S02/S01 -> parse: write ``{id, contents}`` lines to a fresh folder under
    the shared directory and read them back. Spark names its text parts ``*.txt``."""
    path = fresh_path(spark, "converted")
    sinks.write_converted_jsonl(converted, path, mode="ignore")
    lines = read_lines(spark, path, glob="*.txt")
    return lines.select(F.from_json("value", "id STRING, contents STRING").alias("j")).select("j.id", "j.contents")


# --- P05 / P06 / P07 -----------------------------------------------------------------------------

def line_bytes(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """UTF-8 bytes of each line including its newline (kept where the reader has counted them)."""
    if "nbytes" in lines.columns:
        return lines
    return lines.withColumn("nbytes", (F.octet_length(value_col) + 1).cast("bigint"))


PARTITION_BYTES = 128 * 1024 * 1024


def prefix_sums(lines: DataFrame, order_col: str = "line_no", size_col: str = "nbytes",
                partitions: int | None = None) -> DataFrame:
    """Running byte offsets ``st`` (before the line) and ``en`` (after it), two-phase:
    range-partition by line order, total each partition, turn the (few) totals into
    offsets, add each partition's running sum. Partitions are sized by bytes (about
    128 MB each, at least one per core), so each running-sum window stays small at any
    corpus size. Written to the shared folder so a re-run after executor loss sees the
    same partition ids."""
    par = lines.sparkSession.sparkContext.defaultParallelism
    if partitions is None:
        total = lines.agg(F.sum(size_col)).first()[0] or 0
        partitions = max(par, -(-int(total) // PARTITION_BYTES))
    n = partitions
    r = cut_lineage(lines.repartitionByRange(n, order_col).withColumn("_pid", F.spark_partition_id()), "ranged")
    totals = r.groupBy("_pid").agg(F.sum(size_col).alias("_tot"))          # one row per partition
    offs = totals.select("_pid", F.coalesce(F.sum("_tot").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    j = r.join(offs, "_pid")     # one row per partition
    en = (F.col("_off") + F.sum(size_col).over(w)).cast("bigint")
    return j.withColumn("en", en).withColumn("st", F.col("en") - F.col(size_col)).drop("_pid", "_off")


def next_start(pos: DataFrame, limit: int, total: int) -> DataFrame:
    """``(s, t)``: if a chunk starts at line start ``s``, the next one starts at ``t``.

    The chunk from ``s`` holds the lines ending at or before ``s + limit``, so ``t`` is the
    start of the line covering byte ``s + limit`` — unless that line is the one starting
    at ``s`` (a line longer than the limit gets a chunk of its own: ``t`` is its end).

    Line starts and probes ``s + limit`` are merged in one order of byte positions: the
    covering line of a probe is the largest line start before it. The merge is range
    partitioned; a partition's first probes take the largest start of the partitions before
    it (one row a partition)."""
    starts = pos.select(F.col("st").alias("v"), F.lit(0).alias("kind"), "st", "en")
    probes = pos.filter(F.col("st") + limit < total).select((F.col("st") + limit).alias("v"), F.lit(1).alias("kind"), "st", "en")
    n = max(pos.sparkSession.sparkContext.defaultParallelism, int(pos.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    merged = cut_lineage(starts.unionByName(probes).repartitionByRange(n, "v", "kind")
                         .withColumn("_pid", F.spark_partition_id()), "merged")
    own = F.when(F.col("kind") == 0, F.col("st"))
    carry = merged.groupBy("_pid").agg(F.max(own).alias("_top")).select("_pid", F.max("_top").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w = Window.partitionBy("_pid").orderBy("v", "kind").rowsBetween(Window.unboundedPreceding, 0)
    cover = merged.withColumn("c", F.max(own).over(w)).filter("kind = 1").join(carry, "_pid") \
        .withColumn("c", F.coalesce("c", "_carry"))
    t = F.when(F.col("c") == F.col("st"), F.col("en")).otherwise(F.col("c"))
    tail = pos.filter(F.col("st") + limit >= total).select(F.col("st").alias("s"), F.lit(total).cast("bigint").alias("t"))
    return cover.select(F.col("st").alias("s"), t.cast("bigint").alias("t")).unionByName(tail)


def chunk_starts(pos: DataFrame, limit: int, total: int) -> DataFrame:
    """``(s)``: start offsets of the next-fit chunks, the nodes reachable from offset 0 along
    ``next_start``. Pointer doubling — ``A <- A + J(A)``, ``J <- J o J`` — reaches the end
    after about log2(#chunks) rounds; each round is one join of the jump table with itself.
    Jumps that have reached the end leave the table, so the end is never a hot key."""
    spark = pos.sparkSession
    jump = cut_lineage(next_start(pos, limit, total).filter(F.col("t") < total), "jump")
    reached = spark.createDataFrame([(0,)], "s long")
    while not jump.isEmpty():
        step = jump.join(reached, "s").select(F.col("t").alias("s"))
        reached = cut_lineage(reached.unionByName(step).distinct(), "reached")
        jump = cut_lineage(jump.join(jump.select(F.col("s").alias("t"), F.col("t").alias("u")), "t").select("s", F.col("u").alias("t")), "jump")
    return reached


def next_fit_chunks(lines: DataFrame, limit: int = C.CHUNK_LIMIT_BYTES, order_col: str = "line_no") -> DataFrame:
    """``(order_col, nbytes, st, en, chunk_no)`` (chunks from 1) for every line, equal to the
    sequential greedy rule: close the chunk before a line when it would exceed ``limit`` and
    is not empty. Only numbers move: join the texts back by ``order_col``.

    A line's chunk is the number of chunk starts up to it: a second prefix sum, over marks."""
    sizes = line_bytes(lines).select(order_col, "nbytes")
    pos = cut_lineage(prefix_sums(sizes, order_col), "offsets")
    total = pos.agg(F.max("en")).first()[0] or 0
    begins = chunk_starts(pos.select("st", "en"), limit, total).select(F.col("s").alias("st"), F.lit(1).cast("bigint").alias("mark"))
    marked = pos.join(begins, "st", "left").select(order_col, "nbytes", F.struct("st", "en").alias("at"), F.coalesce("mark", F.lit(0)).cast("bigint").alias("mark"))
    numbered = prefix_sums(marked, order_col, "mark", partitions=max(1, -(-int(total) // PARTITION_BYTES)))
    return numbered.select(order_col, "nbytes", "at.st", "at.en", F.col("en").cast("int").alias("chunk_no"))


def first_chunk(lines: DataFrame, limit: int = C.CHUNK_LIMIT_BYTES, order_col: str = "line_no") -> DataFrame:
    """The sample mode keeps chunk 1 only: the lines that end within ``limit``, and the first
    line whatever its size. A prefix sum is all it needs."""
    pos = prefix_sums(line_bytes(lines).select(order_col, "nbytes"), order_col)
    return pos.filter((F.col("en") <= limit) | (F.col("st") == 0))
