"""Corpus files end to end: numbered lines, chunk files, one converted file per input.

A *unit* is what a folder of a corpus lists: ``name.jsonl`` is a plain file, or a folder of
ordered part files as a distributed writer leaves it. Lines are numbered over all units in
the order of their names, without moving a line: rows of one file split keep their order, so
a line's number is the count of lines in the splits before it (a sum over one row a split)
plus its place in its own split.

Units are written from rows keyed by unit and line number: one shuffle by ranges of line
numbers, so a large unit is written by several tasks whose part files sort in line order.
A unit appears under its name only when it is whole (written aside, then moved), and one
that is there already is not written again.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import joins as J
from ..session import cut_lineage, fresh_path, working_tables
from . import corpus as K

UNIT_BYTES = 128 << 20  # text that one task writes of a unit, about
MOVERS = 8  # units that the driver moves at a time


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def unit_names(spark: SparkSession, path: str) -> list[str]:
    """The units in a folder, by name; none if there is no such folder."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith(("_", ".")))


def read_numbered(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """S01 + S02: ``(line_no, unit, nbytes, value)`` of all lines of the units that match ``glob``,
    numbered from 1. ``nbytes`` counts the line end (P05) except at the end of a file that lacks it
    (seen by the file's size; where lines end in two characters it cannot be told and counts).

    The lines are written once to the shared folder: numbers and texts must come from one and the
    same reading, and whatever follows reads that table instead of the files."""
    p, fs = _path(spark, path)
    base = fs.makeQualified(p).toUri().getRawPath().rstrip("/") + "/"
    try:
        raw = spark.read.text(f"{path.rstrip('/')}/{glob}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "line_no long, unit string, nbytes long, value string")
    file = F.col("_metadata.file_path")
    raw = raw.select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"),
                     F.monotonically_increasing_id().alias("i"))
    lines = cut_lineage(raw, "lines")
    splits = lines.groupBy("file", "block").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("file_size").alias("file_size"))
    below = F.substring_index("file", base, -1)
    name = F.substring_index("file", "/", -1)
    # part files of more than five digits would sort before shorter ones
    order = [F.col("unit"), F.when(name.startswith("part-"), F.length(name)).otherwise(0), F.col("file"), F.col("block")]
    of_file = Window.partitionBy("file")
    splits = splits.withColumn("unit", F.url_decode(F.replace(F.substring_index(below, "/", 1), F.lit("+"), F.lit("%2B")))) \
        .withColumn("open", (F.sum("bytes").over(of_file) == F.col("file_size") + 1) & (F.col("block") == F.max("block").over(of_file))) \
        .withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .select("file", "block", "unit", "first", "n", "open", "before")      # one row a split
    j = lines.join(F.broadcast(splits) if J.fits_broadcast(splits) else splits, ["file", "block"])
    place = F.col("i") - F.col("first")
    size = F.octet_length("value") + F.when(F.col("open") & (place == F.col("n") - 1), 0).otherwise(1)
    return j.select((F.col("before") + place + 1).alias("line_no"), "unit", size.cast("bigint").alias("nbytes"), "value")


def _move_units(spark: SparkSession, fs, places: Mapping[str, str]) -> None:
    """Move the folders of units to their names, MOVERS at a time; a unit without lines has none and comes out empty.
    Each unit costs the driver a few calls only: the class and the file system are looked up once."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def move(place: tuple[str, str]) -> None:
        source, unit = path(place[0]), path(place[1])
        if fs.exists(source):
            fs.rename(source, unit)
        else:
            fs.mkdirs(unit)
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(move, places.items()))


def write_units(rows: DataFrame, path: str, names: Mapping[int, str], nbytes: int) -> list[str]:
    """``rows(unit_no, line_no, value)`` of about ``nbytes`` bytes as units of ``path``, lines
    in order; ``names`` maps unit numbers to unit names. Units that exist are skipped. Returns the names written."""
    spark = rows.sparkSession
    there = set(unit_names(spark, path))
    todo = {k: n for k, n in names.items() if n not in there}
    if not todo:
        return []
    if len(todo) < len(names):
        wanted = spark.createDataFrame([(k,) for k in todo], "unit_no long")
        rows = rows.join(F.broadcast(wanted) if len(todo) <= J.BROADCAST_MAX_ROWS else wanted, rows["unit_no"].cast("long") == wanted["unit_no"], "left_semi")
    with working_tables(spark):
        aside = fresh_path(spark, "units")
        # making a file takes longer than filling a small one: no fewer tasks than cores, if there are units enough
        tasks = max(1, min(len(todo), spark.sparkContext.defaultParallelism), -(-nbytes // UNIT_BYTES))
        # the writer keeps an order that begins with the partition column
        rows.repartitionByRange(tasks, "line_no").sortWithinPartitions("unit_no", "line_no") \
            .select("unit_no", "value").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("unit_no").text(aside)
        target, fs = _path(spark, path)
        fs.mkdirs(target)
        _move_units(spark, fs, {f"{aside}/unit_no={k}": f"{path.rstrip('/')}/{name}" for k, name in todo.items()})
    return [todo[k] for k in sorted(todo)]


def split_files(spark: SparkSession, source: str, target: str, limit: int = C.CHUNK_LIMIT_BYTES, sample: bool = False, glob: str = "*.jsonl", prefix: str = C.CHUNK_PREFIX) -> list[str]:
    """S01 -> P06 -> S04: the lines of ``source`` as chunk units ``miniCorpus_n.jsonl`` of at most ``limit``
    bytes; ``sample`` writes the first chunk only (P07). Nothing is done if ``target`` exists (S06)."""
    if unit_names(spark, target):
        return []
    with working_tables(spark):
        lines = read_numbered(spark, source, glob)
        sizes = lines.select("line_no", "nbytes")
        if sample:
            chunks = K.first_chunk(sizes, limit).withColumn("chunk_no", F.lit(1))
        else:
            chunks = K.next_fit_chunks(sizes, limit)
        keyed = cut_lineage(lines.join(chunks.select("line_no", "chunk_no"), "line_no").select(F.col("chunk_no").alias("unit_no"), "line_no", "nbytes", "value"), "keyed")
        seen = keyed.agg(F.max("unit_no").alias("last"), F.sum("nbytes").alias("nbytes")).first()
        return write_units(keyed, target, {n: f"{prefix}{n}.jsonl" for n in range(1, (seen["last"] or 0) + 1)}, int(seen["nbytes"] or 0))


def convert_files(spark: SparkSession, source: str, target: str, glob: str = "*.jsonl") -> list[str]:
    """S02 -> S03 -> P01-P03 -> S05: every unit of ``source`` parsed, filtered and written as a unit of the
    same name with ``{"id": ..., "contents": ...}`` lines in the order of the input. Units that ``target`` holds
    are not converted again (S06); one whose lines are all dropped comes out empty."""
    import fnmatch
    names = [n for n in unit_names(spark, source) if fnmatch.fnmatchcase(n, glob)]
    numbers = spark.createDataFrame(list(enumerate(names)), "unit_no long, unit string")   # one row a unit
    with working_tables(spark):
        lines = read_numbered(spark, source, glob).join(F.broadcast(numbers) if len(names) <= J.BROADCAST_MAX_ROWS else numbers, "unit")
        nbytes = int(lines.agg(F.sum("nbytes")).first()[0] or 0)
        docs = K.convert(K.parse_raw(lines.select("unit_no", "line_no", "value")), keep=("unit_no", "line_no"))
        rows = docs.select("unit_no", "line_no", F.to_json(F.struct("id", "contents")).alias("value"))
        return write_units(rows, target, dict(enumerate(names)), nbytes)


def read_converted(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """``(docid, contents)`` of converted units, as the index takes it."""
    lines = spark.read.text(f"{path.rstrip('/')}/{glob}")
    return lines.select(F.from_json("value", "id STRING, contents STRING").alias("j")).select(F.col("j.id").alias("docid"), "j.contents")


def prepare_corpus(spark: SparkSession, source: str, work: str, limit: int = C.CHUNK_LIMIT_BYTES, glob: str = "*.jsonl") -> DataFrame:
    """From raw files to the corpus of the index: split into chunks, convert each, read what came out. Every
    step that is done already is skipped."""
    split_files(spark, source, f"{work}/chunks", limit, glob=glob)
    convert_files(spark, f"{work}/chunks", f"{work}/converted")
    return read_converted(spark, f"{work}/converted")
