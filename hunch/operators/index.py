"""Inverted index as ordinary tables (I01-I05, I13), built once to a path and opened from it.

Layout, chosen for a corpus far larger than any one machine:

* ``docs(docid, contents)`` — raw store, a copy of the corpus without an exchange.
* ``tokens(docid, dl, toks)`` — forward index, bucketed by ``docid``: the one pass that analyses
  text and the one exchange of the build. Document lengths are a column read of it.
* ``postings(term, docid, tf, dl, positions)`` — one row per (term, document), bucketed by ``docid``
  like ``tokens`` and sorted by ``term``, with a directory for each hash of the term (``part``). A
  bucket's postings come from the same bucket of ``tokens``, so no exchange, and a term that
  occurs in every document is spread over all buckets. Scores and phrases are computed within
  the buckets: with the query terms broadcast only the k best of each bucket move. A search
  reads the directories of its terms only; ``positions`` (sorted) is read by phrases only.
* ``repeated(docid)`` — ids that several rows have, and the null id. Rows of other ids are one document
  each, so a task can count and score them row by row.
* ``term_stats(term, df, cf)`` — ``groupBy(term)`` with map-side combine.
* ``stems(term, stem)`` — with a stemmer: the stems of the distinct terms, computed once a term.
* ``vectors(docid, vector)`` — on demand, grouped within the buckets of ``postings``.
* ``meta`` — written last: its presence means that the index is complete. It holds the manifest:
  what was indexed (source files with sizes and times, or a checksum of the rows), how (stop
  list, stemmer, format) and its fingerprint. A path is reused only for the same manifest, and
  table definitions carry the fingerprint, so a lasting catalog cannot mix two builds.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..session import app_scratch, remove_path, ship
from . import joins as J
from . import stem as S

FORMAT = 4       # of the tables below a path
TERM_PARTS = 16  # directories of the postings, by term hash
SLICE_TOKENS = 1 << 20  # tokens that a task counts at once (a longer document alone)


class IndexMismatch(ValueError):
    """The index at a path was built from other data or with other options."""


def corpus_from_documents(documents: DataFrame) -> DataFrame:
    """The converted-corpus shape ``(docid STRING, contents STRING)`` over ``documents``."""
    return documents.select(F.col("doc_id").cast("string").alias("docid"), F.col("text").alias("contents"))


def analysed(corpus: DataFrame, stop=C.INDEX_STOP_WORDS) -> DataFrame:
    """``(docid, dl, toks)``: indexed tokens of each document and their number (I02). A null document
    has no tokens."""
    toks = F.coalesce(T.index_terms("contents", stop), F.array().cast("array<string>"))
    return corpus.select("docid", toks.alias("toks")).select("docid", F.size("toks").cast("bigint").alias("dl"), "toks")


def part_of(term, parts: int):
    """The directory of a term."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def postings(tokens: DataFrame, stems: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """I01 + I13 ``(term, docid, tf, dl, positions)`` from ``analysed`` documents; positions count analysed
    tokens from 0. ``stems(term, stem)`` maps terms (stemming keeps the length): it is broadcast where
    it fits, so that tokens stay in place; else the (term, document) groups, no longer the tokens,
    meet it by a salted join and return to their buckets."""
    each = tokens.select("docid", "dl", F.posexplode("toks").alias("pos", "term"))
    at = F.sort_array(F.collect_list("pos")).alias("positions")
    if stems is not None:
        changed = stems.filter("stem <> term")
        if J.fits_broadcast(changed):
            each = each.join(F.broadcast(changed), "term", "left").withColumn("term", F.coalesce("stem", "term")).drop("stem")
        else:
            groups = each.groupBy("term", "docid", "dl").agg(at)
            hot = groups.groupBy("term").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > J.HOT_ROWS)
            met = J.salted_join(stems, groups, "term", hot).select(F.col("stem").alias("term"), "docid", "dl", "positions")
            met = met.repartition(buckets, "docid") if buckets else met
            joined = met.groupBy("term", "docid", "dl").agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
            return joined.select("term", "docid", F.size("positions").cast("bigint").alias("tf"), "dl", "positions")
    return each.groupBy("term", "docid", "dl").agg(at).select("term", "docid", F.size("positions").cast("bigint").alias("tf"), "dl", "positions")


def repeated_ids(tokens: DataFrame) -> DataFrame:
    """``(docid)`` of more than one row, and the null id."""
    return tokens.groupBy("docid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR docid IS NULL").select("docid")


def only(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``df`` rows whose ``docid``, null included, is (``left_semi``) or is not (``left_anti``) among ``ids``."""
    r = ids.select(F.col("docid").alias("_id"))
    return df.join(F.broadcast(r) if J.fits_broadcast(r) else r, F.col("docid").eqNullSafe(F.col("_id")), how)


def token_slices(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple]:
    """``(slice, row of each token, first token of each row, tokens)`` of batches with a column ``toks``; a
    slice has about ``tokens`` tokens, one row at least."""
    for b in batches:
        total = np.cumsum(np.asarray(b.column("toks").value_lengths(), np.int64))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + tokens, "right")))
            s = b.slice(i, j - i)
            n = np.asarray(s.column("toks").value_lengths(), np.int64)
            yield s, np.repeat(np.arange(len(n)), n), np.cumsum(n) - n, s.column("toks").flatten()
            i = j


def row_postings(tokens: DataFrame) -> DataFrame:
    """``postings`` of documents of one row each: a row's tokens are counted in that row's task, by a sort
    of term numbers in place of one of all (term, document, position) rows."""
    ship(tokens.sparkSession)
    size = SLICE_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, row, first, toks in token_slices(batches, size):
            words = toks.dictionary_encode()
            code = np.asarray(words.indices, np.int64)
            key = row * max(1, len(words.dictionary)) + code
            order = np.argsort(key, kind="stable")
            new = np.ones(len(key), bool)
            new[1:] = np.diff(key[order]) != 0
            at = np.flatnonzero(new)
            head, ends = order[at], np.append(at, len(key))
            pos = (np.arange(len(key)) - first[row])[order].astype(np.int32)
            doc = pa.array(row[head])
            yield pa.record_batch([words.dictionary.take(pa.array(code[head])), b.column("docid").take(doc), pa.array(np.diff(ends)),
                                   b.column("dl").take(doc), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(pos))],
                                  names=["term", "docid", "tf", "dl", "positions"])
    return tokens.select("docid", "dl", "toks").mapInArrow(run, "term string, docid string, tf bigint, dl bigint, positions array<int>")


def all_postings(tokens: DataFrame, repeated: DataFrame, stems: DataFrame | None, buckets: int) -> DataFrame:
    """``postings``, by the row where neither stems nor repeated ids ask for groups over several rows."""
    if stems is not None or not J.fits_broadcast(repeated):
        return postings(tokens, stems, buckets)
    if repeated.isEmpty():
        return row_postings(tokens)
    return row_postings(only(tokens, repeated, "left_anti")).unionByName(postings(only(tokens, repeated, "left_semi")))


def term_stats(post: DataFrame) -> DataFrame:
    """I03 vocabulary ``(term, df, cf)``."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))


def corpus_stats(dstats: DataFrame) -> DataFrame:
    """I02 one-row ``(n_docs, total_len, avg_dl)``."""
    return dstats.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").cast("bigint").alias("total_len"),
                      F.avg("dl").alias("avg_dl"))


def doc_vectors(post: DataFrame) -> DataFrame:
    """I04 ``(docid, vector MAP<STRING,BIGINT>)``; a document's terms are one group,
    bounded by that document's own length."""
    return post.groupBy("docid").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "tf")))).alias("vector"))


@dataclass
class Index:
    """Handles on the written index tables plus the two corpus scalars."""
    corpus: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    n_docs: int
    avg_dl: float
    path: str | None = None
    stemmer: str = "none"
    parts: int = TERM_PARTS
    fingerprint: str = ""
    tokens: DataFrame | None = None
    repeated: DataFrame | None = None

    def of_terms(self, parts: list[int] | None) -> DataFrame:
        """The postings in the given directories (None: all); a filter on the partition column, which
        keeps the other directories from being listed or read."""
        if parts is None or len(parts) >= self.parts:
            return self.postings
        return self.postings.filter(F.col("part").isin(sorted(parts)))

    def vectors(self) -> DataFrame:
        """I04, from the stored table if the index was built with it."""
        spark = self.postings.sparkSession
        try:
            return spark.read.parquet(f"{self.path}/vectors")
        except AnalysisException:
            return doc_vectors(self.postings)


_MEMO: dict[str, Index] = {}
_LOCK = threading.Lock()


def _key(sf_dir: str, stop, stemmer: str) -> str:
    h = hashlib.sha1(("|".join(stop) + "#" + stemmer).encode()).hexdigest()[:10]
    return f"{sf_dir.rstrip('/').replace('/', '_').replace(':', '_')}-{stemmer}-{h}"


def _files(corpus: DataFrame) -> list[list]:
    """(path, bytes, time) of the files that a table is read from; folders are listed once."""
    spark, out = corpus.sparkSession, []
    by_folder: dict[str, set[str]] = {}
    for f in corpus.inputFiles():
        by_folder.setdefault(f.rsplit("/", 1)[0], set()).add(f.rsplit("/", 1)[1])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder, names in by_folder.items():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder + "/"))
        for s in p.getFileSystem(conf).listStatus(p):
            name = s.getPath().toUri().getRawPath().rsplit("/", 1)[-1]
            if name in names:
                out.append([f"{folder}/{name}", s.getLen(), s.getModificationTime()])
    return sorted(out)


def manifest(corpus: DataFrame, stop, stemmer: str, recipe: str = "") -> dict:
    """What an index of ``corpus`` is made of. Tables read from files are known by the files; ``recipe`` tells
    apart corpora that are computed differently from the same files. Other tables are known by a
    checksum of their rows."""
    files = _files(corpus)
    if files:
        source = {"files": len(files), "bytes": sum(f[1] for f in files), "hash": hashlib.sha256(json.dumps(files).encode()).hexdigest()}
    else:
        r = corpus.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("docid", "contents").cast("decimal(38,0)")).alias("h")).first()
        source = {"rows": r["n"], "hash": str(r["h"])}
    return {"source": source, "recipe": recipe, "schema": corpus.schema.simpleString(), "stemmer": stemmer, "format": FORMAT,
            "stop": hashlib.sha256("\0".join(stop).encode()).hexdigest()}


def fingerprint_of(about: dict) -> str:
    return hashlib.sha256(json.dumps(about, sort_keys=True).encode()).hexdigest()


def _name(path: str, name: str, fingerprint: str, buckets: int) -> str:
    return f"hunch_{name}_{hashlib.sha1(f'{path} {fingerprint} {buckets}'.encode()).hexdigest()[:16]}"


def _table(spark: SparkSession, path: str, name: str, schema: str, buckets: int, fingerprint: str, sort: str | None = None, parts: str | None = None) -> DataFrame:
    """The bucketed table over the files below ``path`` (declared, not read)."""
    full = _name(path, name, fingerprint, buckets)
    if not spark.catalog.tableExists(full):
        spark.sql(f"CREATE TABLE {full} ({schema}) USING parquet {f'PARTITIONED BY ({parts}) ' if parts else ''}"
                  f"CLUSTERED BY (docid) {f'SORTED BY ({sort}) ' if sort else ''}INTO {buckets} BUCKETS LOCATION '{path}/{name}'")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {full}")
    else:
        spark.catalog.refreshTable(full)  # the files may have been written anew since they were listed
    return spark.table(full)


def _write_buckets(df: DataFrame, path: str, name: str, buckets: int, sort: str | None = None, parts: str | None = None) -> None:
    tmp = f"hunch_build_{name}_{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite").bucketBy(buckets, "docid")
    w = w.sortBy(sort) if sort else w
    w = w.partitionBy(parts) if parts else w
    w.option("path", f"{path}/{name}").format("parquet").saveAsTable(tmp)
    df.sparkSession.sql(f"DROP TABLE {tmp}")  # the files stay: the table is external


TOKENS_SCHEMA = "docid STRING, dl BIGINT, toks ARRAY<STRING>"
POSTINGS_SCHEMA = "term STRING, docid STRING, tf BIGINT, dl BIGINT, positions ARRAY<INT>, part INT"


def _meta(spark: SparkSession, path: str):
    try:
        return spark.read.parquet(f"{path}/meta").first()
    except AnalysisException:
        return None


def open_index(spark: SparkSession, path: str, expected: str | None = None) -> Index | None:
    """The complete index at ``path``, without analysing any text; None if there is none. With ``expected``
    (a fingerprint), another index there raises ``IndexMismatch``."""
    row = _meta(spark, path)
    if row is None:
        return None
    fp = row["fingerprint"] if "fingerprint" in row else ""
    if expected is not None and fp != expected:
        raise IndexMismatch(f"the index at {path} was built from other data or options: {row['about'] if 'about' in row else 'no manifest'}")
    n = int(row["buckets"])
    tokens = _table(spark, path, "tokens", TOKENS_SCHEMA, n, fp)
    return Index(corpus=spark.read.parquet(f"{path}/docs"), postings=_table(spark, path, "postings", POSTINGS_SCHEMA, n, fp, "term", "part"),
                 term_stats=spark.read.parquet(f"{path}/term_stats"), doc_stats=tokens.select("docid", "dl"),
                 n_docs=int(row["n_docs"]), avg_dl=float(row["avg_dl"] or 0.0), path=path, stemmer=row["stemmer"], parts=int(row["parts"]), fingerprint=fp,
                 tokens=tokens, repeated=spark.read.parquet(f"{path}/repeated"))


def drop_index(spark: SparkSession, path: str) -> None:
    """Delete the index at ``path``, its manifest first, and its table definitions."""
    row = _meta(spark, path)
    remove_path(spark, f"{path}/meta")
    if row is not None and "fingerprint" in row:
        for name in ("tokens", "postings"):
            spark.sql(f"DROP TABLE IF EXISTS {_name(path, name, row['fingerprint'], int(row['buckets']))}")
    remove_path(spark, path)


def build_index(spark: SparkSession, corpus: DataFrame, path: str, stop=C.INDEX_STOP_WORDS, stemmer: str = "none",
                recipe: str = "", on_mismatch: str = "raise", store_vectors: bool = False) -> Index:
    """S06 + S07: build the tables at ``path`` unless the same index is there complete, then open them.
    Another index at the path raises ``IndexMismatch``, or is replaced with ``on_mismatch='rebuild'``. A
    build that was cut off has no ``meta`` and is written anew."""
    from ..sources.tables import spread

    about = manifest(corpus, list(stop), stemmer, recipe)
    fp = fingerprint_of(about)
    try:
        found = open_index(spark, path, fp)
        if found is not None:
            return found
    except IndexMismatch:
        if on_mismatch != "rebuild":
            raise
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    drop_index(spark, path)
    for name in ("tokens", "postings"):  # left by a build of the same index that was cut off
        spark.sql(f"DROP TABLE IF EXISTS {_name(path, name, fp, n)}")
    spread(corpus.select("docid", "contents")).write.mode("overwrite").parquet(f"{path}/docs")
    _write_buckets(analysed(spark.read.parquet(f"{path}/docs"), stop).repartition(n, "docid"), path, "tokens", n)
    tokens = _table(spark, path, "tokens", TOKENS_SCHEMA, n, fp)
    stems = None
    if stemmer != "none":
        S.stem_vocabulary(tokens.select(F.explode("toks").alias("term")).distinct(), stemmer).write.mode("overwrite").parquet(f"{path}/stems")
        stems = spark.read.parquet(f"{path}/stems")
    repeated_ids(tokens).write.mode("overwrite").parquet(f"{path}/repeated")
    placed = all_postings(tokens, spark.read.parquet(f"{path}/repeated"), stems, n).withColumn("part", part_of("term", TERM_PARTS))
    _write_buckets(placed, path, "postings", n, "term", "part")
    post = _table(spark, path, "postings", POSTINGS_SCHEMA, n, fp, "term", "part")
    term_stats(post).write.mode("overwrite").parquet(f"{path}/term_stats")
    if store_vectors:
        doc_vectors(post).write.mode("overwrite").parquet(f"{path}/vectors")
    corpus_stats(tokens).withColumns({"buckets": F.lit(n), "parts": F.lit(TERM_PARTS), "stemmer": F.lit(stemmer), "fingerprint": F.lit(fp), "about": F.lit(json.dumps(about))}) \
        .write.mode("overwrite").parquet(f"{path}/meta")
    return open_index(spark, path, fp)


def index_home(spark: SparkSession, key: str) -> str:
    """Where an index named ``key`` lives: below the folder ``spark.hunch.index.dir`` where the session
    names one (indexes last and are shared by applications), else in the application's scratch."""
    base = spark.conf.get("spark.hunch.index.dir", None)
    return f"{base.rstrip('/')}/{key}" if base else app_scratch(spark, "index", key)


def load_index(spark: SparkSession, sf_dir: str, stop=C.INDEX_STOP_WORDS, stemmer: str = "none") -> Index:
    """The index of ``documents`` under ``sf_dir``, built where ``index_home`` says unless it is there; an
    index of an earlier state of the table is replaced."""
    from ..sources.tables import read_table

    key = _key(sf_dir, list(stop), stemmer)
    app = spark.sparkContext.applicationId
    with _LOCK:
        hit = _MEMO.get(app + key)
        if hit is not None:
            return hit
        corpus = corpus_from_documents(read_table(spark, sf_dir, "documents"))
        idx = build_index(spark, corpus, index_home(spark, key), list(stop), stemmer, recipe="documents", on_mismatch="rebuild")
        _MEMO[app + key] = idx
        return idx
