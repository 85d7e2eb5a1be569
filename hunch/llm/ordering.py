"""Operator 7: training-order materialisation as fixed-stride binary shards.

Documents become ids, each followed by the end id, and each input partition's stream is cut
into sequences of ``length`` ids (only a partition's last one is padded). Sequences are
numbered densely by partition offsets; a keyed Feistel permutation with cycle-walking maps
number to slot, so the global order is a bijection that needs no shuffle buffer and can be
computed or inverted for any single sequence. Slots are grouped into shards; the rows of a
shard meet in one task, sorted by slot, and are written one after the other: sequence
``slot`` stands at byte ``(slot % per_shard) * stride`` of shard ``slot // per_shard``, so
a reader can start anywhere.

A shard is written under a name of the task attempt and moved into place when complete:
a lost or repeated task leaves the same file. The returned rows are the manifest.

Results: one manifest row per sequence. Null or empty text is the end id alone; rows
without an id are left out; repeated rows appear twice. Empty table: no rows, no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C
from .common import U64, mix64

ROUNDS = 6
DICT_ROWS, DICT_CHARS, DICT_BYTES = 1000, 8000, 112_640
DTYPE = np.dtype("<u2")


def _narrow(ids: np.ndarray) -> np.ndarray:
    """``ids`` in the two bytes of a stride; larger ones raise instead of wrapping."""
    if len(ids) and int(ids.max()) > np.iinfo(DTYPE).max:
        raise ValueError(f"token id {int(ids.max())} does not fit in {DTYPE.itemsize} bytes")
    return ids.astype(DTYPE)


class Feistel:
    """A keyed permutation of 0..n-1: a balanced Feistel network on the next even number of bits,
    walked again while it lands outside."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.mask = U64((1 << self.half) - 1)
        self.keys = mix64(np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(key % (1 << 64)))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        a, b = x >> U64(self.half), x & self.mask
        for k in keys:
            if back:
                a, b = b ^ (mix64(a + k) & self.mask), a
            else:
                a, b = b, a ^ (mix64(b + k) & self.mask)
        return (a << U64(self.half)) | b

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        y = self._once(np.asarray(x).astype(U64), keys, back)
        out = np.flatnonzero(y >= U64(self.n))
        while len(out):
            y[out] = self._once(y[out], keys, back)
            out = out[y[out] >= U64(self.n)]
        return y.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


def _dictionary(docs: DataFrame, vocab_path: str, length: int) -> bytes:
    """A compression dictionary for sequences in transit, from a bounded sample (DICT_ROWS rows, their
    first DICT_CHARS code points). It only decides how many bytes move, never which ids are written."""
    import zstandard

    from .tokens import encoder
    texts = [r[0] for r in docs.filter("text IS NOT NULL").select(F.substring("text", 1, DICT_CHARS)).limit(DICT_ROWS).collect()]
    ids = _narrow(encoder(vocab_path).encode(texts)[0])
    try:
        return zstandard.train_dictionary(DICT_BYTES, [ids[i:i + length].tobytes() for i in range(0, len(ids), length)]).as_bytes()
    except zstandard.ZstdError:  # too few samples for a dictionary
        return b""


def _zstd(dictionary: bytes) -> dict:
    import zstandard
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _sequences(docs: DataFrame, vocab_path: str, length: int, end_id: int, dictionary: bytes) -> DataFrame:
    """``part, i, n_tokens, doc_ids, ids``: each partition's token stream cut to ``length`` ids, as
    compressed little-endian uint16."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from .tokens import encoder
        enc, z = encoder(vocab_path), zstandard.ZstdCompressor(level=9, **_zstd(dictionary))
        part, i = TaskContext.get().partitionId(), 0
        left_ids, left_doc = np.zeros(0, DTYPE), np.zeros(0, np.int64)

        def rows(ids: np.ndarray, doc: np.ndarray, at: int, n: int) -> pa.RecordBatch:
            cut = [ids[k:k + length] for k in range(0, n, length)]
            who = [doc[k:k + length] for k in range(0, n, length)]
            who = [w[np.flatnonzero(np.diff(w, prepend=~w[0]))].tolist() for w in who]
            return pa.record_batch([pa.array(np.full(len(cut), part)), pa.array(np.arange(at, at + len(cut))), pa.array([len(c) for c in cut], pa.int64()),
                                    pa.array(who, pa.list_(pa.int64())), pa.array([z.compress(c.tobytes()) for c in cut], pa.binary())],
                                   names=["part", "i", "n_tokens", "doc_ids", "ids"])
        for b in C.slices(batches, "text", 1 << 20):
            ids, off = enc.encode([x or "" for x in b.column("text").to_pylist()])
            size = np.diff(off)
            full = np.full(len(ids) + len(size), _narrow(np.array([end_id]))[0], DTYPE)
            keep = np.ones(len(full), bool)
            keep[off[1:] + np.arange(len(size))] = False
            full[keep] = _narrow(ids)
            full = np.concatenate([left_ids, full])
            doc = np.concatenate([left_doc, np.repeat(np.asarray(b.column("doc_id")), size + 1)])
            n = len(full) // length * length
            if n:
                yield rows(full, doc, i, n)
                i += n // length
            left_ids, left_doc = full[n:], doc[n:]
        if len(left_ids):
            yield rows(left_ids, left_doc, i, len(left_ids))
    return docs.mapInArrow(run, "part long, i long, n_tokens long, doc_ids array<long>, ids binary")


def materialise(docs: DataFrame, out_uri: str, vocab_path: str | None = None, length: int = 1024, end_id: int = 2,
                key: int = 20261203, per_shard: int = 16_384) -> DataFrame:
    """Write ``docs(doc_id, text)`` below ``out_uri`` (any file system that Arrow opens) and return the
    manifest ``sequence, slot, shard, byte_offset, n_tokens, ids_crc32, doc_ids``. ``length`` ids of two
    bytes make the stride; an id above 65,535 raises ``ValueError``."""
    from .tokens import default_vocab
    spark = docs.sparkSession
    vocab_path = vocab_path or default_vocab()
    dictionary = _dictionary(C.id_text(docs), vocab_path, length)
    seqs = C.cut(_sequences(C.id_text(docs), vocab_path, length, end_id, dictionary), "sequences")
    counts = seqs.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    total = int(counts.agg(F.sum("n")).first()[0] or 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row an input partition
    base = C.cut(counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    stride = length * DTYPE.itemsize

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(total, key)
        for b in batches:
            slot = f.slot(np.asarray(b.column("sequence")))
            yield pa.record_batch([*b.columns, pa.array(slot), pa.array(slot // per_shard)], names=[*b.schema.names, "slot", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(out_uri)
        store.create_dir(root, recursive=True)
        z, now, f = zstandard.ZstdDecompressor(**_zstd(dictionary)), None, None
        attempt = TaskContext.get().taskAttemptId()

        def done() -> None:
            if f is not None:
                f.close()
                whole, shard = f"{root}/.{now:06d}-{attempt}", f"{root}/shard-{now:06d}.bin"
                try:
                    store.move(whole, shard)
                except OSError:  # stores whose rename does not overwrite: an earlier attempt left the same bytes
                    if store.get_file_info(shard).type != fs.FileType.File:
                        raise
                    store.delete_file(shard)
                    store.move(whole, shard)
        for b in batches:
            crc = []
            for shard, raw in zip(b.column("shard").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if shard != now:
                    done()
                    now, f = shard, store.open_output_stream(f"{root}/.{shard:06d}-{attempt}")
                data = z.decompress(raw)
                crc.append(zlib.crc32(data))
                f.write(data.ljust(stride, b"\0"))
            yield pa.record_batch([b.column("sequence"), b.column("slot"), b.column("shard"),
                                   pa.array(np.asarray(b.column("slot")) % per_shard * stride), b.column("n_tokens"), pa.array(crc, pa.int64()), b.column("doc_ids")],
                                  names=["sequence", "slot", "shard", "byte_offset", "n_tokens", "ids_crc32", "doc_ids"])
        done()
    shards = max(1, -(-total // per_shard))
    numbered = seqs.join(F.broadcast(base) if base.count() <= C.BROADCAST_IDS else base, "part") \
        .select((F.col("base") + F.col("i")).alias("sequence"), "n_tokens", "doc_ids", "ids")
    placed = numbered.mapInArrow(place, "sequence long, n_tokens long, doc_ids array<long>, ids binary, slot long, shard long")
    return C.cut(placed.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot").mapInArrow(
        write, "sequence long, slot long, shard long, byte_offset long, n_tokens long, ids_crc32 long, doc_ids array<long>"), "manifest")


def read_slots(uri: str, first: int, count: int, length: int = 1024, per_shard: int = 16_384) -> Iterator[np.ndarray]:
    """Sequences ``first`` .. ``first + count - 1`` of the order, read one after the other (zero-padded)."""
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(uri)
    stride, at = length * DTYPE.itemsize, first
    while at < first + count:
        with store.open_input_file(f"{root}/shard-{at // per_shard:06d}.bin") as f:
            f.seek(at % per_shard * stride)
            for _ in range(min(first + count - at, per_shard - at % per_shard)):
                data = f.read(stride)
                if len(data) < stride:
                    return
                yield np.frombuffer(data, DTYPE)
                at += 1


def order_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` written to a fresh folder below the shared one."""
    uri = C.fresh_path(spark, "llm-shards")
    return materialise(docs, uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
