"""Operator 6: best-fit packing with large-item matching, over a histogram of lengths.

Documents become token pieces of at most ``capacity`` ids (only longer ones are cut; the
first piece of those may be shorter). Since a sequence only cares about lengths, the packing
is planned on the count of each length, which has ``capacity`` entries whatever the input:
pieces above one third of the capacity are matched, largest first with the largest partner
that fits, at most two a sequence; smaller pieces then go, largest first, to the tightest
remaining gap. The plan is a list of slots "ranks lo..lo+n of length L go to sequences
base.. at offset o"; pieces are numbered within their length by distributed ranks and look
their slot up. Rows are never gathered.

Results: one row per piece. Null or empty text has the end id alone. Repeated rows are
packed as separate documents. Rows without an id are left out. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocab_path: str | None = None, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian uint32) of all
    ``docs(doc_id, text)``; the ids of a text are followed by ``end_id``."""
    from .tokens import default_vocab
    vocab_path = vocab_path or default_vocab()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import encoder
        enc = encoder(vocab_path)
        for b in C.slices(batches, "text", 1 << 20):
            ids, off = enc.encode([x or "" for x in b.column("text").to_pylist()])
            doc, piece, start, size, crc, raw = [], [], [], [], [], []
            for d, i, j in zip(b.column("doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                one = np.append(ids[i:j], np.uint32(end_id)).astype("<u4")
                n, at, k = len(one), 0, 0
                while at < n:
                    w = (n - at) % capacity or capacity  # only the first piece can be short
                    data = one[at:at + w].tobytes()
                    doc.append(d), piece.append(k), start.append(at), size.append(w), crc.append(zlib.crc32(data))
                    if with_ids:
                        raw.append(data)
                    at, k = at + w, k + 1
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch(cols + [pa.array(raw, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)
    return C.id_text(docs).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots ``(length, lo, n, base, offset)`` and the number of sequences, for ``counts`` pieces of
    each length. A group of equal sequences is ``[base, n, filled]``."""
    left = {k: v for k, v in counts.items() if v}
    used = dict.fromkeys(left, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # groups by free space
    made = 0

    def put(group: list[int], size: int) -> None:
        base, n, filled = group
        slots.append((size, used[size], n, base, filled))
        used[size] += n
        left[size] -= n
        group[2] += size

    # pieces above one third: largest first, each with the largest partner that fits
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((s for s in large if s <= capacity - a and left[s] and (s != a or left[s] > 1)), 0)
            n = left[a] if not b else left[a] // 2 if b == a else min(left[a], left[b])
            group = [made, n, 0]
            made += n
            put(group, a)
            if b:
                put(group, b)
            gaps[capacity - group[2]].append(group)
    # the others: largest first, into the tightest gap; it stays the tightest while it fits another
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        g = s
        while left[s]:
            while g <= capacity and not gaps[g]:
                g += 1
            if g > capacity:
                n = -(-left[s] // (capacity // s))
                gaps[capacity].append([made, n, 0])
                made += n
                g = capacity
            group = gaps[g].pop()
            each = min(g // s, left[s])
            full = min(group[1], left[s] // each)
            if full < group[1]:  # the rest of the group keeps its gap
                gaps[g].append([group[0] + full, group[1] - full, group[2]])
                group = [group[0], full, group[2]]
            for _ in range(each):
                put(group, s)
            gaps[capacity - group[2]].append(group)
    return slots, made


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` (a written table with ``doc_id, piece, length``) plus ``sequence_id, offset``."""
    spark = pieces.sparkSession
    hist = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    slots, _ = plan({int(r["length"]): int(r["n"]) for r in hist}, capacity)
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    table = table[table[:, 2] > 0]
    shift = 44
    find = spark.sparkContext.broadcast(((table[:, 0] << shift) + table[:, 1], table))
    ranked = C.gapless_rank(pieces, "length", ["doc_id", "piece"], "__rank", C.buckets_for(spark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, t = find.value
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("__rank"))
            row = t[np.searchsorted(key, (length << shift) + rank, "right") - 1]
            cols = [b.column(i) for i, c in enumerate(b.schema.names) if c != "__rank"]
            names = [c for c in b.schema.names if c != "__rank"]
            yield pa.record_batch([*cols, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], names=[*names, "sequence_id", "offset"])
    from pyspark.sql import types as T
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*pieces.columns, "__rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocab_path: str | None = None, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """All of ``docs(doc_id, text)`` as packed pieces: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``."""
    return pack(C.cut(token_pieces(docs, vocab_path, capacity, end_id), "pieces"), capacity)
