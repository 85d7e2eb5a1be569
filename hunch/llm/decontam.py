"""Operator 4: benchmark decontamination over a distributed positional inverted index.

The index is cut by documents into segments of bounded text size, as search engines do: a
segment holds, for every term of its documents, the sorted token positions, stored in
blocks by term hash (``segment, bucket, terms, counts, positions``; bucket -1 lists the
documents). Building it needs no shuffle. A query set is turned into windows; only the
postings of its terms leave the blocks, meet by segment, and each window intersects its
offset-adjusted position lists from the segment's rarest term on, stopping at the first
empty intersection. ``proximity_matches`` finds windows' terms in any order within a span.

Query items are read in blocks of at most ``MAX_WINDOWS`` windows, so what a task is handed
does not grow with the benchmark. Terms are 64-bit hashes: a false match needs ten
collisions in a row.

Results: one row per document row with an id. Null or empty text has no words and no hits;
items without words (or null) match nothing; repeated items count as separate items only if
their ids differ. Empty tables: no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

U64 = np.uint64
SEPARATORS = [b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]
BUCKETS = 1024
MAX_WINDOWS = 100_000
INDEX_SCHEMA = "segment long, bucket int, terms binary, counts binary, positions binary"


def _hasher() -> C.WordHasher:
    return C.WordHasher(SEPARATORS, seed=23)


def _blobs(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary array: the bytes of ``data`` cut at the element positions ``cuts``."""
    off = (cuts * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])


def build_index(docs: DataFrame, label: str = "postings", segment_bytes: int = 2 << 20) -> DataFrame:
    """The positional index of all of ``docs(doc_id, text)``, written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part, n = _hasher(), TaskContext.get().partitionId(), 0
        for b in C.slices(batches, "text", segment_bytes):
            h, at, _, _ = hasher(C.utf8(b.column("text")))
            seg, n = (part << 32) + n, n + 1
            yield pa.record_batch([pa.array([seg], pa.int64()), pa.array([-1], pa.int32()),
                                   pa.array([np.asarray(b.column("doc_id")).tobytes()], pa.binary()),
                                   pa.array([np.diff(at).astype(np.int32).tobytes()], pa.binary()), pa.array([b""], pa.binary())],
                                  names=["segment", "bucket", "terms", "counts", "positions"])
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            s = h[order]
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            terms = s[first]
            ends = np.append(first[1:], len(s))
            bucket = (terms >> U64(54)).astype(np.int64)  # terms are sorted, so buckets are runs
            cut = np.searchsorted(bucket, np.arange(BUCKETS + 1))
            some = np.flatnonzero(np.diff(cut))
            cuts = np.append(cut[some], len(terms))
            yield pa.record_batch([pa.array(np.full(len(some), seg)), pa.array(some.astype(np.int32)),
                                   _blobs(terms, cuts), _blobs((ends - first).astype(np.int32), cuts),
                                   _blobs(order.astype(np.int32), np.append(first, len(s))[cuts])],
                                  names=["segment", "bucket", "terms", "counts", "positions"])
    return C.cut(docs.mapInArrow(run, INDEX_SCHEMA), label)


def _item_blocks(items: DataFrame, width: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items as (id as string, word hashes), in blocks of at most MAX_WINDOWS windows (one item at least)."""
    hasher, block, n = _hasher(), [], 0
    for r in items.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")) \
            .filter("i IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        h = hasher([r["t"].encode()])[0]
        if len(h):
            w = max(1, len(h) - width + 1)
            if block and n + w > MAX_WINDOWS:
                yield block
                block, n = [], 0
            block.append((r["i"], h))
            n += w
    if block:
        yield block


def _needed(index: DataFrame, terms: np.ndarray) -> DataFrame:
    """``(segment, term, n, positions)`` of the given sorted terms, plus each segment's documents
    (term null)."""
    buckets = sorted({int(t) for t in (terms >> U64(54)).tolist()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seg, term, cnt, pos = [], [], [], []
            for i in range(b.num_rows):
                s = b.column("segment")[i].as_py()
                t = b.column("terms")[i].as_buffer()
                c = b.column("counts")[i].as_buffer()
                if b.column("bucket")[i].as_py() < 0:
                    seg.append(s), term.append(None), cnt.append(c.to_pybytes()), pos.append(t.to_pybytes())
                    continue
                t, c = np.frombuffer(t, U64), np.frombuffer(c, np.int32)
                p = np.frombuffer(b.column("positions")[i].as_buffer(), np.int32)
                at = np.searchsorted(terms, t)
                at[at == len(terms)] = 0
                ends = np.cumsum(c)
                for j in np.flatnonzero(terms[at] == t).tolist():
                    seg.append(s), term.append(int(t[j].view(np.int64))), cnt.append(b"")
                    pos.append(p[ends[j] - c[j]:ends[j]].tobytes())
            yield pa.record_batch([pa.array(seg, pa.int64()), pa.array(term, pa.int64()), pa.array(cnt, pa.binary()), pa.array(pos, pa.binary())],
                                  names=["segment", "term", "counts", "positions"])
    return index.filter(F.col("bucket").isin([-1, *buckets])).mapInArrow(run, "segment long, term long, counts binary, positions binary")


def _lists(t: pa.Table) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Positions by term, and token offsets of the segment's documents (with the end)."""
    lists, at = {}, np.zeros(1, np.int64)
    for term, c, p in zip(t["term"].to_pylist(), t["counts"], t["positions"], strict=True):
        if term is None:
            at = np.concatenate(([0], np.cumsum(np.frombuffer(c.as_buffer(), np.int32).astype(np.int64))))
        else:
            lists[term] = np.frombuffer(p.as_buffer(), np.int32)
    return lists, at


def phrase_starts(lists: dict[int, np.ndarray], terms: list[int]) -> np.ndarray:
    """Positions where ``terms`` occur one after the other, from the rarest list on."""
    order = sorted(range(len(terms)), key=lambda o: len(lists[terms[o]]))
    cand = lists[terms[order[0]]] - order[0]
    for o in order[1:]:
        p = lists[terms[o]]
        at = np.searchsorted(p, cand + o)
        at[at == len(p)] = 0
        cand = cand[p[at] == cand + o]
        if not len(cand):
            break
    return cand


def _merge(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals as sorted disjoint ones."""
    o = np.argsort(s, kind="stable")
    s, e = s[o], np.maximum.accumulate(e[o])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]


HITS = "segment long, ord int, item_id string, starts array<int>, ends array<int>"


def _hit_rows(seg: int, rows: list[tuple[int, str, np.ndarray, np.ndarray]]) -> pa.Table:
    return pa.table({"segment": pa.array([seg] * len(rows), pa.int64()), "ord": pa.array([r[0] for r in rows], pa.int32()),
                     "item_id": pa.array([r[1] for r in rows], pa.string()),
                     "starts": pa.array([r[2].tolist() for r in rows], pa.list_(pa.int32())),
                     "ends": pa.array([r[3].tolist() for r in rows], pa.list_(pa.int32()))})


def _phrase_search(block: list[tuple[str, np.ndarray]], width: int):
    def search(t: pa.Table) -> pa.Table:
        lists, at = _lists(t)
        rows = []
        for item, h in block:
            signed = h.view(np.int64).tolist()
            has = np.fromiter((x in lists for x in signed), bool, len(signed))
            w = min(width, len(signed))
            full = np.convolve(has, np.ones(w, np.int64), "valid") == w
            found = []
            for i in np.flatnonzero(full).tolist():
                c = phrase_starts(lists, signed[i:i + w]).astype(np.int64)
                if len(c):
                    d = np.searchsorted(at, c, "right") - 1
                    inside = c + w <= at[d + 1]
                    found.append((d[inside], c[inside]))
            if not found:
                continue
            d, c = (np.concatenate(x) for x in zip(*found, strict=True))
            for one in np.unique(d).tolist():
                s = c[d == one] - at[one]
                rows.append((one, item, *_merge(s, s + w)))
        return _hit_rows(t["segment"][0].as_py(), rows)
    return search


def _span_search(block: list[tuple[str, np.ndarray]], slop: int):
    def search(t: pa.Table) -> pa.Table:
        lists, at = _lists(t)
        rows = []
        for item, h in block:
            want = sorted(set(h.view(np.int64).tolist()), key=lambda x: len(lists.get(x, ())))
            if not all(x in lists for x in want):
                continue
            span = len(want) + slop
            # every range holds the rarest term: for each start candidate near it, the next place of each term
            near = lists[want[0]].astype(np.int64)
            starts = np.unique(np.concatenate([p[(np.searchsorted(near, p) < len(near)) & (near[np.minimum(np.searchsorted(near, p), len(near) - 1)] < p + span)]
                                               for p in (lists[x].astype(np.int64) for x in want)]))
            last = starts.copy()
            ok = np.ones(len(starts), bool)
            for x in want:
                p = lists[x].astype(np.int64)
                nxt = np.searchsorted(p, starts)
                ok &= nxt < len(p)
                last = np.maximum(last, p[np.minimum(nxt, len(p) - 1)])
            d = np.searchsorted(at, starts, "right") - 1
            ok &= (last - starts < span) & (last < at[np.minimum(d + 1, len(at) - 1)])
            starts, last, d = starts[ok], last[ok], d[ok]
            # of ranges with the same end the latest start is the smallest
            keep = np.append(last[1:] != last[:-1], True) if len(last) else ok[:0]
            for one in np.unique(d[keep]).tolist():
                k = keep & (d == one)
                rows.append((one, item, starts[k] - at[one], last[k] + 1 - at[one]))
        return _hit_rows(t["segment"][0].as_py(), rows)
    return search


def phrase_matches(index: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``(segment, ord, item_id, starts, ends)``: by document and item, the merged word ranges that
    windows of ``width`` consecutive item words cover (an item of fewer words is one window)."""
    out = None
    for block in _item_blocks(items, width):
        terms = np.unique(np.concatenate([h for _, h in block]))
        part = _needed(index, terms).groupBy("segment").applyInArrow(_phrase_search(block, width), HITS)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else index.sparkSession.createDataFrame([], HITS)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 5) -> DataFrame:
    """``(segment, ord, item_id, starts, ends)``: by document and item, the smallest word ranges that
    hold all distinct words of the item, in any order, within its distinct word count plus ``slop``."""
    out = None
    for block in _item_blocks(items, 1):
        terms = np.unique(np.concatenate([h for _, h in block]))
        part = _needed(index, terms).groupBy("segment").applyInArrow(_span_search(block, slop), HITS)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else index.sparkSession.createDataFrame([], HITS)


def index_documents(index: DataFrame) -> DataFrame:
    """``(segment, ord, doc_id, n_words)`` of the indexed documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, t, c in zip(b.column("segment").to_pylist(), b.column("terms"), b.column("counts"), strict=True):
                ids, n = np.frombuffer(t.as_buffer(), np.int64), np.frombuffer(c.as_buffer(), np.int32)
                yield pa.record_batch([pa.array(np.full(len(ids), s)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids), pa.array(n.astype(np.int64))],
                                      names=["segment", "ord", "doc_id", "n_words"])
    return index.filter("bucket = -1").select("segment", "terms", "counts").mapInArrow(run, "segment long, ord int, doc_id long, n_words long")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit, n_items, item_ids`` (sorted
    as strings) against ``items(item_id, text)``; a word inside any occurrence of a window is hit."""
    index = build_index(C.id_text(docs))
    hits = C.cut(phrase_matches(index, items, width), "hits")
    ranges = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("ranges", start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["ends"] - F.greatest(x["starts"], a["end"]))).cast("long").alias("n"),
        F.greatest(a["end"], x["ends"]).alias("end")), lambda a: a["n"])
    by_doc = hits.groupBy("segment", "ord").agg(ranges.alias("ranges"), F.array_sort(F.collect_set("item_id")).alias("item_ids")) \
        .select("segment", "ord", covered.alias("n_hit"), "item_ids")
    none = F.array().cast("array<string>")
    return index_documents(index).join(by_doc, ["segment", "ord"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("item_ids", none)), F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"))
