"""Operator 1: exact Jaccard join on word shingles by universe-partition pigeonhole.

Sets of sizes in one band are cut by the same hash partition of the shingle universe into
``m`` segments. Two linked sets differ in at most H shingles (H follows from the band), so
a partition into more segments than H leaves segments on which they agree. Segment
contents are the join keys; the first ``q`` segments of a band also index their
one-deletion neighbourhoods, which count twice in the pigeonhole. How many segments and
deletions a band gets is a cost model over the band's document count (``allocate``).

A set indexes under its own band and the band below, so a pair always meets in the band of
its smaller set. Equal sets meet as one node. Inside a key every member is compared with
one pivot (a star, not all pairs); links that a star can miss, between members that are not
yet connected, are compared in ``_cross`` when they are few for their key; counts of their shingles by class rule most of them
out before any set is moved (``plausible``). Sets under a key with many such pairs (thousands of
variants of one text, or boilerplate that fills whole segments) are compared by ``_crowds`` instead: in each crowd a set is written as its
difference from one central set, and since two sets differ exactly as much as their
differences do, only pairs that share one of the rarest elements of these can link. Every
candidate is verified on the full shingle sets.

Shingles and words are 64-bit hashes: two different shingles of one compared pair are taken
as equal with probability about 2**-64. Set identity uses 128 bits.

Results: one row per input row with an id. No words or null text: ``n_shingles`` 0, linked
with nothing. Rows that repeat an id are one document in the links: an id with several texts has
the links of all of them, and all its rows get its component. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

U64 = np.uint64
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
#: Largest multiple of its members that a key's untested pairs may reach before its sets are
#: left to ``_crowds``; counters of the element-frequency sketch that orders elements there; bits that tell
#: which elements more than one set shows, and in how many slices they are counted; counters of a set's ``bins``.
CROSS_PER_MEMBER, SKETCH = 8, 1 << 20
SHOWN, SLICES = 1 << 26, 64
BINS = 512



# ---- plan: bands and allocation ---------------------------------------------------------

def band_tops(num: int, den: int, largest: int) -> list[int]:
    """Largest set size of each band; a set linked to one in band k lies in band k or k + 1."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, tops[-1] * den // num))
    return tops


def allocate(lo: int, hi: int, n_docs: int, num: int, den: int) -> tuple[int, int, int]:
    """``(m, q, x)`` for the band of sizes lo..hi: m segments, of which q index one-deletions,
    and slack x = m + q - (H + 1).

    Segments without content say nothing, so a set skips them while their weight is at most x
    (see ``signatures``). The cost is the keys of a set plus the random meetings it can expect
    among ``n_docs`` sets: on empty segments beyond the slack, and on segments so small that
    unrelated sets share them. Any choice with x >= 0 is exact; the model only sets the price."""
    h = (den - num) * hi // num
    size = max(1.0, math.sqrt(lo * hi))
    best = None
    for q in range(0, min(h + 2, 9)):
        for x in sorted({*range(0, 5), *(int(h * f) for f in (0.01, 0.02, 0.04, 0.06, 0.1))}):
            m = h + 1 + x - q
            if m < 1 or q > m:
                continue
            c = size / m
            empty = math.exp(-c) if m > 1 else 0.0
            weight = m * empty + q * empty * (1 + c)
            over = sum(math.exp(-weight) * weight ** j / math.factorial(j) for j in range(x + 1)) if x < 100 else 1.0
            keys = (m - q) + q * (1 + c)
            meet = n_docs * ((1 - min(1.0, over)) * max(weight, 1e-9) + (m - q) * (empty * c) ** 2 * 1e-3 + q * (empty * c * c / 2) ** 2 * 1e-3)
            cost = keys + 4 * meet
            if best is None or cost < best[0]:
                best = (cost, m, q, x)
    return best[1:]


def make_plan(sizes: dict[int, int], num: int, den: int, largest: int) -> dict:
    """Band tops and (m, q, x) of each band; ``sizes``: estimated documents by log2-size class."""
    tops = band_tops(num, den, max(2, largest))
    rows, lo = [], 1
    for t in tops:
        n = max(1, sizes.get(int(math.log2(max(1, t))), 1) * (t - lo + 1) // max(1, t // 2))
        rows.append(allocate(lo, t, n, num, den))
        lo = t + 1
    return {"tops": tops, "alloc": rows, "num": num, "den": den}


# ---- shingle sets -----------------------------------------------------------------------

def shingle_sets(hasher: C.WordHasher, texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined; and the offsets of the texts."""
    h, at, _, _ = hasher(texts)
    n_words = np.diff(at)
    mult = C.odd_multipliers(k, 11)
    n = len(h)
    full = np.zeros(max(0, n - k + 1), U64)
    for j in range(k):
        full += h[j:n - k + 1 + j] * mult[j] if n >= k else U64(0)
    full = C.mix64(full)
    parts, counts = [], np.zeros(len(texts), np.int64)
    for i, w in enumerate(n_words.tolist()):
        if w >= k:
            u = np.unique(full[at[i]:at[i] + w - k + 1])
        elif w:
            u = C.mix64(np.array([w], U64))
            for j in range(w):
                u = C.mix64(u * U64(0x9E3779B97F4A7C15) + h[at[i] + j:at[i] + j + 1])
        else:
            continue
        parts.append(u)
        counts[i] = len(u)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=off[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), off


def signatures(s: np.ndarray, off: np.ndarray, plan: dict) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)``: the join keys of every set under its own band and the band below."""
    n = np.diff(off)
    tops = np.array(plan["tops"], np.int64)
    alloc = np.array(plan["alloc"], np.int64)
    own = np.searchsorted(tops, n, "left")
    out = [[], []]
    for down in (0, 1):
        band = own - down
        ok = (n > 0) & (band >= 0)
        if down:
            ok &= n * plan["num"] <= tops[np.maximum(band, 0)] * plan["den"]
        rows = np.flatnonzero(ok)
        if not len(rows):
            continue
        b = band[rows]
        m, q, x = alloc[b, 0], alloc[b, 1], alloc[b, 2]
        size = n[rows]
        total = int(size.sum())
        first = np.zeros(len(rows), np.int64)
        np.cumsum(size[:-1], out=first[1:])
        el = np.repeat(np.arange(len(rows)), size)
        v = s[np.arange(total) - np.repeat(first, size) + np.repeat(off[rows], size)]
        mixed = C.mix64(v ^ U64(0xA0761D6478BD642F))
        # the segment depends on the shingle and the band's m only
        seg = ((mixed >> U64(32)) * m[el].astype(U64) >> U64(32)).astype(np.int64)
        base = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(m, out=base[1:])
        cell = base[el] + seg
        acc = np.zeros(int(base[-1]), U64)
        content = C.mix64(v + U64(0x2545F4914F6CDD1D))
        np.add.at(acc, cell, content)
        cnt = np.bincount(cell, minlength=int(base[-1]))
        cell_row = np.repeat(np.arange(len(rows)), m)
        cell_seg = np.arange(int(base[-1])) - base[cell_row]
        space = C.mix64((b[cell_row].astype(U64) << U64(32)) + cell_seg.astype(U64))
        double = cell_seg < q[cell_row]
        weight = np.where(cnt == 0, 1 + double, ((cnt == 1) & double).astype(np.int64))
        over = np.bincount(cell_row, weights=weight, minlength=len(rows)) > x
        keep = (cnt > 0) | over[cell_row]
        d = double[cell] & ((cnt[cell] > 1) | over[el])
        at, drop = np.flatnonzero(keep), np.flatnonzero(d)
        out[0] += [rows[cell_row[at]], rows[el[drop]]]
        out[1] += [C.mix64(acc[at] + space[at]), C.mix64(acc[cell[drop]] - content[drop] + space[cell[drop]])]
    if not out[0]:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return tuple(np.concatenate(o) for o in out)


def _hasher() -> C.WordHasher:
    return C.WordHasher(SPACES)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, h, n_shingles, h1, h2)``: size and 128-bit identity of each row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for b in C.slices(batches, "text"):
            s, off = shingle_sets(hasher, C.utf8(b.column("text")), k)
            n = np.diff(off)
            at = np.minimum(off[:-1], max(0, len(s) - 1))
            ids = [np.where(n > 0, np.add.reduceat(C.mix64(s ^ U64(c)), at) if len(s) else U64(0), U64(0)).view(np.int64)
                   for c in (0x1234567, 0x89ABCDEF)]
            yield pa.record_batch([b.column("doc_id"), b.column("h"), pa.array(n), pa.array(ids[0]), pa.array(ids[1])],
                                  names=["doc_id", "h", "n_shingles", "h1", "h2"])
    return docs.mapInArrow(run, "doc_id long, h long, n_shingles long, h1 long, h2 long")


def _keys(reps: DataFrame, k: int, plan: dict) -> DataFrame:
    """``(key, doc, head, salt, n)``: keys of ``reps(doc_id, text)``. Within a batch the members
    of a key hang below its smallest one (``head``, 0 in the smallest one's own row); only heads are dealt by key, so a key held
    by a third of all sets arrives once a batch. The others get a salt of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = _hasher(), set()
        for b in C.slices(batches, "text", 1 << 20):
            doc = np.asarray(b.column("doc_id"))
            order = np.argsort(doc, kind="stable")
            texts = C.utf8(b.column("text"))
            if len(seen) > 200_000:
                seen.clear()
            first = []  # copies of a text that this task has seen are the same node anyway
            for i in order.tolist():
                t = hash(texts[i])
                if t not in seen:
                    first.append(i)
                    seen.add(t)
            order = np.array(first, np.int64)
            s, off = shingle_sets(hasher, [texts[i] for i in first], k)
            row, key = signatures(s, off, plan)
            o = np.lexsort((row, key))
            row, key = row[o], key[o]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            once = np.ones(len(key), bool)
            once[1:] = new[1:] | (row[1:] != row[:-1])
            row, key, new = row[once], key[once], new[once]
            group = np.cumsum(new) - 1
            d = doc[order][row]
            head = d[new][group] if len(d) else d
            alone = (np.bincount(group)[group] == 1) if len(d) else new
            n = np.diff(off)[row]
            for i in range(0, len(d), 1 << 16):
                j = slice(i, i + (1 << 16))
                yield pa.record_batch([pa.array(key[j].view(np.int64)), pa.array(d[j]), pa.array(np.where(new[j], 0, head[j])),
                                       pa.array(np.where(new[j], 0, d[j] | 1)), pa.array(n[j].astype(np.int32)),
                                       pa.array(~alone[j])], names=["key", "doc", "head", "salt", "n", "shared"])
    return reps.mapInArrow(run, "key long, doc long, head long, salt long, n int, shared boolean")


def _meetings(keys: DataFrame) -> DataFrame:
    """``(key, doc, n, pivot)`` of the keys that more than one set has."""
    from pyspark.sql.window import Window
    w = Window.partitionBy("key", "salt")
    g = keys.withColumn("pivot", F.min("doc").over(w)).withColumn("c", F.count(F.lit(1)).over(w))
    return g.filter("c > 1 OR shared").select(
        "key", "doc", "n", F.when(F.col("salt") == 0, F.col("pivot")).otherwise(F.col("head")).alias("pivot"))


# ---- verification -----------------------------------------------------------------------

def _candidate_sets(docs: DataFrame, ids: DataFrame, k: int, most: int | None = None) -> DataFrame:
    """``(doc, n, bins, s)``: the documents in ``ids(doc)`` with their shingle sets, as bytes, the sizes of these, and
    how many shingles fall into each of BINS classes (at most 255 are told). ``most``: no more ids than this can come, if known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for c in C.slices(batches, "text"):
            s, off = shingle_sets(hasher, C.utf8(c.column("text")), k)
            raw, at = s.tobytes(), (s % U64(BINS)).astype(np.int64)
            ends = list(zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
            bins = [np.minimum(np.bincount(at[i:j], minlength=BINS), 255).astype(np.uint8).tobytes() for i, j in ends]
            yield pa.record_batch([c.column("doc_id"), pa.array(np.diff(off)), pa.array(bins, pa.binary()), pa.array([raw[8 * i:8 * j] for i, j in ends], pa.binary())],
                                  names=["doc", "n", "bins", "s"])
    ids = ids.select(F.col("doc").alias("doc_id")).distinct()
    if most is not None and most <= C.BROADCAST_IDS:  # the list need not be written to be counted
        found = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    else:
        found = C.semi(docs, C.cut(ids, "ids"), "doc_id")
    return found.mapInArrow(run, "doc long, n long, bins binary, s binary")


def plausible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` that can link by their ``bins``: these differ in no more than the sets do, and linked sets
    differ in at most (den - num) / (den + num) of both sizes. No link is lost; sets are not moved."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for at in range(0, t.num_rows, 1 << 12):
                c = t.slice(at, 1 << 12)
                u, v = (np.frombuffer(b"".join(c.column(x).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for x in ("ba", "bb"))
                m = pa.array((den + num) * np.abs(u - v).sum(1, dtype=np.int64) <= (den - num) * np.asarray(c.column("n")))
                yield pa.record_batch([c.column("a").filter(m), c.column("b").filter(m)], names=["a", "b"])
        C.give_back()
    j = pairs.join(sets.select(F.col("doc").alias("a"), F.col("bins").alias("ba"), F.col("n").alias("na")), "a") \
        .join(sets.select(F.col("doc").alias("b"), F.col("bins").alias("bb"), F.col("n").alias("nb")), "b")
    return j.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "ba", "bb").mapInArrow(run, "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link: den * |intersection| >= num * |union|."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = np.zeros(t.num_rows, bool)
            for i, (x, y) in enumerate(zip(t.column("sa"), t.column("sb"), strict=True)):
                u, v = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(u) > len(v):
                    u, v = v, u
                if not len(u):
                    continue
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                both = int((v[at] == u).sum())
                ok[i] = den * both >= num * (len(u) + len(v) - both)
            m = pa.array(ok)
            yield pa.record_batch([t.column("a").filter(m), t.column("b").filter(m)], names=["a", "b"])
        C.give_back()
    j = pairs.join(sets.select(F.col("doc").alias("a"), F.col("s").alias("sa")), "a") \
        .join(sets.select(F.col("doc").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb")
    return j.mapInArrow(run, "a long, b long")


def _near(na: str, nb: str, num: int, den: int):
    return F.least(na, nb) * den >= F.greatest(na, nb) * num


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id``."""
    d = C.id_text(docs).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    sets = C.cut(_sets(d, k), "sets")
    # An id with several sets: each of its texts gets a name of its own, and links to the others.
    pair = F.struct("h1", "h2")
    several = sets.groupBy("doc_id").agg(F.min(pair).alias("x"), F.max(pair).alias("y")).filter("x <> y").select("doc_id")
    if several.isEmpty():
        return _named(d.drop("h"), sets, None, k, num, den)
    several = C.cut(several, "several")
    texts = C.cut(C.semi(sets, several, "doc_id").select("doc_id", "h").distinct().withColumn("g", F.lit(0)), "texts")
    ends, n = sets.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first(), texts.count()
    start = ends["hi"] + 1 if ends["hi"] < 1 << 62 else ends["lo"] - n
    names = C.cut(C.gapless_rank(texts, "g", ["doc_id", "h"], "r", C.buckets_for(docs.sparkSession)).select("doc_id", "h", (F.col("r") + start).alias("name")), "text-names")
    given = F.broadcast(names) if n <= C.BROADCAST_IDS else names

    def renamed(df: DataFrame) -> DataFrame:
        return df.join(given, ["doc_id", "h"], "left").withColumn("doc_id", F.coalesce("name", "doc_id")).drop("name")
    found = C.cut(_named(renamed(d).select("doc_id", "text"), C.cut(renamed(sets), "renamed"), names, k, num, den), "found")
    own = found.join(names.select("name", F.col("doc_id").alias("id")), F.col("doc_id") == F.col("name"), "left") \
        .select(F.coalesce("id", "doc_id").alias("doc_id"), "n_shingles", F.col("component_id").alias("c"))
    own = own.join(own.groupBy("c").agg(F.min("doc_id").alias("component_id")), "c").select("doc_id", "n_shingles", "component_id")
    # rows without words share the component of their id
    first = own.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("m"))
    return own.join(first, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("m", "component_id").alias("component_id"))


def _named(d: DataFrame, sets: DataFrame, names: DataFrame | None, k: int, num: int, den: int) -> DataFrame:
    """The components of documents of one set each (an id may repeat with that set); texts of one id in
    ``names(doc_id, name)`` are linked."""
    # Equal sets are one node, named by their smallest id.
    node = sets.filter("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    hist = sets.filter("n_shingles > 0").groupBy(F.floor(F.log2("n_shingles")).alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("m")).collect()  # one row per power of two
    plan = make_plan({int(r["c"]): int(r["n"]) for r in hist}, num, den, max([int(r["m"]) for r in hist], default=1))
    own = sets.join(node.select("h1", "h2", "rep"), ["h1", "h2"], "left")
    own = C.cut(own.select("doc_id", "n_shingles", "h1", "h2", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep")), "nodes")
    # Members of keys go by the name of their node, so copies neither meet nor count.
    reps = own.filter("rep IS NOT NULL").groupBy("doc_id").agg(F.first("rep").alias("rep"), F.first("n_shingles").cast("int").alias("n"))
    if names is None:
        links = d.sparkSession.createDataFrame([], "a long, b long")
    else:
        of = names.select(F.col("doc_id").alias("id"), F.col("name").alias("doc_id")).join(reps, "doc_id").select("id", "rep")
        links = of.join(of.groupBy("id").agg(F.min("rep").alias("a")), "id").filter("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    met = _meetings(_keys(d, k, plan))
    met = met.join(reps.select(F.col("doc_id").alias("doc"), F.col("rep").alias("r")), "doc") \
        .join(reps.select(F.col("doc_id").alias("pivot"), F.col("rep").alias("p"), F.col("n").alias("np")), "pivot") \
        .select("key", F.col("r").alias("doc"), "n", F.col("p").alias("pivot"), "np").distinct()
    links = _search(d, C.cut(met, "members"), links, k, num, den, sum(int(r["n"]) for r in hist))
    comp = C.parents(links)
    out = own.join(comp.select(F.col("node").alias("rep"), "comp"), "rep", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "rep", "doc_id").alias("component_id"))


def _search(docs: DataFrame, met: DataFrame, links: DataFrame, k: int, num: int, den: int, most: int) -> DataFrame:
    """The links among ``met(key, doc, n, pivot, np)`` of at most ``most`` sets, added to ``links``."""
    from pyspark.sql.window import Window
    by = Window.partitionBy("doc").orderBy(F.desc("c"), "pivot")
    star = C.cut(met.filter("doc <> pivot").repartition("doc").groupBy("doc", "pivot").agg(F.first("n").alias("n"), F.first("np").alias("np"), F.count(F.lit(1)).alias("c"))
                 .filter(_near("n", "np", num, den)).select("doc", "pivot", (F.row_number().over(by) == 1).alias("lead")), "stars")
    # 1: each member against the pivot it meets most
    best = star.filter("lead").select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
    vecs = C.cut(_candidate_sets(docs, best.select(F.col("a").alias("doc")).union(best.select(F.col("b").alias("doc"))), k, most), "vecs")
    links = links.unionByName(C.cut(verify(best, vecs, num, den), "links"))
    comp = C.parents(links)
    # 2: where that leaves two components, the other pivots and the members of one key
    rest = _apart(star.select(F.col("doc").alias("a"), F.col("pivot").alias("b")), comp)
    inside = met.select("key", "doc", "n").distinct().join(comp.withColumnRenamed("node", "doc"), "doc", "left") \
        .withColumn("comp", F.coalesce("comp", "doc"))
    per = inside.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.count(F.lit(1)).alias("comps")).filter("comps > 1") \
        .select("key", ((F.col("all") * F.col("all") - F.col("sq")) / 2 <= CROSS_PER_MEMBER * F.col("all")).alias("few"))
    inside = C.cut(inside.join(per, "key"), "inside")
    tested = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = _cross(inside.filter("few"), num, den).unionByName(
        rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    crowd = C.cut(inside.filter("NOT few").select("key", "doc"), "crowd")
    if not crowd.isEmpty():
        pairs = pairs.unionByName(_apart(_crowds(docs, crowd, links, k, num, den, most), comp))
    pairs = C.cut(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "cross")
    vecs = C.cut(_candidate_sets(docs, pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))), k, most), "vecs")
    pairs = C.cut(plausible(pairs, vecs, num, den), "plausible")
    return links.unionByName(C.cut(verify(pairs, vecs, num, den), "links"))


def _crowds(docs: DataFrame, crowd: DataFrame, links: DataFrame, k: int, num: int, den: int, most: int | None = None) -> DataFrame:
    """Pairs ``(a, b)`` that may link among the members of ``crowd(key, doc)``.

    Sets that crowded keys connect form a crowd; its centre is the one with most links. With D = x
    minus/plus centre (symmetric difference), |x ^ y| = |Dx ^ Dy|. For a link this is at most H, so
    Dx and Dy share at least (|Dx| + |Dy| - H) / 2 elements and, in any common order of elements,
    one among the first H / 2 + 1 of the smaller and (|Dy| - |Dx| + H) / 2 + 1 of the larger. (If
    none need be shared, |Dx| + |Dy| <= H, both link with the centre; such pairs are left out, since
    their links to it connect them already.) Elements are ordered
    by a frequency sketch of fixed size, rare ones first. An element that only one set has among its first
    ones meets nothing, so no row is made for it; most elements of unrelated sets are such."""
    spark = docs.sparkSession
    first = crowd.groupBy("key").agg(F.min("doc").alias("b"))
    joined = C.components(crowd.join(first, "key").select(F.col("doc").alias("a"), "b").filter("a <> b").distinct())
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("deg"))
    centre = joined.join(degree, "node", "left").groupBy("comp").agg(F.max_by("node", F.struct(F.coalesce("deg", F.lit(0)), -F.col("node"))).alias("centre"))
    member = C.cut(joined.join(centre, "comp").select(F.col("node").alias("doc"), "centre"), "crowds")
    vecs = C.cut(_candidate_sets(docs, member.select("doc"), k, most), "vecs")
    both = member.join(vecs, "doc").join(vecs.select(F.col("doc").alias("centre"), F.col("s").alias("sc")), "centre")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            out = [np.setxor1d(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), assume_unique=True).tobytes()
                   for x, y in zip(t.column("s"), t.column("sc"), strict=True)]
            n = np.array([x.as_buffer().size // 8 for x in t.column("s")], np.int64)
            nc = np.array([x.as_buffer().size // 8 for x in t.column("sc")], np.int64)
            shared = (n + nc - np.array([len(x) // 8 for x in out], np.int64)) // 2
            near = den * shared >= num * (n + nc - shared)
            yield pa.record_batch([t.column("doc"), t.column("centre"), pa.array(n), pa.array(near), pa.array(out, pa.binary())], names=["doc", "centre", "n", "near", "d"])
        C.give_back()
    apart = C.cut(both.select("doc", "centre", "s", "sc").mapInArrow(differ, "doc long, centre long, n long, near boolean, d binary"), "apart")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for t in batches:
            for x in t.column("d"):
                np.add.at(total, (np.frombuffer(x.as_buffer(), U64) % U64(SKETCH)).astype(np.int64), 1)
        yield pa.record_batch([pa.array(np.arange(SLICES)), pa.array([x.tobytes() for x in total.reshape(SLICES, -1)], pa.binary())], names=["slice", "c"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for c in t.column("c").chunks for x in c)
        return pa.table({"slice": t.column("slice").slice(0, 1), "c": pa.array([total.tobytes()], pa.binary())})
    # a task hands on SLICES rows, however many elements it has read
    seen = apart.select("d").mapInArrow(count, "slice long, c binary").groupBy("slice").applyInArrow(add, "slice long, c binary").toArrow()  # SKETCH counters
    sketch = np.zeros((SLICES, SKETCH // SLICES), np.int64)
    for i, x in zip(seen["slice"].to_pylist(), seen["c"].to_pylist(), strict=True):
        sketch[i] = np.frombuffer(x, np.int64)
    sketch = sketch.reshape(-1)
    shared = spark.sparkContext.broadcast(sketch)

    def leading(n: int, d: np.ndarray) -> np.ndarray:
        f = shared.value[(d % U64(SKETCH)).astype(np.int64)]
        return np.lexsort((d, f))[:(den - num) * n // num + 1]

    def slots(d: np.ndarray) -> np.ndarray:
        return (d % U64(SHOWN)).astype(np.int64)

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = SHOWN // SLICES
        for t in batches:
            each = [slots(d[leading(n, d)]) for n, d in zip(t.column("n").to_pylist(), (np.frombuffer(x.as_buffer(), U64) for x in t.column("d")), strict=True)]
            e = np.sort(np.concatenate(each)) if each else np.zeros(0, np.int64)
            ends = np.searchsorted(e, np.arange(SLICES + 1) * wide).tolist()
            yield pa.record_batch([pa.array(np.arange(SLICES)), pa.array([e[i:j].astype(np.uint32).tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                                  names=["slice", "slots"])
        C.give_back()

    def twice(t: pa.Table) -> pa.Table:
        wide, bits = SHOWN // SLICES, np.zeros(SHOWN // SLICES, bool)
        e = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for c in t.column("slots").chunks for x in c]))
        bits[e[1:][e[1:] == e[:-1]] % wide] = True
        return pa.table({"slice": t.column("slice").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})
    found = apart.select("n", "d").mapInArrow(show, "slice long, slots binary").groupBy("slice").applyInArrow(twice, "slice long, bits binary").toArrow()  # SHOWN bits
    bits = np.zeros(SHOWN // 8, np.uint8)
    for i, x in zip(found.column("slice").to_pylist(), found.column("bits").to_pylist(), strict=True):
        bits[i * len(x):(i + 1) * len(x)] = np.frombuffer(x, np.uint8)
    several = spark.sparkContext.broadcast(bits)

    def prefix(batches: Iterator[pa.RecordBatch], far=None) -> Iterator[pa.RecordBatch]:
        often, met = several.value, None if far is None else far.value
        for t in batches:
            cols = [[] for _ in range(7)]
            for doc, c, n, near, x in zip(*(t.column(i).to_pylist() for i in ("doc", "centre", "n", "near")), t.column("d"), strict=True):
                d = np.frombuffer(x.as_buffer(), U64)
                first = leading(n, d)
                at = slots(d[first])
                ok = (often[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                if met is not None:
                    ok &= met[(d[first] % U64(SKETCH)).astype(np.int64)]
                pos = np.flatnonzero(ok)
                for col, v in zip(cols, (doc, c, n, int(near), len(d)), strict=False):
                    col.append(np.full(len(pos), v, np.int64))
                cols[5].append(pos)
                cols[6].append(d[first[pos]].view(np.int64))
            if cols[0]:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=["doc", "centre", "n", "near", "size", "pos", "el"])
        C.give_back()
    schema = "doc long, centre long, n long, near long, size long, pos long, el long"
    far = C.cut(apart.filter("NOT near").mapInArrow(prefix, schema), "far")
    # near sets meet far ones only: they show what a far set has shown (a bit for each slot)
    by_far = np.zeros(SKETCH, bool)
    by_far[np.asarray(far.select(F.expr(f"el & {SKETCH - 1}").alias("slot")).distinct().toArrow()["slot"])] = True
    shown = spark.sparkContext.broadcast(by_far)
    close = C.cut(apart.filter("near").mapInArrow(lambda batches: prefix(batches, shown), schema), "close")
    # sets far from the centre meet all others; near ones never meet each other
    side = lambda q, z: q.select("centre", "el", *(F.col(c).alias(c + z) for c in ("doc", "n", "near", "size", "pos")))
    h = F.floor((den - num) * (F.col("nx") + F.col("ny")) / (den + num))
    smaller = (F.col("sizex") < F.col("sizey")) | ((F.col("sizex") == F.col("sizey")) & (F.col("docx") < F.col("docy")))
    room = F.when(smaller, F.col("posx")).otherwise(F.col("posy")) * 2 <= h
    more = F.when(smaller, F.col("posy")).otherwise(F.col("posx")) * 2 <= F.abs(F.col("sizey") - F.col("sizex")) + h
    j = side(far, "x").join(side(far.unionByName(close), "y"), ["centre", "el"]).filter(
        (smaller | (F.col("neary") == 1)) & (F.col("docx") != F.col("docy")) & _near("nx", "ny", num, den) & room & more)
    return j.select(F.least("docx", "docy").alias("a"), F.greatest("docx", "docy").alias("b")).distinct() \
        .unionByName(apart.filter("near AND doc <> centre").select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")))


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components so far."""
    c = comp.select("node", "comp")
    return pairs.join(c.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left") \
        .join(c.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left") \
        .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _cross(inside: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of one key in different components and of linkable size, each once."""
    x = inside.select("key", F.col("doc").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"))
    y = inside.select("key", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    return x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _near("na", "nb", num, den)) \
        .select("a", "b").distinct()
