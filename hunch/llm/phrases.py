"""Operator 12: phrase collocations by marginalising counts of the longest windows.

Every word starts one window: itself and the up to ``longest - 1`` words after it in its piece,
padded with null where the piece ends (the lead columns of the word sequence). Only these
windows are counted; ``ROLLUP(w0, w1, ...)`` sums them over successively shorter prefixes,
which gives the occurrences of all shorter phrases and, at its top, of all words.

Windows are combined within slices of text and travel as one row for each first word (and
hash of the second) of a slice, which lists the words that follow. Behind the one exchange
they are sorted, and a batch of sorted windows is reduced: where all windows with some
prefix lie within the batch and are rarer than ``min_count`` together, they are padded from
the prefix's last word on. Such a prefix can be no part of a candidate (a cut of a candidate
is at least as frequent as the candidate), and its windows still count towards all shorter
prefixes; prefixes that a batch may not hold whole stay as they are. What is left to roll up
is little more than the vocabulary. Pairs of words that open very many different windows of
a slice are dealt by the third word too and are not padded, which only saves work.

A candidate is a phrase of 2 to ``longest`` words with at least ``min_count`` occurrences; its
score is the least over its cuts of ``floor(2000000 * a / (l + r))``, in decimal arithmetic.
Candidates inside a longer one with at least ``inside`` of their occurrences are dropped, and
each language's ``top`` best are returned.

Rows: ids play no part, so every row counts, repeated ones as often as they occur; null text
is empty, null lang is ``und``. Whole texts are read, however long. Words hold no blank, so a
phrase is its words joined by one. Ties: more occurrences, then the smaller phrase in byte
order. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
SLICE = 2 << 20      # bytes of text whose windows are combined in one go
SALTS, HOT_SALTS = 8, 64
HOT = 64             # a pair of words is hot that opens more than 1 / HOT of a slice's different windows ...
HOT_LEAST = 1024     # ... and at least so many (which must exceed ``min_count``)
LIST = 64            # windows of a row that travels, at most


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words with A-Z lower-cased, piece number of each word, text number of each word)."""
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    a = low[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kinds = kind[a]
    inside = kinds == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    data = np.ascontiguousarray(a[inside])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    text_end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return words, piece, np.searchsorted(text_end, starts, "right")


def _distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place of one row of each distinct key, in key order; number of such rows)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([np.diff(k[order]) != 0 for k in keys])
    at = np.flatnonzero(new)
    return order[at], np.diff(at, append=len(order))


def _windows(longest: int):
    """Batches of ``(lang, text)`` -> ``(lang, w0, salt, windows)``: the distinct windows of each slice, listed by
    first word; a window is its other words, with a tab and its number where that is not 1."""
    blank, tab = pa.scalar(" ", pa.large_string()), pa.scalar("\t", pa.large_string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "text", SLICE):
            words, piece, of = _words(C.utf8(b.column("text")))
            if not len(words):
                continue
            encoded = words.dictionary_encode()
            vocabulary, langs = encoded.dictionary, b.column("lang").dictionary_encode()
            size, code, lang = len(vocabulary), np.asarray(encoded.indices, np.int64), np.asarray(langs.indices, np.int64)[of]
            rank = np.empty(size, np.int64)  # codes in the order of the words, so that neighbours are alike
            rank[np.asarray(pc.array_sort_indices(vocabulary))] = np.arange(size)
            vocabulary, code = vocabulary.take(pc.array_sort_indices(vocabulary)), rank[code]
            crc = np.append(np.fromiter((zlib.crc32(w) for w in vocabulary.cast(pa.large_binary()).to_pylist()), np.int64, size), 0)
            lead = []  # lead columns; ``size`` stands for the padding
            for k in range(longest):
                w = np.full(len(code), size, np.int64)
                same = piece[k:] == piece[:len(piece) - k]
                w[:len(code) - k][same] = code[k:][same]
                lead.append(w)
            first = (lang * (size + 1) + lead[0]) * SALTS + crc[lead[1]] % SALTS
            keys = [first * (size + 1) + lead[1]] + [lead[k] * (size + 1) + (lead[k + 1] if k + 1 < longest else 0) for k in range(2, longest, 2)]
            row, n = _distinct(keys)
            # pairs that open very many windows are dealt by the third word, and leave a mark: the pair alone, with number 0
            begin = np.flatnonzero(np.diff(keys[0][row], prepend=-1))
            width = np.diff(begin, append=len(row))
            hot = width > max(HOT_LEAST, len(row) // HOT) if longest > 2 else np.zeros(len(width), bool)
            salt = crc[lead[1][row]] % SALTS
            if hot.any():
                each = np.repeat(hot, width)
                salt[each] = SALTS + crc[lead[2][row[each]]] % HOT_SALTS
                row, n, salt = np.append(row, row[begin[hot]]), np.append(n, np.zeros(hot.sum(), n.dtype)), np.append(salt, crc[lead[1][row[begin[hot]]]] % SALTS)
                order = np.lexsort([salt, first[row] // SALTS])
                row, n, salt = row[order], n[order], salt[order]

            def text(k: int, rows: np.ndarray) -> pa.Array:
                w = lead[k][rows] if k < 2 else np.where(n == 0, size, lead[k][rows])
                return vocabulary.take(pa.array(np.where(w == size, 0, w), mask=w == size))
            others = [text(k, row) if k > 1 else text(k, row).fill_null("") for k in range(1, longest)]
            window = pc.binary_join_element_wise(*others, blank, null_handling="skip")
            number = pa.array(n).cast(pa.large_string()).filter(pa.array(n != 1))
            window = pc.replace_with_mask(window, pa.array(n != 1), pc.binary_join_element_wise(window.filter(pa.array(n != 1)), number, tab))
            owner = first[row] // SALTS
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(owner) != 0) | (np.diff(salt) != 0)
            at = np.flatnonzero(new)
            place = np.arange(len(row)) - np.repeat(at, np.diff(at, append=len(row)))
            at = np.flatnonzero(place % LIST == 0)
            lists = pa.LargeListArray.from_arrays(pa.array(np.append(at, len(row))), window)
            listed = pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())
            cols = [langs.dictionary.cast(pa.string()).take(pa.array(lang[row[at]])), text(0, row[at]).cast(pa.string()), pa.array(salt[at].astype(np.int32)), listed]
            out = pa.record_batch(cols, names=["lang", "w0", "salt", "windows"])
            for i in range(0, out.num_rows, 1 << 14):
                yield out.slice(i, 1 << 14)
    return run


def _prefix(groups: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Numbers of the distinct (group, code) pairs."""
    return np.unique(groups * (int(code.max(initial=0)) + 2) + code + 1, return_inverse=True)[1]


def _pad(longest: int, min_count: int):
    """Sorted ``(lang, w0, salt, window, n)`` -> ``(lang, w0, w1, ..., n)``, padded where a prefix is surely rare, and
    combined. A prefix that the first or last row of the batch has may go on in another batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_marks = None, set()
        for b in batches:
            if not b.num_rows:
                continue
            lang, w0 = b.column("lang").dictionary_encode(), b.column("w0").dictionary_encode()
            salt, n = np.asarray(b.column("salt"), np.int64), np.asarray(b.column("n"), np.int64)
            owner = _prefix(np.asarray(lang.indices, np.int64), np.asarray(w0.indices, np.int64))
            group = [_prefix(owner, salt)]
            lists = pc.split_pattern(b.column("window"), " ")
            at, words = np.asarray(lists.offsets, np.int64), lists.flatten().dictionary_encode()
            code, size = np.asarray(words.indices, np.int64), np.diff(at)
            none = pc.index(words.dictionary, "").as_py()  # the window of a lone first word
            cols = []
            for k in range(longest - 1):
                c = np.where(size > k, code[np.minimum(at[:-1] + k, len(code) - 1)], -1)
                cols.append(np.where(c == none, -1, c))
                group.append(_prefix(group[-1], cols[-1]))
            marked = np.bincount(group[1], n == 0) > 0
            ends = [(b.column("lang")[i].as_py(), b.column("w0")[i].as_py(), int(salt[i])) for i in (0, b.num_rows - 1)]
            if ends[0] == open_key:  # marks come first among the windows of a pair, maybe in an earlier batch
                again = pc.index_in(pa.array(sorted(open_marks), words.dictionary.type), words.dictionary)
                mine = (group[0] == group[0][0]) & np.isin(cols[0], np.asarray(again.drop_null(), np.int64))
                marked[group[1][mine]] = True
            own = (group[0] == group[0][-1]) & marked[group[1]]
            kept = open_marks if ends[1] == open_key else set()
            open_key, open_marks = ends[1], kept | {words.dictionary[int(c)].as_py() for c in np.unique(cols[0][own & (cols[0] >= 0)])}
            fixed = marked[group[1]] | (salt >= SALTS)
            # words with control characters sort between a prefix and its continuations
            odd = [bool(min(map(ord, w), default=32) < 32) for w in (b.column("window")[0].as_py(), b.column("window")[b.num_rows - 1].as_py())]
            short = np.full(len(n), longest)
            for k in range(longest - 1, 0, -1):
                f = np.bincount(group[k], n)
                for end, strange in ((0, odd[0]), (-1, odd[1])):
                    f[group[k][group[0] == group[0][end]] if strange else group[k][end]] = min_count
                short[(f[group[k]] < min_count) & ~fixed] = k
            cols = [np.where(short > k + 1, c, -1) for k, c in enumerate(cols)]
            last = owner
            for c in cols:
                last = _prefix(last, c)
            total = np.bincount(last, n).astype(np.int64)
            row = np.unique(last, return_index=True)[1][total > 0]
            names = [f"w{k}" for k in range(longest)]
            take = [pa.DictionaryArray.from_arrays(pa.array(np.maximum(c[row], 0), mask=c[row] < 0), words.dictionary).dictionary_decode() for c in cols]
            yield pa.record_batch([lang.take(pa.array(row)).dictionary_decode(), w0.take(pa.array(row)).dictionary_decode(), *take, pa.array(total[total > 0])], names=["lang", *names, "n"])
    return run


def phrase_counts(docs: DataFrame, min_count: int = 30, longest: int = 4, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, phrase, size, f)``: all phrases of 1 to ``longest`` words with at least ``min_count``
    occurrences within pieces, and for each language a row of ``size`` 0 with the number of all words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = ["lang", "w0", "salt"]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = texts.mapInArrow(_windows(longest), "lang string, w0 string, salt int, windows string")
    each = listed.repartition(width, *key).select(*key, F.explode(F.split("windows", "\n")).alias("x"))
    number = F.when(F.contains("x", F.lit("\t")), F.substring_index("x", "\t", -1).cast("long")).otherwise(F.lit(1))
    sorted_ = each.select(*key, F.substring_index("x", "\t", 1).alias("window"), number.alias("n")).sortWithinPartitions(*key, "window")
    names = [f"w{k}" for k in range(longest)]
    padded = sorted_.mapInArrow(_pad(longest, min_count), ", ".join(f"{c} string" for c in ["lang", *names]) + ", n long")
    # words that are rare themselves count only among all words
    of_word = Window.partitionBy("lang", "w0")
    summed = padded.repartition(width, "lang", "w0").groupBy("lang", *names).agg(F.sum("n").alias("n")).withColumn("f1", F.sum("n").over(of_word)) \
        .select("lang", *[F.when(F.col("f1") >= min_count, F.col(c)).alias(c) for c in names], "n")
    rolled = summed.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # the grouping id has a bit for each column that is summed over
    kept = rolled.filter(F.col("g") < (1 << longest)).withColumn("size", (longest - F.bit_count("g")).cast("int"))
    last = F.coalesce(*[F.when(F.col("size") == k + 1, F.col(c)) for k, c in enumerate(names)])
    return kept.filter((F.col("size") == 0) | ((F.col("f") >= min_count) & last.isNotNull())) \
        .select("lang", F.concat_ws(" ", *names).alias("phrase"), "size", "f")


def _big(c: str | Column) -> Column:
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, top: int = 2000, inside: tuple[int, int] = (80, 100),
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` best collocations."""
    counts = C.cut(phrase_counts(docs, min_count, longest, lang_col, text_col), "phrases")
    words = F.split("phrase", " ")
    cand = counts.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    cuts = cand.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("second"))
    part = counts.filter("size > 0")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
        .join(part.select("lang", F.col("phrase").alias("second"), F.col("f").alias("r")), ["lang", "second"])
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(38,0)) + CAST(r AS DECIMAL(38,0)) AS DECIMAL(38,0))")
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # the most frequent longer candidate that holds a phrase's words in a row
    held = cand.filter("size >= 3").select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m")) \
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at")) \
        .select("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase"), "a")
    longer = held.groupBy("lang", "phrase").agg(F.max("a").alias("f"))
    num, den = inside
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("f").isNull() | (_big("f") * den < _big("a") * num))
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
