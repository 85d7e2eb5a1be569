"""Operator 9: language identification of spans: script ranges, n-gram scores, Viterbi.

A word is a run of letters. Its script narrows the languages to those that use the script in
training; their character n-gram models score it. A Viterbi path with a switching penalty
labels the words, and neighbouring words of one label form a span. The text's language is
the one with most letters in its spans.

The path is found without a word-by-word walk where one language is provably best: leaving
it for any run of words would gain less than one switch costs. Only other texts walk.

Training counts hashed n-grams of a deterministic sample of about ``SAMPLE_ROWS`` labelled
rows (all of them if there are fewer) with multinomial smoothing; each language has an equal
quota of it, languages with fewer rows give all of theirs, and no quota is below ``LEAST_ROWS``; the model has
``N_FEATURES`` rows of one number a language.

Results: one row per row with an id. Null text, or none with a letter: ``und``, score 0, no
spans. No labelled rows at all: ``und`` for every row. Empty table: no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .common import U64, mix64
from .tokens import LETTER, _classes

SAMPLE_ROWS, N_FEATURES, SWITCH, SMOOTH = 12_000, 1 << 16, 12.0, 0.5
#: Rows that a language is sampled for at least (a hashed rate misses all of them with probability e**-32).
LEAST_ROWS = 32
#: A language uses a script if at least this share of its training letters is in it.
SCRIPT_SHARE, OUTSIDE = 0.01, -40.0
# FIXED VALUES: first code point of blocks, by script
SCRIPTS = [("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
           ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]), ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
           ("armenian", [(0x530, 0x58F)]), ("hebrew", [(0x590, 0x5FF)]), ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
           ("devanagari", [(0x900, 0x97F)]), ("bengali", [(0x980, 0x9FF)]), ("tamil", [(0xB80, 0xBFF)]), ("thai", [(0xE00, 0xE7F)]),
           ("georgian", [(0x10A0, 0x10FF)]), ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
           ("kana", [(0x3040, 0x30FF)]), ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)])]


@functools.cache
def _script_table() -> np.ndarray:
    t = np.zeros(0x110000, np.uint8)  # 0: any other
    for i, (_, ranges) in enumerate(SCRIPTS):
        for lo, hi in ranges:
            t[lo:hi + 1] = i + 1
    return t


class Words:
    """The words of a batch of texts and the n-gram features of their letters."""

    def __init__(self, texts: list[str]):
        # lower-casing that keeps the number of code points
        lows = [t.lower() for t in texts]
        lows = [lo if len(lo) == len(t) else "".join(c if len(c.lower()) != 1 else c.lower() for c in t) for lo, t in zip(lows, texts, strict=True)]
        self.doc_at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter((len(t) + 1 for t in lows), np.int64, len(lows)), out=self.doc_at[1:])
        codes = np.frombuffer((" ".join(lows) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _classes()[codes] == LETTER
        self.at = np.flatnonzero(letter)                    # letters
        x = np.where(letter, codes, 0).astype(U64)          # 0: edge of a word
        edge = np.diff(letter.view(np.int8), prepend=np.int8(0))
        self.starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.ends = ends
        self.length = ends - self.starts
        self.first = np.zeros(len(self.starts), np.int64)   # first letter of each word, among the letters
        if len(self.starts):
            np.cumsum(self.length[:-1], out=self.first[1:])
        self.word_of = np.searchsorted(self.starts, self.doc_at)
        self.script = _script_table()[codes[self.starts]] if len(self.starts) else np.zeros(0, np.uint8)
        a = self.at
        p1 = x[np.maximum(a - 1, 0)] * (a > 0)
        p2 = np.where(p1 > 0, x[np.maximum(a - 2, 0)] * (a > 1), U64(0x1FFFFF))
        nx = x[np.minimum(a + 1, len(x) - 1)] if len(a) else x[:0]
        pack = lambda *cs: functools.reduce(lambda u, v: u * U64(0x1FFFFF) + v, cs)
        slot = lambda h, n: (mix64(h * U64(8) + U64(n)) % U64(N_FEATURES)).astype(np.int64)
        self.features = [slot(pack(p1, x[a]), 2), slot(pack(p2, p1, x[a]), 3), slot(pack(p1, x[a], nx), 4),
                         slot(pack(p2, p1, x[a], nx), 5)]


def quota(counts: list[int], rows: int) -> int:
    """The largest equal share of ``rows`` when languages with fewer rows leave theirs to the others."""
    left = rows
    for i, n in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if n > share:
            return max(LEAST_ROWS, share)
        left -= n
    return max(LEAST_ROWS, *counts, 0)


def train(docs: DataFrame, label: str = "lang", sample_rows: int = SAMPLE_ROWS) -> dict:
    """The model of labelled ``docs(doc_id, text, <label>)``."""
    d = docs.select("doc_id", "text", F.col(label).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one a language
    grid = 1 << 40
    if sum(counts.values()) > sample_rows:
        each = quota(list(counts.values()), sample_rows)
        share = docs.sparkSession.createDataFrame([(x, min(grid, -(-grid * each // n))) for x, n in counts.items()], "lang string, __share long")
        d = d.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(grid)) < F.col("__share")) \
            .select("doc_id", "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "text", 1 << 19):
            langs = np.array(b.column("lang").to_pylist(), object)
            texts = b.column("text").to_pylist()
            for lang in sorted(set(langs.tolist())):
                w = Words([t for t, one in zip(texts, langs, strict=True) if one == lang])
                if not len(w.at):
                    continue
                count = np.bincount(np.concatenate(w.features), minlength=N_FEATURES)
                script = np.bincount(np.repeat(w.script, w.length), minlength=len(SCRIPTS) + 1)
                count = np.concatenate([count, script])
                some = np.flatnonzero(count)
                yield pa.record_batch([pa.array([lang] * len(some)), pa.array(some), pa.array(count[some].astype(np.int64))], names=["lang", "f", "n"])
    t = d.mapInArrow(run, "lang string, f long, n long").groupBy("lang", "f").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(t["lang"].to_pylist()))
    table = np.zeros((N_FEATURES + len(SCRIPTS) + 1, len(names)))
    if names:
        at = {x: i for i, x in enumerate(names)}
        table[np.asarray(t["f"]), [at[x] for x in t["lang"].to_pylist()]] = np.asarray(t["n"])
    grams, script = table[:N_FEATURES], table[N_FEATURES:]
    logp = np.log(grams + SMOOTH) - np.log((grams + SMOOTH).sum(0, keepdims=True)) if names else grams
    share = script / np.maximum(script.sum(0, keepdims=True), 1)
    ok = share >= SCRIPT_SHARE
    ok[~ok.any(1)] = True  # a script that no language uses narrows nothing
    return {"langs": names, "logp": logp.astype(np.float32), "script": np.where(ok, 0.0, OUTSIDE).astype(np.float32)}


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word: sum of its scores less ``switch`` a change (ties: stay, then the
    smaller label)."""
    n, k = scores.shape
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores.max(1) - scores[:, best])
    low = np.minimum.accumulate(np.concatenate(([0.0], gain[:-1])))
    if float((gain - low).max()) <= switch:
        return np.full(n, best)
    v, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        top = max(range(k), key=v.__getitem__)
        jump = v[top] - switch
        back.append([j if v[j] >= jump else top for j in range(k)])
        v = [(v[j] if v[j] >= jump else jump) + row[j] for j in range(k)]
    out = np.empty(n, np.int64)
    out[-1] = at = max(range(k), key=v.__getitem__)
    for i in range(n - 2, -1, -1):
        out[i] = at = back[i][at]
    return out


def word_scores(w: Words, model: dict) -> np.ndarray:
    """[words, languages]: summed n-gram log probabilities, less a penalty outside the script."""
    s = model["logp"][w.features[0]]
    for f in w.features[1:]:
        s = s + model["logp"][f]
    return np.add.reduceat(s, w.first, axis=0, dtype=np.float64) + model["script"][w.script] if len(w.first) else np.zeros((0, len(model["langs"])))


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, lang_pred, score, spans`` (code points, end exclusive),
    ``has_letter``."""
    langs = model["langs"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in C.slices(batches, "text", 1 << 19):
            w = Words([x or "" for x in b.column("text").to_pylist()])
            s = word_scores(w, m) if langs else None
            pred, score, spans = [], [], []
            for i in range(b.num_rows):
                lo, hi = w.word_of[i], w.word_of[i + 1]
                if lo == hi or not langs:
                    pred.append("und"), score.append(0.0), spans.append([])
                    continue
                own = s[lo:hi]
                path = viterbi(own)
                letters = np.bincount(path, weights=w.length[lo:hi], minlength=len(langs))
                top = int(letters.argmax())
                total = own.sum(0)
                rest = float(np.delete(total, top).max()) if len(langs) > 1 else -np.inf
                sure = 1.0 / (1.0 + np.exp(min(50.0, (rest - float(total[top])) / (hi - lo))))
                new = np.flatnonzero(np.diff(path, prepend=-1))
                last = np.append(new[1:], hi - lo) - 1
                at = w.doc_at[i]
                pred.append(langs[top])
                score.append(float(letters[top] / letters.sum() * sure))
                spans.append([{"start": int(x), "end": int(y), "lang": langs[z]} for x, y, z in
                              zip((w.starts[lo + new] - at).tolist(), (w.ends[lo + last] - at).tolist(), path[new].tolist(), strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.record_batch([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kind),
                                   pa.array(np.diff(w.word_of) > 0)],
                                  names=["doc_id", "lang_pred", "score", "spans", "has_letter"])
    return C.id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>, has_letter boolean")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3; fold 1 is held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def language_id(docs: DataFrame) -> DataFrame:
    """Train on ``docs(doc_id, text, lang)`` outside fold 1 and label every row:
    ``doc_id, held_out, lang_pred, score, spans, has_letter``."""
    model = train(docs.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1)))
    return identify(docs, model).select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score", "spans", "has_letter")
