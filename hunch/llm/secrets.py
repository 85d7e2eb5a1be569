"""Operator 2: secret scans; fixed patterns plus dictionary-primed compression novelty.

The fixed patterns report assignments, access keys and long hexadecimal runs. Besides, every
long token-like string in a sensitive context is a candidate: the bytes it adds to the
compressed context around it (zstandard, primed with a dictionary of identifiers) tell
whether it could be guessed. Ordinary names and paths compress against the context or the
dictionary; random keys do not, and are reported as ``novel``.

The dictionary holds common code words and, for each candidate, those of its own words that the
corpus shares: words found beside candidates in at least ``COMMON`` different contexts or in
as many different long strings, counted over all rows. Nothing is cut from that list, since a
candidate meets its words by a join; so names elsewhere in the corpus that a candidate does not
hold cannot change its result. A string that could be a secret never enters whole, and its words
count once a string, so a key found in many files is reported in each of them; copies of one
document count as one context.

Results: one row per row with an id; null text counts as empty and has no spans. Spans are
code points, end exclusive, ordered by start, then kind (assign, access, hex, novel).
Repeated rows are scanned alike. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from . import common as C

# FIXED VALUES: the base patterns, and words that make a context sensitive
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "novel"]
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)?|secret|token|api[_-]?key|auth|bearer|credential|private|signature|access[_-]?key|akia", re.I | re.A)
# '=' ends a name and belongs to a string only as its trailing padding
CANDIDATE = re.compile(r"(?=[A-Za-z0-9+/_=-]{16})[A-Za-z0-9+/_-]{14,}(?:={1,2}(?![A-Za-z0-9+/_=-])|(?<=[A-Za-z0-9+/_-]{16}))")
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
WORD = re.compile(r"[A-Z]?[a-z]{4,}|[A-Z]{5,}")
MIXED = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")  # more than capitals and capitalised words
CODE_WORDS = ("password passwd secret token api_key apikey authorization bearer credential private_key public_key access_key "
              "client_id client_secret username localhost example import return function class static const string value "
              "request response header content application default config environment production development database "
              "connection server session timestamp encoding signature certificate http https www com org html json utf-8 "
              "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789").split()

REACH = 80          # code points of context on either side that make a string sensitive and prime the compressor
COMMON = 3          # a word found in so many different contexts belongs to the corpus
BITS = 6.0          # compressed bits that a character of a secret adds at least


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def secret_like(word: str) -> bool:
    """A long string with a letter and a digit or mixed case (capitalised words alone are not mixed)."""
    return bool(CANDIDATE.search(word) and (MIXED.search(word) or re.search(r"[0-9]", word) and re.search(r"[A-Za-z]", word)))


def words_beside(text: str, s: int, e: int) -> list[tuple[str, str | None]]:
    """Distinct (word, long string it is part of) of the context of the candidate ``text[s:e]``, without strings
    that the context cuts; None for words of plain identifiers."""
    out = set()
    for lo, hi in ((max(0, s - REACH), s), (e, min(len(text), e + REACH))):
        for m in RUN.finditer(text, lo, hi):
            whole = not (m.start() == lo > 0 and RUN.match(text, lo - 1)) and not (m.end() == hi < len(text) and RUN.match(text, hi))
            if whole:
                of = m.group() if secret_like(m.group()) else None
                out.update((x, of) for x in WORD.findall(m.group()))
    return sorted(out, key=lambda x: (x[0], x[1] or ""))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """``s, e, word, context, own`` (its words) ``, beside`` (the context's) of long strings with a letter and a digit
    or mixed case, outside the base spans, with a sensitive word within REACH."""
    if not SENSITIVE.search(text):
        return []
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if any(a < e and s < b for a, _, b in base):
            continue
        word = m.group()
        if not secret_like(word):
            continue
        before, after = text[max(0, s - REACH):s], text[e:e + REACH]
        if SENSITIVE.search(before) or SENSITIVE.search(after):
            out.append({"s": s, "e": e, "word": word, "context": before + " " + after, "own": sorted(set(WORD.findall(word))),
                        "beside": [{"w": w, "of": of} for w, of in words_beside(text, s, e)]})
    return out


class Novelty:
    """Marginal compressed bytes of a string after its context, with a primed dictionary."""

    def __init__(self):
        import zstandard as z
        raw = (" ".join(CODE_WORDS) + " ").encode()
        self.z = z.ZstdCompressor(level=19, dict_data=z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT),
                                  write_checksum=False, write_content_size=False, write_dict_id=False)

    def bits(self, word: str, context: str, known: list[str]) -> float:
        """Added bits a character. Its ``known`` words and the context come first, so that repeats of them are cheap."""
        c = " ".join([*known, context]).encode("utf-8", "replace")
        return 8.0 * (len(self.z.compress(c + b" " + word.encode())) - len(self.z.compress(c))) / len(word)


SPANS = "array<struct<s:long,k:int,e:long>>"
CANDIDATES = "array<struct<s:long,e:long,word:string,context:string,own:array<string>,beside:array<struct<w:string,of:string>>>>"


def _scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, cand``: base spans and candidates of each row, ``row`` a number of its own."""
    span = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())])
    beside = pa.list_(pa.struct([("w", pa.string()), ("of", pa.string())]))
    cand = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("word", pa.string()), ("context", pa.string()), ("own", pa.list_(pa.string())), ("beside", beside)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 40
        for b in C.slices(batches, "text"):
            base, cands = [], []
            for t in b.column("text").to_pylist():
                found = base_spans(t or "")
                base.append([{"s": s, "k": k, "e": e} for s, k, e in found])
                cands.append(candidates(t or "", found))
            rows, n = np.arange(n, n + b.num_rows), n + b.num_rows
            yield pa.record_batch([pa.array(rows), b.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(cands, pa.list_(cand))], names=["row", "doc_id", "base", "cand"])
    return docs.mapInArrow(run, f"row long, doc_id long, base {SPANS}, cand {CANDIDATES}")


def _known_words(cands: DataFrame) -> DataFrame:
    """``row, s, known``: the words of each candidate that COMMON different contexts or long strings of the corpus share."""
    string = F.rtrim("word", F.lit("="))
    seen = cands.select("context", F.explode("beside").alias("x")).select(F.col("x.w").alias("w"), F.coalesce("x.of", "context").alias("place")) \
        .unionByName(cands.select(F.explode("own").alias("w"), string.alias("place")))
    own = cands.select("row", "s", F.explode("own").alias("w"))
    shared = C.cut(seen.groupBy("w").agg(F.count_distinct(F.xxhash64("place")).alias("n"), F.count(F.lit(1)).alias("rows")).filter(F.col("n") >= COMMON), "shared")
    words = shared.select("w")
    met = own.join(F.broadcast(words), "w") if J.fits_broadcast(words) else \
        J.salted_join(words, own, "w", shared.filter(F.col("rows") > J.HOT_ROWS).select("w", "rows"), spread_col="row")
    return met.groupBy("row", "s").agg(F.array_sort(F.collect_set("w")).alias("known"))


def _novel(cands: DataFrame) -> DataFrame:
    """``row, novel``: the novel spans of the rows that have some."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for b in batches:
            new = [novelty.bits(w, c, k or []) >= BITS for w, c, k in zip(*(b.column(x).to_pylist() for x in ("word", "context", "known")), strict=True)]
            yield pa.record_batch([b.column(x) for x in ("row", "s", "e")], names=["row", "s", "e"]).filter(pa.array(new, pa.bool_()))
    found = cands.join(_known_words(cands), ["row", "s"], "left").select("row", "s", "e", "word", "context", "known")
    return found.mapInArrow(run, "row long, s long, e long").groupBy("row").agg(
        F.collect_list(F.struct("s", F.lit(len(KINDS) - 1).alias("k"), "e")).alias("novel"))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans``."""
    found = C.cut(_scan(C.id_text(docs)), "secrets")
    cands = found.select("row", F.explode("cand").alias("c")).select("row", "c.*")
    rows = found.select("row", "doc_id", "base").join(_novel(cands), "row", "left")

    def show(spans):
        return F.array_join(F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["s"], x["k"], x["e"]))), lambda x: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")

    def count(k):
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    novel = F.coalesce("novel", F.array().cast(SPANS))
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.size(novel).cast("long").alias("n_novel"),
                       F.sha2(show(F.col("base")), 256).alias("base_sha256"), show(F.concat("base", novel)).alias("spans"))
