"""BM25 ranking, set-at-a-time.

All topics x all subqueries are scored in one pass:
``query_terms`` (small, per question) -> join vocabulary for ``idf`` -> join postings ->
``groupBy(qid, sub_ord, docid).sum`` -> per-list top-k window.

Physical plan at scale: the query-term side is counted; when it fits, it is broadcast
and a scan of the postings directories that hold its terms is probed map-side (no shuffle of postings at all, so a term
present in every document costs a scan, not a hot task). Otherwise the join shuffles
on ``term`` with hot terms salted. The score aggregate has partial aggregation before
its shuffle; the top-k window gets a partial ``WindowGroupLimit`` before its own.

Searches that keep the k best (``best_hits``) score a document in its own row of the forward
index: the lists are broadcast, a task adds up a block of documents by lists in numpy and
hands on only what can be among the k best, so no (list, document) row is made for the rest.
Stemmed indexes, lists too large to broadcast and ids of several rows take the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..session import cut_lineage, ship
from . import joins as J
from .index import Index, only, part_of, token_slices
from .stem import stem_expr

#: Lists that are scored together, cells (documents by lists) of one block, and how far apart two scores may
#: lie that round to the same six places.
GROUP_LISTS, BLOCK_CELLS, ROUNDING = 4096, 1 << 21, 2e-6


def query_terms(subq: DataFrame, text_col: str = "text", weight_col: str | None = None,
                stop=C.INDEX_STOP_WORDS, stemmer: str = "none", keys=("qid", "sub_ord")) -> DataFrame:
    """I06 ``(keys..., term, qtf)``: analysed terms of each subquery with their count
    (or summed weight). A repeated term scores repeatedly, as a bag of words does."""
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    t = subq.select(*keys, w.alias("_w"), F.explode(T.index_terms(text_col, stop)).alias("term"))
    if stemmer != "none":
        t = t.withColumn("term", stem_expr(F.col("term"), stemmer))
    return t.groupBy(*keys, "term").agg(F.sum("_w").alias("qtf"))


def idf(df: Column, n_docs: int) -> Column:
    """Non-negative BM25 idf: ln(1 + (N - df + 0.5) / (df + 0.5))."""
    return F.log(F.lit(1.0) + (F.lit(float(n_docs)) - df + F.lit(0.5)) / (df + F.lit(0.5)))


def tf_norm(tf: Column, dl: Column, avg_dl: float, k1: float, b: float) -> Column:
    """tf / (tf + k1 (1 - b + b dl / avgdl))."""
    return tf / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / F.lit(avg_dl)))


def query_parts(qterms: DataFrame, idx: Index) -> tuple[bool, list[int] | None]:
    """Whether the query terms may be broadcast, and the directories of the postings that hold them."""
    return J.measured(qterms, part_of(F.col("term"), idx.parts))


def join_postings(qt: DataFrame, idx: Index, broadcast_ok: bool, parts: list[int] | None, columns=("docid", "tf", "dl")) -> DataFrame:
    """``qt`` with the postings of its terms: a scan of their directories probed map-side, or a salted shuffle join."""
    if broadcast_ok:
        return idx.of_terms(parts).select("term", *columns).join(F.broadcast(qt), "term")
    hot = idx.term_stats.filter(F.col("df") > J.HOT_ROWS).select("term", F.col("df").alias("rows"))
    return J.salted_join(qt, idx.postings.select("term", *columns), "term", hot)


def score_bm25(qterms: DataFrame, idx: Index, k1: float = C.BM25_K1, b: float = C.BM25_B,
               keys=("qid", "sub_ord"), broadcast_ok: bool | None = None) -> DataFrame:
    """``(keys..., docid, score)`` summed over the query terms of each list."""
    parts = None
    if broadcast_ok is None:
        broadcast_ok, parts = query_parts(qterms, idx)
    vocab = idx.term_stats.select("term", "df")
    qt = vocab.join(F.broadcast(qterms) if broadcast_ok else qterms, "term")
    qt = qt.select(*keys, "term", "qtf", idf(F.col("df"), idx.n_docs).alias("idf"))
    j = join_postings(qt, idx, broadcast_ok, parts)
    w = F.col("qtf") * F.col("idf") * tf_norm(F.col("tf"), F.col("dl"), idx.avg_dl, k1, b)
    return j.groupBy(*keys, "docid").agg(F.sum(w).alias("score"))


def top_k(hits: DataFrame, k: int, keys=("qid", "sub_ord"), depth: Column | None = None,
          places: int = 6) -> DataFrame:
    """``rank`` 1..k per list, by score (rounded to ``places`` so both engines and
    all summation orders agree) descending, then docid ascending. ``depth`` may lower
    the limit per row (weighted list 100, subqueries 50) under the literal bound ``k``."""
    scored = hits.withColumn("score", F.round("score", places))
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("docid").asc())
    ranked = scored.withColumn("rank", F.row_number().over(w))
    cond = F.col("rank") <= k
    if depth is not None:
        cond = cond & (F.col("rank") <= depth)
    return ranked.filter(cond).withColumn("rank", F.col("rank").cast("bigint"))


def _kth_best(a: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest value of each column (-inf with fewer rows)."""
    return np.partition(a, len(a) - k, axis=0)[len(a) - k] if len(a) >= k else np.full(a.shape[1], -np.inf)


def row_scores(tokens: DataFrame, lists: DataFrame, k: int, avg_dl: float, k1: float, b: float) -> DataFrame:
    """``(list, docid, score)``: of ``lists(list, term, w)``, numbered from 0, all documents that can be among the
    ``k`` best by rounded score and id (and some more); ``tokens`` has one row a document. The lists are
    broadcast: the caller has measured them."""
    import pyarrow.compute as pc

    ship(tokens.sparkSession)
    rows = lists.toArrow().combine_chunks()
    terms = rows.column("term").unique()
    term = np.asarray(pc.index_in(rows.column("term"), value_set=terms), np.int64)
    which, weight = np.asarray(rows.column("list"), np.int64), np.asarray(rows.column("w"), np.float64)
    groups = []  # of at most GROUP_LISTS lists: first list, number, and (list, weight) by term
    for lo in range(0, int(which.max()) + 1 if len(which) else 0, GROUP_LISTS):
        own = np.flatnonzero((which >= lo) & (which < lo + GROUP_LISTS))
        own = own[np.argsort(term[own], kind="stable")]
        ptr = np.zeros(len(terms) + 1, np.int64)
        np.cumsum(np.bincount(term[own], minlength=len(terms)), out=ptr[1:])
        groups.append((lo, int(which[own].max()) - lo + 1 if len(own) else 0, ptr, which[own] - lo, weight[own]))
    shared = tokens.sparkSession.sparkContext.broadcast((terms, groups))
    size, cells, near = 1 << 20, BLOCK_CELLS, ROUNDING

    def prune(t: pa.Table, floor: np.ndarray) -> pa.Table:
        """The rows of ``t`` that can still be among the ``k`` best of their list; raises ``floor``."""
        t = t.take(pc.sort_indices(t, sort_keys=[("list", "ascending"), ("score", "descending"), ("docid", "ascending")]))
        ls, sc = np.asarray(t.column("list")), np.asarray(t.column("score"))
        place = np.arange(len(ls))
        new = np.ones(len(ls), bool)
        new[1:] = ls[1:] != ls[:-1]
        run = new.copy()
        run[1:] |= sc[1:] != sc[:-1]
        kth = place - np.maximum.accumulate(np.where(new, place, 0)) == k - 1
        floor[ls[kth]] = np.maximum(floor[ls[kth]], sc[kth])
        # of equal scores only the first ids can be wanted, however many copies a text has
        keep = (sc >= floor[ls] - near) & (place - np.maximum.accumulate(np.where(run, place, 0)) < k)
        return t.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, groups = shared.value
        n_lists = max((g[0] + g[1] for g in groups), default=0)
        floor, kept, waiting = np.full(n_lists, -np.inf), [], 0
        for batch, row, _, toks in token_slices(batches, size):
            code = np.asarray(pc.fill_null(pc.index_in(toks, value_set=terms), -1), np.int64)
            asked = code >= 0
            key, tf = np.unique(row[asked] * len(terms) + code[asked], return_counts=True)
            doc, t = key // max(1, len(terms)), key % max(1, len(terms))
            dl = np.asarray(batch.column("dl"), np.float64)[doc]
            norm = tf / (tf + k1 * ((1.0 - b) + b * dl / avg_dl))
            for lo, n, ptr, ls, w in groups:
                step = max(1, cells // max(1, n))
                for start in range(0, batch.num_rows if n else 0, step):
                    i, j = np.searchsorted(doc, (start, start + step))
                    count = ptr[t[i:j] + 1] - ptr[t[i:j]]
                    at = np.repeat(ptr[t[i:j]] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                    docs = min(step, batch.num_rows - start)
                    score = np.bincount(np.repeat(doc[i:j] - start, count) * n + ls[at], weights=np.repeat(norm[i:j], count) * w[at], minlength=docs * n).reshape(docs, n)
                    own = floor[lo:lo + n]
                    np.maximum(own, _kth_best(score, k), out=own)
                    d, l = np.nonzero((score > 0) & (score >= own - near))
                    if len(d):
                        kept.append(pa.table({"list": pa.array(l + lo), "docid": batch.column("docid").take(pa.array(d + start)), "score": pa.array(score[d, l])}))
                        waiting += len(d)
                    if waiting > cells:
                        kept = [prune(pa.concat_tables(kept), floor)]
                        waiting = 0
        if kept:
            yield from prune(pa.concat_tables(kept), floor).combine_chunks().to_batches()
    return tokens.select("docid", "dl", "toks").mapInArrow(run, "list bigint, docid string, score double")


def best_hits(qterms: DataFrame, idx: Index, k: int, k1: float = C.BM25_K1, b: float = C.BM25_B, keys=("qid", "sub_ord")) -> DataFrame:
    """``(keys..., docid, score)`` of ``score_bm25`` for all documents that can be among the ``k`` best of a list."""
    fits, parts = query_parts(qterms, idx)
    if not fits or idx.tokens is None or idx.stemmer != "none" or not idx.avg_dl:
        return score_bm25(qterms, idx, k1, b, keys, fits if not fits else None)
    qt = idx.term_stats.select("term", "df").join(F.broadcast(qterms), "term")
    qt = cut_lineage(qt.select(*keys, "term", "qtf", (F.col("qtf") * idf(F.col("df"), idx.n_docs)).alias("w")), "query-terms")
    # lists are numbered in one sorted pass: there are no more of them than query terms, which were measured
    named = qt.select(*keys).distinct().withColumn("list", F.row_number().over(Window.orderBy(*keys)).cast("bigint") - 1)
    named = cut_lineage(named, "query-lists")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"q.{c}")) for c in keys]
    numbered = qt.alias("q").join(F.broadcast(named.alias("n")), same).select("n.list", "q.term", "q.w")
    some = not idx.repeated.isEmpty()
    rows = row_scores(only(idx.tokens, idx.repeated, "left_anti") if some else idx.tokens, numbered, k, idx.avg_dl, k1, b)
    hits = rows.join(F.broadcast(named), "list").select(*keys, "docid", "score")
    if not some:
        return hits
    post = only(idx.of_terms(parts).select("term", "docid", "tf", "dl"), idx.repeated, "left_semi").join(F.broadcast(qt), "term")
    more = post.groupBy(*keys, "docid").agg(F.sum(F.col("w") * tf_norm(F.col("tf"), F.col("dl"), idx.avg_dl, k1, b)).alias("score"))
    return hits.unionByName(more)


def bm25_search(subq: DataFrame, idx: Index, k: int = C.SUBQUERY_DEPTH, text_col: str = "text",
                weight_col: str | None = None, k1: float = C.BM25_K1, b: float = C.BM25_B,
                stop=C.INDEX_STOP_WORDS, depth: Column | None = None) -> DataFrame:
    """I06 + I10 + I11 over a subquery table ``(qid, sub_ord, text[, weight])``; query terms are
    stemmed as the index was."""
    qt = query_terms(subq, text_col, weight_col, stop, idx.stemmer)
    return top_k(best_hits(qt, idx, k, k1, b), k, depth=depth)

