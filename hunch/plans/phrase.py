"""I08 ``phrase`` reading of the boosted query, with I13 positional matching.

The boosted string ``norm "entity"^4 "time"^2`` read as intended: the normalised
query as a bag of terms (weight 1), each entity / time span as an exact phrase with
its boost. A phrase scores like one BM25 term whose frequency is the number of
positions where all its terms occur consecutively and whose idf is the sum of its
terms' idf. Positions count analysed tokens (after the stop list).

A document's position lists lie in its bucket of the postings, so a phrase is matched there:
the lists, shifted by the term's place in the phrase, are intersected from the shortest on.
No position leaves its bucket; only (phrase, document) frequencies are scored on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import index as X
from ..operators import rank as R


def phrase_terms(decomp: DataFrame) -> DataFrame:
    """``(qid, pid, boost, term, offset, plen)`` for the entity and time phrases."""
    ent = F.transform(F.coalesce("entities", F.array().cast("array<string>")),
                      lambda e: F.struct(e.alias("text"), F.lit(float(C.ENTITY_BOOST)).alias("boost")))
    tim = F.transform(F.coalesce("time", F.array().cast("array<string>")),
                      lambda t: F.struct(t.alias("text"), F.lit(float(C.TIME_BOOST)).alias("boost")))
    p = decomp.select("qid", F.posexplode(F.concat(ent, tim)).alias("pid", "p"))
    p = p.select("qid", "pid", F.col("p.boost").alias("boost"), T.index_terms(F.col("p.text")).alias("terms")) \
        .filter(F.size("terms") > 0)
    return p.select("qid", "pid", "boost", F.size("terms").alias("plen"),
                    F.posexplode("terms").alias("offset", "term"))


def phrase_frequencies(terms: DataFrame, idx: X.Index, keys=("qid", "pid")) -> DataFrame:
    """``(keys..., docid, dl, ptf)`` — number of start positions where all terms of a phrase occur
    consecutively. ``terms`` has ``(keys..., term, offset, plen)``, a row for each place of a phrase."""
    small, parts = R.query_parts(terms, idx)
    j = R.join_postings(terms.select(*keys, "term", "offset", "plen"), idx, small, parts, ("docid", "dl", "positions"))
    found = j.groupBy(*keys, "docid", "dl", "plen").agg(
        F.array_sort(F.collect_list(F.struct(F.size("positions").alias("n"), "offset", "positions"))).alias("lists")).filter(F.size("lists") == F.col("plen"))
    shifted = F.transform("lists", lambda x: F.transform(x["positions"], lambda p: p - x["offset"]))
    starts = F.aggregate(F.slice(shifted, 2, F.size("lists")), F.get(shifted, F.lit(0)), lambda a, x: F.when(F.size(a) == 0, a).otherwise(F.array_intersect(a, x)))
    return found.select(*keys, "docid", "dl", F.size(starts).alias("ptf")).filter("ptf > 0")


def boosted_phrase_hits(decomp: DataFrame, idx: X.Index, k: int = C.WEIGHTED_DEPTH, k1: float = C.BM25_K1, b: float = C.BM25_B) -> DataFrame:
    """``(qid, docid, score, rank)``: top ``k`` of bag(norm) + boosted phrases."""
    bag_q = decomp.select("qid", F.lit(0).alias("sub_ord"), F.col("norm_query").alias("text"))
    bag = R.score_bm25(R.query_terms(bag_q, stemmer=idx.stemmer), idx, k1, b).select("qid", "docid", "score")
    pt = phrase_terms(decomp)
    known = idx.term_stats.select("term", "df").join(pt, "term")
    pidf = known.groupBy("qid", "pid", "boost", "plen").agg(
        F.sum(R.idf(F.col("df"), idx.n_docs)).alias("pidf"), F.count(F.lit(1)).alias("n_known")) \
        .filter(F.col("n_known") == F.col("plen"))
    ps = phrase_frequencies(pt, idx).join(pidf, ["qid", "pid"]).select(
        "qid", "docid",
        (F.col("boost") * F.col("pidf") * R.tf_norm(F.col("ptf"), F.col("dl"), idx.avg_dl, k1, b)).alias("score"))
    total = bag.unionByName(ps).groupBy("qid", "docid").agg(F.sum("score").alias("score"))
    return R.top_k(total, k, keys=("qid",)).select("qid", "docid", "score", "rank")
