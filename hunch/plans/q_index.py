"""Queries over the index tables and plain BM25."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import index as X
from ..operators import rank as R
from ..operators import stem as S
from ..sources.tables import benchmark_topics, conversation_topics, read_table
from . import sqlparts as P
from .registry import register

# --- T01 / T02 ------------------------------------------------------------------------

_QN_SQL = f"""
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS qid, {P.norm('text')} AS norm_query
FROM conversations WHERE role = 'user'"""


@register("query_normalize", _QN_SQL)
def query_normalize(spark, sf_dir):
    """T01-T03 over the user turns of ``conversations``."""
    return conversation_topics(spark, sf_dir).select("qid", T.normalize_query("query").alias("norm_query"))


_LATIN1 = ("array_to_string(list_transform(range(octet_length(encode(text))), lambda i: "
           "chr(('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::INTEGER)), '')")
_LATIN1_SQL = f"SELECT CAST(item_id AS VARCHAR) AS qid, {P.norm(_LATIN1)} AS norm_query FROM benchmark"


@register("query_latin1_mode", _LATIN1_SQL)
def query_latin1_mode(spark, sf_dir):
    """The ``latin1`` escape mode over ``benchmark``: UTF-8 bytes re-read as
    ISO-8859-1 before normalising (the oracle spells the re-decode byte by byte)."""
    return benchmark_topics(spark, sf_dir).select(
        "qid", T.normalize_query("query", escape_mode="latin1").alias("norm_query"))


# --- T09 / T10 / I01-I05 ------------------------------------------------------------------

_TC_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS docid, len({P.terms('text')})::BIGINT AS n_tokens,
       len({P.index_terms('text')})::BIGINT AS dl
FROM documents"""


@register("tokens_count", _TC_SQL)
def tokens_count(spark, sf_dir):
    """Tokens per document before and after the index stop list."""
    d = X.corpus_from_documents(read_table(spark, sf_dir, "documents"))
    return d.select("docid", F.size(T.terms("contents")).cast("bigint").alias("n_tokens"),
                    F.size(T.index_terms("contents")).cast("bigint").alias("dl"))


@register("postings", f"WITH {P.index_ctes()} SELECT term, docid, tf, dl FROM post")
def postings_q(spark, sf_dir):
    """I01."""
    return X.load_index(spark, sf_dir).postings.select("term", "docid", "tf", "dl")


@register("doc_lengths", f"WITH {P.index_ctes()} SELECT docid, dl FROM dstats")
def doc_lengths_q(spark, sf_dir):
    """I02."""
    return X.load_index(spark, sf_dir).doc_stats.select("docid", "dl")


@register("vocabulary", f"WITH {P.index_ctes()} SELECT term, df, cf FROM vocab")
def vocabulary_q(spark, sf_dir):
    """I03."""
    return X.load_index(spark, sf_dir).term_stats.select("term", "df", "cf")


_DV_SQL = f"""WITH {P.index_ctes()}
SELECT docid, string_agg(term || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY term) AS vector, count(*)::BIGINT AS n_terms
FROM post GROUP BY docid"""


@register("doc_vectors", _DV_SQL)
def doc_vectors_q(spark, sf_dir):
    """The map is rendered as sorted ``term:tf`` text for comparison."""
    v = X.load_index(spark, sf_dir).vectors()
    entries = F.map_entries("vector")
    return v.select("docid",
                    F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), " ").alias("vector"),
                    F.size(entries).cast("bigint").alias("n_terms"))


_CS_SQL = f"""WITH {P.index_ctes()}
SELECT count(*)::BIGINT AS n_docs, sum(dl)::BIGINT AS total_len, round(avg(dl), 6) AS avg_dl,
       (SELECT count(*)::BIGINT FROM vocab) AS n_terms, (SELECT count(*)::BIGINT FROM post) AS n_postings
FROM dstats"""


@register("corpus_stats", _CS_SQL)
def corpus_stats_q(spark, sf_dir):
    """I02/I03 scalars: documents, total and average length, vocabulary and postings size."""
    idx = X.load_index(spark, sf_dir)
    cs = X.corpus_stats(idx.doc_stats).select("n_docs", "total_len", F.round("avg_dl", 6).alias("avg_dl"))
    nt = idx.term_stats.agg(F.count(F.lit(1)).alias("n_terms"), F.sum("df").cast("bigint").alias("n_postings"))
    return cs.crossJoin(nt)


_SV_SQL = f"""WITH {P.index_ctes()}
SELECT term,
       CASE WHEN regexp_matches(term, 'ies$') AND NOT regexp_matches(term, '[ea]ies$') THEN regexp_replace(term, 'ies$', 'y')
            WHEN regexp_matches(term, 'es$') AND NOT regexp_matches(term, '[aeo]es$') THEN regexp_replace(term, 'es$', 'e')
            WHEN regexp_matches(term, 's$') AND NOT regexp_matches(term, '[us]s$') THEN regexp_replace(term, 's$', '')
            ELSE term END AS stem
FROM vocab"""


@register("stem_vocabulary", _SV_SQL)
def stem_vocabulary_q(spark, sf_dir):
    """T11 with the S stemmer over the whole vocabulary."""
    return S.stem_vocabulary(X.load_index(spark, sf_dir).term_stats, "s")


@register("stem_porter_vocabulary", f"WITH {P.index_ctes()} SELECT term, {S.porter_sql('term')} AS stem FROM vocab")
def stem_porter_vocabulary(spark, sf_dir):
    """T11 with the Porter stemmer over the whole vocabulary."""
    return S.stem_vocabulary(X.load_index(spark, sf_dir).term_stats, "porter")


# --- I06 / I10 / I11: BM25 top 50 per passage ----------------------------------------------

def passage_subqueries(spark, sf_dir):
    """One subquery per ``benchmark`` passage: its normalised text."""
    return benchmark_topics(spark, sf_dir).select("qid", F.lit(1).alias("sub_ord"),
                                                   T.normalize_query("query").alias("text"))


_BM25_SQL = f"""WITH {P.index_ctes()},
subq AS (SELECT CAST(item_id AS VARCHAR) AS qid, 1 AS sub_ord, {P.norm('text')} AS text FROM benchmark),
{P.bm25_ctes('subq', C.SUBQUERY_DEPTH)}
SELECT qid, docid, score, rank FROM hits"""


@register("bm25_topk", _BM25_SQL)
def bm25_topk(spark, sf_dir):
    """I06 + I10 + I11: BM25 (k1 1.2, b 0.75) top 50 documents for every passage."""
    idx = X.load_index(spark, sf_dir)
    hits = R.bm25_search(passage_subqueries(spark, sf_dir), idx, k=C.SUBQUERY_DEPTH)
    return hits.select("qid", "docid", "score", "rank")


_EMPTY_SQL = f"""WITH {P.index_ctes()},
topics AS (SELECT CAST(item_id AS VARCHAR) AS qid, text AS query FROM benchmark),
subq AS (SELECT qid, 1 AS sub_ord, {P.norm('query')} AS text FROM topics
         UNION ALL
         SELECT qid, 2 AS sub_ord, array_to_string(list_filter({P.words('lower(query)')}, lambda w: list_contains({P.ISTOP}, w)), ' ') AS text FROM topics),
{P.bm25_ctes('subq', C.SUBQUERY_DEPTH)}
SELECT s.qid, s.sub_ord, len({P.index_terms('s.text')})::BIGINT AS n_terms, count(h.docid)::BIGINT AS n_hits,
       max(h.score) AS top_score
FROM subq s LEFT JOIN hits h ON s.qid = h.qid AND s.sub_ord = h.sub_ord
GROUP BY s.qid, s.sub_ord, s.text"""


@register("bm25_empty_query", _EMPTY_SQL)
def bm25_empty_query(spark, sf_dir):
    """A list made only of stop words is empty, and its question is still answered.
    Every passage is asked twice: its normalised text, and the run of its own index stop
    words (which analyses to nothing)."""
    idx = X.load_index(spark, sf_dir)
    t = benchmark_topics(spark, sf_dir)
    stop = list(C.INDEX_STOP_WORDS)
    residue = F.array_join(F.filter(T.words(F.lower("query")), lambda w: w.isin(stop)), " ")
    subq = t.select("qid", F.lit(1).alias("sub_ord"), T.normalize_query("query").alias("text")).unionByName(
        t.select("qid", F.lit(2).alias("sub_ord"), residue.alias("text")))
    hits = R.bm25_search(subq, idx, k=C.SUBQUERY_DEPTH)
    per = hits.groupBy("qid", "sub_ord").agg(F.count(F.lit(1)).alias("n_hits"), F.max("score").alias("top_score"))
    return subq.join(per, ["qid", "sub_ord"], "left").select(
        "qid", "sub_ord", F.size(T.index_terms("text")).cast("bigint").alias("n_terms"),
        F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits"), "top_score")
