"""Queries for subqueries, fusion, presentation, the main flow and evaluation
(N17, I07, I08-bag, R01-R05, T04-T08, T19, S11-S13, E01-E04, P11, P12) over
``benchmark`` passages as questions and ``documents`` as the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import evaluate as E
from ..operators import fuse as U
from ..operators import index as X
from ..operators import rank as R
from ..sources.tables import benchmark_topics, passage_judgements
from . import search as S
from . import sqlparts as P
from .registry import register

BENCH_TOPICS_SQL = "SELECT CAST(item_id AS VARCHAR) AS qid, text AS query FROM benchmark"

_MEMO: dict = {}


def main_flow(spark, sf_dir, fl: S.Flavour = S.MAIN):
    """The main flow over the passages, memoised per application so that the keys
    reading its parts do not decompose and score twice."""
    key = (spark.sparkContext.applicationId, sf_dir, repr(fl))
    if key not in _MEMO:
        _MEMO[key] = S.search(benchmark_topics(spark, sf_dir), lambda: X.load_index(spark, sf_dir), fl)
    return _MEMO[key]


def _sql(body: str, c: int = C.RRF_C_MAIN, topics: str = BENCH_TOPICS_SQL) -> str:
    return f"WITH RECURSIVE {P.search_ctes(topics, c)}\n{body}"


# --- N17 / I07 ---------------------------------------------------------------------------------

@register("subqueries", _sql("SELECT qid, sub_ord, kind, text FROM subq"))
def subqueries_q(spark, sf_dir):
    """Every question's lists, duplicates merged at their first place."""
    return main_flow(spark, sf_dir)["lists"].filter(F.col("sub_ord") > 0)


@register("weighted_query_text", _sql("SELECT qid, text FROM lists WHERE sub_ord = 0"))
def weighted_query_text_q(spark, sf_dir):
    """The boosted query string of every question."""
    return main_flow(spark, sf_dir)["lists"].filter(F.col("sub_ord") == 0).select("qid", "text")


@register("bm25_boosted_bag", _sql("SELECT qid, docid, score, rank FROM hits WHERE sub_ord = 0"))
def bm25_boosted_bag(spark, sf_dir):
    """I08 (bag reading, V20): the boosted string analysed as a bag of words, top 100."""
    return main_flow(spark, sf_dir)["hits"].filter(F.col("sub_ord") == 0).select("qid", "docid", "score", "rank")


# --- R01 - R03 -----------------------------------------------------------------------------------

@register("rrf_c60", _sql("SELECT qid, docid, round(score, 9) AS score, first_sub_ord, first_rank FROM rrfs"))
def rrf_c60(spark, sf_dir):
    """Fused score of every listed document, c = 60."""
    hits = main_flow(spark, sf_dir)["hits"].select("qid", "sub_ord", "docid", "rank")
    return U.rrf_scores(hits, C.RRF_C_MAIN).withColumn("score", F.round("score", 9))


_RRF100_SQL = f"""WITH RECURSIVE {P.search_ctes(BENCH_TOPICS_SQL, C.RRF_C_COMPONENTS)}
SELECT qid, docid, round(score, 9) AS score, first_sub_ord, first_rank FROM rrfs"""


@register("rrf_c100", _RRF100_SQL)
def rrf_c100(spark, sf_dir):
    """The same lists fused with c = 100."""
    hits = main_flow(spark, sf_dir)["hits"].select("qid", "sub_ord", "docid", "rank")
    return U.rrf_scores(hits, C.RRF_C_COMPONENTS).withColumn("score", F.round("score", 9))


@register("fused_top50", _sql("SELECT qid, docid, score, rank FROM fused"))
def fused_top50(spark, sf_dir):
    """Top 50 per question, ties to the document met first."""
    return main_flow(spark, sf_dir)["fused"]


@register("search_main", _sql("SELECT qid, docid, score, rank FROM fused"))
def search_main(spark, sf_dir):
    """The main flow end to end (decompose, boost, subqueries, BM25, RRF c=60)."""
    return main_flow(spark, sf_dir)["fused"]


# --- T04 - T08, T19, S11, S12, P12, R04, S13 ------------------------------------------------------

_SNIP_SQL = f"""WITH {P.index_ctes()},
subq AS (SELECT CAST(item_id AS VARCHAR) AS qid, 1 AS sub_ord, {P.norm('text')} AS text FROM benchmark),
{P.bm25_ctes('subq', C.SUBQUERY_DEPTH)},
pairs AS (SELECT h.qid, h.docid, d.contents, b.text AS raw
          FROM hits h JOIN docs d USING (docid) JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = h.qid),
{P.snippet_ctes('pairs')}
SELECT qid, docid, snippet FROM snip"""


@register("snippets", _SNIP_SQL)
def snippets(spark, sf_dir):
    """Highlighted snippet for every (passage, top-50 BM25 document) pair."""
    idx = X.load_index(spark, sf_dir)
    from .q_index import passage_subqueries
    hits = R.bm25_search(passage_subqueries(spark, sf_dir), idx, k=C.SUBQUERY_DEPTH)
    j = hits.join(idx.corpus, "docid").join(benchmark_topics(spark, sf_dir), "qid")
    return T.with_snippet(j, "contents", "query").select("qid", "docid", "snippet")


_RES_SQL = _sql(f""",
pairs AS (SELECT f.qid, f.rank, f.docid, printf('%.4f', f.score) AS score_text,
                 split_part(d.contents, chr(10), 1) AS title, d.contents, t.query AS raw
          FROM fused f JOIN docs d USING (docid) JOIN topics t USING (qid)),
{P.snippet_ctes('pairs')}
SELECT qid, rank, docid, score_text, title, snippet FROM snip""")


@register("results", _RES_SQL)
def results(spark, sf_dir):
    """Rank, id, score (4 places), title, snippet of every fused result."""
    r = main_flow(spark, sf_dir)["results"]
    return r.select("qid", "rank", "docid", "score_text", "title", "snippet")


_LINES_SQL = _RES_SQL.replace("SELECT qid, rank, docid, score_text, title, snippet FROM snip", """SELECT unnest([
    'Rank ' || CAST(rank AS VARCHAR) || ' | DocID: ' || docid || ' | Score: ' || score_text, 'Title: ' || title, 'Snippet: ' || snippet]) AS line FROM snip""")


@register("result_lines", _LINES_SQL)
def result_lines(spark, sf_dir):
    """The display lines of every fused result, written as text files and read back."""
    from ..session import fresh_path
    from ..sources.sinks import write_result_lines
    path = fresh_path(spark, "result-lines")
    write_result_lines(main_flow(spark, sf_dir)["results"], path)
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


_RUN_SQL = _sql("""SELECT qid || ' Q0 ' || docid || ' ' || CAST(rank AS VARCHAR) || ' ' || printf('%.9f', score) || ' hunch' AS line
FROM fused""")


@register("run_file_lines", _RUN_SQL)
def run_file_lines(spark, sf_dir):
    """Ranked-run lines ``qid Q0 docid rank score tag``."""
    from ..sources.sinks import run_lines
    return run_lines(main_flow(spark, sf_dir)["fused"])


# --- E01 - E04, P11 ----------------------------------------------------------------------------------

_JUDGED = """judged AS (SELECT CAST(b.item_id AS VARCHAR) AS qid, max(CAST(d.doc_id AS VARCHAR)) AS docid
            FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY 1),
found AS (SELECT t.qid, j.docid AS expected_docid, f.rank AS found_rank
          FROM topics t LEFT JOIN judged j USING (qid) LEFT JOIN fused f ON f.qid = t.qid AND f.docid = j.docid)"""


def _found(spark, sf_dir):
    idx = X.load_index(spark, sf_dir)
    qrels = passage_judgements(spark, sf_dir, idx.postings, idx.term_stats)
    judged = E.one_judgement(qrels, "docid")
    return E.found_rank(benchmark_topics(spark, sf_dir), judged, main_flow(spark, sf_dir)["fused"])


@register("eval_found_rank", _sql(f", {_JUDGED} SELECT qid, expected_docid, found_rank FROM found"))
def eval_found_rank(spark, sf_dir):
    """E01 + E02: rank of the judged document in the fused list (NULL = absent)."""
    return _found(spark, sf_dir)


_STATUS = ("CASE WHEN expected_docid IS NULL THEN 'no_judgement' WHEN found_rank IS NOT NULL THEN 'found' "
           "ELSE 'not_in_top' END")


@register("eval_status", _sql(f", {_JUDGED} SELECT qid, expected_docid, found_rank, {_STATUS} AS status FROM found"))
def eval_status(spark, sf_dir):
    """Found / not_in_top / no_judgement."""
    return E.status(_found(spark, sf_dir))


_ACC = """SELECT CAST(q.item_id % 3 AS BIGINT) AS file_pos,
       count(*) FILTER (WHERE found_rank IS NOT NULL)::BIGINT AS hits,
       count(*) FILTER (WHERE expected_docid IS NOT NULL)::BIGINT AS judged,
       round(CASE WHEN count(*) FILTER (WHERE expected_docid IS NOT NULL) = 0 THEN NULL
             ELSE (count(*) FILTER (WHERE found_rank IS NOT NULL))::DOUBLE
                  / (count(*) FILTER (WHERE expected_docid IS NOT NULL))::DOUBLE * 100.0 END, 2) AS accuracy
FROM found JOIN benchmark q ON CAST(q.item_id AS VARCHAR) = found.qid
GROUP BY ROLLUP (CAST(q.item_id % 3 AS BIGINT))"""


@register("eval_accuracy", _sql(f", {_JUDGED} {_ACC}"))
def eval_accuracy(spark, sf_dir):
    """E03 + E04: hits / judged per "file" (item_id mod 3 groups the passages into three
    judgement files) and overall (file_pos NULL)."""
    f = _found(spark, sf_dir).withColumn("file_pos", (F.col("qid").cast("bigint") % 3))
    return E.accuracy(f)


# --- I08 phrase reading / I13 ---------------------------------------------------------------------------

_K1, _B = C.BM25_K1, C.BM25_B
_TFN = f"({{tf}} / ({{tf}} + {_K1}::DOUBLE * ({1.0 - _B}::DOUBLE + {_B}::DOUBLE * {{dl}} / cstats.avg_dl)))"
_IDF = "ln(1.0::DOUBLE + (cstats.n_docs - vocab.df + 0.5::DOUBLE) / (vocab.df + 0.5::DOUBLE))"
PHRASE_BODY = f""",
bqt AS (SELECT qid, term, count(*)::DOUBLE AS qtf FROM (SELECT qid, unnest({P.index_terms('norm_query')}) AS term FROM dn)
        GROUP BY qid, term),
bsc AS (SELECT bqt.qid, post.docid, sum(bqt.qtf * {_IDF} * {_TFN.format(tf='post.tf', dl='post.dl')}) AS score
        FROM bqt JOIN vocab USING (term) JOIN post USING (term) CROSS JOIN cstats GROUP BY bqt.qid, post.docid),
ph0 AS (SELECT qid, l, unnest(range(len(l))) AS pid
        FROM (SELECT qid, list_concat(list_transform(entities, lambda e: {{'text': e, 'boost': {float(C.ENTITY_BOOST)}::DOUBLE}}),
                                      list_transform(time, lambda t: {{'text': t, 'boost': {float(C.TIME_BOOST)}::DOUBLE}})) AS l FROM dn)),
ph1 AS (SELECT qid, pid, l[pid + 1].boost AS boost, {P.index_terms('l[pid + 1].text')} AS terms FROM ph0),
pt AS (SELECT qid, pid, boost, len(terms) AS plen, unnest(terms) AS term, unnest(range(len(terms))) AS off FROM ph1 WHERE len(terms) > 0),
pidf AS (SELECT pt.qid, pt.pid, pt.boost, pt.plen, sum({_IDF}) AS pidf FROM pt JOIN vocab USING (term) CROSS JOIN cstats
         GROUP BY pt.qid, pt.pid, pt.boost, pt.plen HAVING count(*) = pt.plen),
posn AS (SELECT docid, len(toks) AS dl, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM docs),
starts AS (SELECT pt.qid, pt.pid, posn.docid, posn.dl, posn.pos - pt.off AS start, pt.plen, count(DISTINCT pt.off) AS n
           FROM posn JOIN pt USING (term) GROUP BY pt.qid, pt.pid, posn.docid, posn.dl, posn.pos - pt.off, pt.plen),
ptf AS (SELECT qid, pid, docid, dl, count(*) AS ptf FROM starts WHERE n = plen GROUP BY qid, pid, docid, dl),
psc AS (SELECT ptf.qid, ptf.docid, pidf.boost * pidf.pidf * {_TFN.format(tf='ptf.ptf', dl='ptf.dl')} AS score
        FROM ptf JOIN pidf USING (qid, pid) CROSS JOIN cstats),
ptot AS (SELECT qid, docid, round(sum(score), 6) AS score FROM (SELECT qid, docid, score FROM bsc UNION ALL SELECT qid, docid, score FROM psc)
         GROUP BY qid, docid),
prk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docid)::BIGINT AS rank FROM ptot)
SELECT qid, docid, score, rank FROM prk WHERE rank <= {C.WEIGHTED_DEPTH}"""


@register("bm25_boosted_phrase", _sql(PHRASE_BODY))
def bm25_boosted_phrase(spark, sf_dir):
    """I08 (phrase reading) + I13: the boosted query with entity / time spans scored as
    exact phrases over positional postings, top 100 per passage."""
    from . import phrase
    decomp = main_flow(spark, sf_dir)["decomposition"]
    idx = X.load_index(spark, sf_dir)
    return phrase.boosted_phrase_hits(decomp, idx)
