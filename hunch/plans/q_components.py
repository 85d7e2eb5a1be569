"""Queries for the model-reply flavour (T16-T18, P08-P10, I09, R02, R06) over
``benchmark`` passages; replies are derived from the data (see
``replies_from_decomposition``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import annotate as A
from ..operators import components as M
from ..operators import decompose as D
from ..operators import index as X
from ..session import cut_lineage
from ..sources.tables import benchmark_topics
from . import search as S
from . import sqlparts as P
from .q_search import BENCH_TOPICS_SQL
from .registry import register

SEP = " | "
_MEMO: dict = {}


# FIXED VALUES: what the filters P08-P10 and the attribute boosts act on, added to every reply
CUES = {"entities": ["Man", "Anna Lee", "", "ghost"], "attributes": ["R Rated horror", "Cannes", "some crazy shit"],
        "descriptions": ["robot", "robot kid", "", "an old shit film"]}


def replies_from_decomposition(decomp, ann):
    """A stand-in reply table derived from the data: each question's rule decomposition
    (plus its noun-chunk roots as attributes) rendered as a fenced JSON reply. Failing ones are
    added under ids of their own: free text, an array, prose after the object, single quotes."""
    roots = D.chunk_texts(ann).groupBy("qid").agg(
        D.sorted_set(F.collect_list(F.lower("root_text"))).alias("attributes"))
    d = decomp.join(roots, "qid", "left").withColumn(
        "attributes", F.coalesce("attributes", F.array().cast("array<string>")))
    for f, extra in CUES.items():
        d = d.withColumn(f, F.concat(f, F.array(*[F.lit(x) for x in extra])))
    body = F.to_json(F.struct(*[F.col(f) for f in M.FIELDS]))
    reply = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    bad = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in (
        ("free", F.lit("sorry, no")), ("array", F.lit("[1]")), ("prose", F.concat(reply, F.lit("\nthat is all"))),
        ("quotes", F.lit("{'media_type': ['book']}")))])
    spoiled = d.select("qid", F.explode(bad).alias("b"), reply.alias("r")).select(F.concat_ws("-", "qid", "b.k").alias("qid"), F.col("b.v").alias("reply"))
    return d.select("qid", reply.alias("reply")).unionByName(spoiled)


def components(spark, sf_dir):
    """``(topics, parsed, filtered)`` memoised per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        topics = benchmark_topics(spark, sf_dir)
        ann = cut_lineage(A.annotate(topics), "annotations")
        decomp = D.decompose(topics, ann, A.sentences(topics))
        replies = cut_lineage(replies_from_decomposition(decomp, ann), "replies")
        parsed = M.parse_replies(replies)
        _MEMO[key] = (topics, parsed, M.filter_components(parsed))
    return _MEMO[key]


def _q(x: str) -> str:
    return P.q(x)


_GEN = P.lst(C.GENERIC_ENTITIES)
_HIGH = P.lst(C.HIGH_BOOST_ATTRIBUTES)


def _field(f: str) -> str:
    return f"coalesce(CAST(json_extract(r, '$.{f}') AS VARCHAR[]), []::VARCHAR[]) AS {f}"


def _cue(f: str) -> str:
    return "[" + ", ".join(f"'{x}'" for x in CUES[f]) + "]"


_COMP_CTES = f"""
attrs AS (SELECT qid, list_sort(list_distinct(list(lower(root_text)))) AS attributes FROM chunks GROUP BY qid),
replies AS (SELECT d.qid,
              '```json' || chr(10) || json_object('media_type', d.media_type, 'entities', list_concat(d.entities, {_cue('entities')}),
                        'attributes', list_concat(coalesce(a.attributes, []::VARCHAR[]), {_cue('attributes')}), 'time', d.time,
                        'descriptions', list_concat(d.descriptions, {_cue('descriptions')}))::VARCHAR || chr(10) || '```' AS reply
            FROM decomp d LEFT JOIN attrs a USING (qid)),
all_replies AS (SELECT qid, reply FROM replies UNION ALL SELECT qid || '-free', 'sorry, no' FROM replies
            UNION ALL SELECT qid || '-array', '[1]' FROM replies UNION ALL SELECT qid || '-prose', reply || chr(10) || 'that is all' FROM replies
            UNION ALL SELECT qid || '-quotes', '{{''media_type'': [''book'']}}' FROM replies),
stripped AS (SELECT qid, regexp_replace(trim(reply), {_q(C.CODE_FENCE_RE)}, '', 'g') AS r0 FROM all_replies),
valid AS (SELECT qid, CASE WHEN json_valid(r0) THEN r0 ELSE 'null' END AS r1 FROM stripped),
objs AS (SELECT qid, CASE WHEN json_type(r1) = 'OBJECT' THEN r1 ELSE '{{}}' END AS r FROM valid),
parsed AS (SELECT qid, {', '.join(_field(f) for f in M.FIELDS)} FROM objs),
comps AS (SELECT qid, media_type, time,
            list_filter(entities, lambda e: e <> '' AND NOT list_contains({_GEN}, lower(e))) AS entities,
            list_filter(list_transform(attributes, lambda a: CASE WHEN contains(lower(a), {_q(C.ATTRIBUTE_RATED_MARK)}) THEN {_q(C.ATTRIBUTE_RATED_VALUE)}
                                                              WHEN contains(lower(a), {_q(C.ATTRIBUTE_DROP_MARK)}) THEN NULL
                                                              ELSE lower(a) END), lambda a: a IS NOT NULL) AS attributes,
            list_filter(descriptions, lambda x: x <> '' AND len(list_filter(string_split_regex(x, {_q(C.BLANK_RE)}), lambda w: w <> '')) > 1
                                               AND NOT contains(lower(x), {_q(C.DESCRIPTION_DROP_MARK)})) AS descriptions
          FROM parsed)"""

_WT_ATTR = (f"array_to_string(list_concat(list_concat(list_concat([norm_query], "
            f"list_transform(entities, lambda e: '\"' || e || '\"^{C.ENTITY_BOOST}')), "
            f"list_transform(time, lambda t: '\"' || t || '\"^{C.TIME_BOOST}')), "
            f"list_transform(attributes, lambda a: '\"' || a || '\"^' || CASE WHEN list_contains({_HIGH}, lower(a)) "
            f"THEN '{C.ATTRIBUTE_BOOST_HIGH}' ELSE '{C.ATTRIBUTE_BOOST}' END)), ' ')")

_PARTS = ("list_concat(list_concat(list_concat(list_concat(list_concat([{'kind': 'norm', 'text': norm_query}], "
          "list_transform(entities, lambda x: {'kind': 'entities', 'text': x})), "
          "list_transform(time, lambda x: {'kind': 'time', 'text': x})), "
          "list_transform(descriptions, lambda x: {'kind': 'descriptions', 'text': x})), "
          "list_transform(media_type, lambda x: {'kind': 'media_type', 'text': x})), "
          "list_transform(attributes, lambda x: {'kind': 'attributes', 'text': x}))")

_LISTS = f"""{_COMP_CTES},
dn AS (SELECT c.*, t.query, {P.norm('t.query')} AS norm_query FROM comps c JOIN topics t USING (qid)),
sq0 AS (SELECT qid, {_PARTS} AS l FROM dn),
sq1 AS (SELECT qid, l, unnest(range(len(l))) AS i FROM sq0),
sq2 AS (SELECT qid, (i + 1)::INTEGER AS sub_ord, l[i + 1].kind AS kind, l[i + 1].text AS text FROM sq1),
subq AS (SELECT qid, min(sub_ord) AS sub_ord, arg_min(kind, sub_ord) AS kind, text FROM sq2 GROUP BY qid, text),
lists AS (SELECT qid, 0 AS sub_ord, 'weighted' AS kind, {_WT_ATTR} AS text FROM dn
          UNION ALL SELECT qid, sub_ord, kind, text FROM subq)"""


def _sql(body: str) -> str:
    return f"WITH RECURSIVE {P.search_ctes(BENCH_TOPICS_SQL, C.RRF_C_COMPONENTS, lists_sql=_LISTS)}\n{body}"


def _j(x: str) -> str:
    return f"array_to_string({x}, '{SEP}')"


@register("prompt_table", f"SELECT qid, {P.q(C.DECOMPOSE_PROMPT_TEMPLATE.split('{query}')[0])} || query || "
                          f"{P.q(C.DECOMPOSE_PROMPT_TEMPLATE.split('{query}')[1])} AS prompt FROM ({BENCH_TOPICS_SQL})")
def prompt_table_q(spark, sf_dir):
    """The decomposition prompt of every passage (for an offline batch job)."""
    return M.prompt_table(benchmark_topics(spark, sf_dir))


@register("llm_reply_parse", _sql(f"SELECT qid, {', '.join(_j(f) + ' AS ' + f for f in M.FIELDS)} FROM parsed"))
def llm_reply_parse(spark, sf_dir):
    """T16 + T17: fence strip and JSON parse of every reply; failures give five empty lists."""
    _, parsed, _ = components(spark, sf_dir)
    return parsed.select("qid", *[F.array_join(f, SEP).alias(f) for f in M.FIELDS])


@register("filter_generic_entities", _sql(f"SELECT qid, {_j('entities')} AS entities FROM comps"))
def filter_generic_entities(spark, sf_dir):
    """P08."""
    return components(spark, sf_dir)[2].select("qid", F.array_join("entities", SEP).alias("entities"))


@register("filter_attributes", _sql(f"SELECT qid, {_j('attributes')} AS attributes FROM comps"))
def filter_attributes(spark, sf_dir):
    """P09."""
    return components(spark, sf_dir)[2].select("qid", F.array_join("attributes", SEP).alias("attributes"))


@register("filter_descriptions", _sql(f"SELECT qid, {_j('descriptions')} AS descriptions FROM comps"))
def filter_descriptions(spark, sf_dir):
    """P10."""
    return components(spark, sf_dir)[2].select("qid", F.array_join("descriptions", SEP).alias("descriptions"))


def components_flow(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir, "flow")
    if key not in _MEMO:
        topics, _, comps = components(spark, sf_dir)
        _MEMO[key] = S.search(topics, lambda: X.load_index(spark, sf_dir), S.COMPONENTS, decomp=comps.join(topics, "qid"))
    return _MEMO[key]


@register("weighted_query_text_attr", _sql("SELECT qid, text FROM lists WHERE sub_ord = 0"))
def weighted_query_text_attr(spark, sf_dir):
    """Boosted string with attribute boosts (3 for the listed ones, else 2)."""
    return components_flow(spark, sf_dir)["lists"].filter(F.col("sub_ord") == 0).select("qid", "text")


@register("search_components", _sql("SELECT qid, docid, score, rank FROM fused"))
def search_components(spark, sf_dir):
    """The reply-driven flow end to end (filters, attribute boosts, RRF c=100)."""
    return components_flow(spark, sf_dir)["fused"]
