"""Queries for the rule annotator (A01-A07) and decomposition rules (N01-N17, T12-T15),
run over every user turn of ``conversations`` — or over every document where the
rule needs capitalised names, which only ``documents`` contains."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import annotate as A
from ..operators import decompose as D
from ..operators import lexicon as L
from ..session import cut_lineage
from ..sources.tables import conversation_topics, read_table, spread
from . import sql_rules as S
from .registry import register

TOPICS_SQL = ("SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS qid, text AS query "
              "FROM conversations WHERE role = 'user'")
SEP = " | "


DOC_TOPICS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS qid, text AS query FROM documents"


def _with(body: str) -> str:
    return f"WITH RECURSIVE {S.rule_ctes(TOPICS_SQL)}\n{body}"


def _with_docs(body: str) -> str:
    return f"WITH RECURSIVE {S.rule_ctes(DOC_TOPICS_SQL)}\n{body}"


def _j(x: str) -> str:
    return f"array_to_string({x}, '{SEP}')"


def _sj(c):
    return F.array_join(c, SEP)


def doc_topics(spark, sf_dir):
    """Every document as a question: the only table with capitalised name runs."""
    return spread(read_table(spark, sf_dir, "documents")).select(F.col("doc_id").cast("string").alias("qid"),
                                                         F.col("text").alias("query"))


def _topics(spark, sf_dir, source: str):
    return spread(conversation_topics(spark, sf_dir)) if source == "conversations" else doc_topics(spark, sf_dir)


def _base(spark, sf_dir, source: str = "conversations", columns=A.COLUMNS):
    """Topics, their annotations (written once, for rules that read them several times: the
    ``columns`` that these read) and sentences."""
    topics = _topics(spark, sf_dir, source)
    return topics, cut_lineage(A.annotate(topics).select(*columns), "annotations"), A.sentences(topics)


def _once(spark, sf_dir, source: str = "documents"):
    """Topics and annotations for a rule that reads these in one pass: nothing is written between, and
    the plan keeps the columns that the rule reads."""
    topics = _topics(spark, sf_dir, source)
    return topics, A.annotate(topics)


# --- A-series --------------------------------------------------------------------------------

@register("rule_sentences", _with("SELECT qid, sent_i, sent FROM sents"))
def rule_sentences(spark, sf_dir):
    """A01."""
    return A.sentences(conversation_topics(spark, sf_dir))


@register("rule_tokens_pos", _with("SELECT qid, sent_i, tok_i, text, lemma, pos FROM ann"))
def rule_tokens_pos(spark, sf_dir):
    """A02 + A03."""
    return _base(spark, sf_dir)[1].select("qid", "sent_i", "tok_i", "text", "lemma", "pos")


@register("rule_svo", _with("SELECT qid, tok_i, dep, head_i, chunk_id, is_chunk_root FROM ann"))
def rule_svo(spark, sf_dir):
    """A04 (+ A07 membership): dependency label and head of every token."""
    return _base(spark, sf_dir)[1].select("qid", "tok_i", "dep", "head_i", "chunk_id", "is_chunk_root")


@register("rule_entities", _with_docs("SELECT qid, ent_id, ent_label, ent_text FROM spans WHERE ent_label NOT IN ('DATE', 'TIME')"))
def rule_entities(spark, sf_dir):
    """Name spans."""
    return A.spans(_topics(spark, sf_dir, "documents")).filter(~F.col("ent_label").isin(C.TIME_LABELS))


_TOK = L.TOKEN_RE.replace("'", "''")
_GAZ_SQL = _with_docs(f""",
b0 AS (SELECT regexp_extract_all(lower(text), '{_TOK}') AS l FROM benchmark),
p0 AS (SELECT l[1:3] AS w, 'WORK_OF_ART' AS label FROM b0 UNION ALL SELECT l[2:3], 'ORG' FROM b0 UNION ALL SELECT l[3:6], 'GPE' FROM b0
       UNION ALL SELECT regexp_extract_all(lower(n_name), '{_TOK}'), 'GPE' FROM nation),
phr AS (SELECT array_to_string(w, ' ') AS phrase, len(w) AS n, min(label) AS label FROM p0 WHERE len(w) > 0 GROUP BY 1, 2),
lens AS (SELECT DISTINCT n FROM phr),
low AS (SELECT qid, sent_i, list_transform(l, lambda x: lower(x)) AS l FROM t0),
spot AS (SELECT qid, sent_i, l, unnest(range(len(l))) AS s FROM low),
gram AS (SELECT qid, sent_i, s, n, array_to_string(l[s + 1:s + n], ' ') AS phrase FROM spot, lens WHERE s + n <= len(l)),
hit AS (SELECT qid, sent_i, s, max(n) AS n, arg_max(phrase, n) AS phrase, arg_max(label, n) AS label
        FROM gram JOIN phr USING (phrase, n) GROUP BY qid, sent_i, s),
nx AS (SELECT h.*, k.s AS nexts FROM hit h ASOF LEFT JOIN hit k ON h.qid = k.qid AND h.sent_i = k.sent_i AND h.s + h.n <= k.s),
chain AS (SELECT nx.* FROM nx JOIN (SELECT qid, sent_i, min(s) AS s FROM hit GROUP BY qid, sent_i) f USING (qid, sent_i, s)
          UNION ALL SELECT nx.* FROM chain c JOIN nx ON nx.qid = c.qid AND nx.sent_i = c.sent_i AND nx.s = c.nexts)
SELECT qid, sent_i, s::INTEGER AS start_pos, (s + n)::INTEGER AS end_pos, phrase, label FROM chain""")


@register("gazetteer_spans", _GAZ_SQL)
def gazetteer_spans(spark, sf_dir):
    """Spans of a phrase table in all documents. The phrases are overlapping pieces of the
    passages' beginnings and the nations' names, so the leftmost-longest choice acts."""
    from ..operators import gazetteer as G
    w = F.regexp_extract_all(F.lower("text"), F.lit(L.TOKEN_RE), 0)
    pieces = [(1, 3, "WORK_OF_ART"), (2, 2, "ORG"), (3, 4, "GPE")]
    b = read_table(spark, sf_dir, "benchmark").select(F.explode(F.array(*(
        F.struct(F.array_join(F.slice(w, i, n), " ").alias("phrase"), F.lit(label).alias("label")) for i, n, label in pieces))).alias("p")).select("p.*")
    names = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("phrase"), F.lit("GPE").alias("label"))
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("qid"), F.col("text").alias("query"))
    s = G.phrase_spans(A.sentences(docs), b.unionByName(names))
    return s.withColumnRenamed("start", "start_pos").withColumnRenamed("end", "end_pos")


@register("rule_time_spans", _with_docs("SELECT qid, ent_id, ent_label, ent_text FROM spans WHERE ent_label IN ('DATE', 'TIME')"))
def rule_time_spans(spark, sf_dir):
    """Time spans."""
    return A.spans(_topics(spark, sf_dir, "documents")).filter(F.col("ent_label").isin(C.TIME_LABELS))


@register("rule_noun_chunks", _with("SELECT qid, chunk_id, chunk_text, root_text FROM chunks"))
def rule_noun_chunks(spark, sf_dir):
    """A07."""
    return D.chunk_texts(_base(spark, sf_dir)[1])


# --- N-series --------------------------------------------------------------------------------

@register("decomp_label_route", _with_docs(f"SELECT qid, {_j('time')} AS time, {_j('entities')} AS entities FROM routed"))
def decomp_label_route(spark, sf_dir):
    """N01."""
    r = D.route_labels(A.spans(_topics(spark, sf_dir, "documents")))
    return r.select("qid", _sj("time").alias("time"), _sj("entities").alias("entities"))


@register("decomp_fallback_names", _with_docs(f"SELECT qid, {_j('entities')} AS entities FROM fallback"))
def decomp_fallback_names(spark, sf_dir):
    """N02 (T15 when no entity span was found)."""
    topics = _topics(spark, sf_dir, "documents")
    r = D.with_fallback_names(topics, D.route_labels(A.spans(topics)))
    return r.select("qid", _sj("entities").alias("entities"))


@register("decomp_media_type", _with_docs(f"SELECT qid, {_j('media_type')} AS media_type FROM media"))
def decomp_media_type(spark, sf_dir):
    """N03 with the fixed media list (rarely hit by this corpus: the rows are few)."""
    return D.media_types(_once(spark, sf_dir)[1]).select("qid", _sj("media_type").alias("media_type"))


@register("decomp_noun_desc_v1", _with("SELECT qid, chunk_id, description FROM cdesc1"))
def decomp_noun_desc_v1(spark, sf_dir):
    """N04."""
    return D.chunk_descriptions(D.chunk_texts(_base(spark, sf_dir)[1]), 1)


@register("decomp_noun_desc_v2", _with("SELECT qid, chunk_id, description FROM cdesc2"))
def decomp_noun_desc_v2(spark, sf_dir):
    """N05 (T12 article strip)."""
    return D.chunk_descriptions(D.chunk_texts(_base(spark, sf_dir)[1]), 2)


@register("decomp_svo_v1", _with("SELECT qid, tok_i, phrase FROM svo"))
def decomp_svo_v1(spark, sf_dir):
    """N06."""
    return D.svo_v1(_base(spark, sf_dir)[1])


_EV_SQL = _with("""SELECT v.qid, v.tok_i, v.lemma AS verb, k.subj, k.obj_last, coalesce(k.negated, false) AS negated
FROM ann v LEFT JOIN kids k ON k.qid = v.qid AND k.head_i = v.tok_i WHERE v.pos = 'VERB'""")


@register("decomp_events", _EV_SQL)
def decomp_events(spark, sf_dir):
    """Per verb, last subject, last object and negation among its children."""
    ann = _base(spark, sf_dir)[1]
    v = ann.filter(F.col("pos") == "VERB").select("qid", "tok_i", F.col("lemma").alias("verb"))
    k = D.children_summary(ann).withColumnRenamed("head_i", "tok_i")
    return v.join(k, ["qid", "tok_i"], "left").select(
        "qid", "tok_i", "verb", "subj", "obj_last", F.coalesce("negated", F.lit(False)).alias("negated"))


@register("decomp_subtree_phrases", _with("SELECT qid, prep_i, head_i, phrase FROM subtree"))
def decomp_subtree_phrases(spark, sf_dir):
    """N07b (all tokens below each preposition)."""
    return D.subtree_phrases(_base(spark, sf_dir)[1]).select("qid", "prep_i", "head_i", "phrase")


_PB_SQL = _with(f"""SELECT qid, tok_i, raw_subject, back_ref FROM ev_all
WHERE {S._in('lower(raw_subject)', C.RESOLVE_PRONOUNS)}""")


@register("decomp_pronoun_back", _PB_SQL)
def decomp_pronoun_back(spark, sf_dir):
    """Nearest earlier antecedent in the sentence for verbs with a pronoun subject."""
    ann = _base(spark, sf_dir)[1]
    k = D.children_summary(ann).withColumnRenamed("head_i", "tok_i")
    v = ann.filter(F.col("pos") == "VERB").select("qid", "tok_i")
    a = D.antecedents(ann).select("qid", "tok_i", "back_ref")
    j = v.join(k, ["qid", "tok_i"]).join(a, ["qid", "tok_i"], "left")
    return j.filter(F.lower("subj").isin(C.RESOLVE_PRONOUNS)).select(
        "qid", "tok_i", F.col("subj").alias("raw_subject"), "back_ref")


@register("decomp_pronoun_first", _with_docs("SELECT qid, first_person FROM firstp"))
def decomp_pronoun_first(spark, sf_dir):
    """First PERSON span of each question."""
    return A.spans(_topics(spark, sf_dir, "documents")).filter(F.col("ent_label") == "PERSON") \
        .groupBy("qid").agg(F.min_by("ent_text", "ent_id").alias("first_person"))


_EF_SQL = _with(f"""SELECT qid, tok_i, subject, verb, object, {_j('prep_phrases')} AS prep_phrases, negated, clause
FROM events""")


@register("decomp_event_filter", _EF_SQL)
def decomp_event_filter(spark, sf_dir):
    """Resolved events with a subject and an object or a prepositional phrase."""
    _, ann, sents = _base(spark, sf_dir)
    ev = D.events(ann, sents)
    return ev.select("qid", "tok_i", "subject", "verb", "object", _sj("prep_phrases").alias("prep_phrases"),
                     "negated", "clause")


@register("decomp_relclause", _with_docs("SELECT qid, tok_i, clause FROM rel"))
def decomp_relclause(spark, sf_dir):
    """N11."""
    _, ann, sents = _base(spark, sf_dir, "documents", ["qid", "sent_i", "tok_i", "text", "pos"])
    return D.relative_clauses(ann, sents)


@register("decomp_event_phrases", _with("SELECT qid, tok_i, phrase FROM evphr"))
def decomp_event_phrases(spark, sf_dir):
    """N12."""
    _, ann, sents = _base(spark, sf_dir)
    return D.event_phrases(D.events(ann, sents))


@register("decomp_desc_clean", _with(f"SELECT qid, {_j('descriptions')} AS descriptions FROM decomp"))
def decomp_desc_clean(spark, sf_dir):
    """N13 (v2: chunks + relative clauses + event phrases, 2-10 words, sorted distinct)."""
    topics, ann, sents = _base(spark, sf_dir)
    return D.decompose(topics, ann, sents).select("qid", _sj("descriptions").alias("descriptions"))


@register("entity_clean_v1", _with_docs(f"SELECT qid, {_j('entities')} AS entities FROM ents1"))
def entity_clean_v1(spark, sf_dir):
    """N14 (compat trimming, as the first decomposer behaves)."""
    topics = _topics(spark, sf_dir, "documents")
    r = topics.select("qid").join(D.route_labels(A.spans(topics)), "qid", "left")
    return D.with_clean_entities_v1(r, "entities", "compat").select("qid", _sj("entities").alias("entities"))


@register("entity_clean_v2", _with_docs(f"SELECT qid, {_j('entities')} AS entities FROM ents2"))
def entity_clean_v2(spark, sf_dir):
    """N15 (fixed trimming)."""
    topics, ann, _ = _base(spark, sf_dir, "documents", ["qid", "tok_i", "text", "pos", "ent_id", "ent_label"])
    r = D.with_fallback_names(topics, D.route_labels(D.entity_spans(ann)))
    propn = ann.filter(F.col("pos") == "PROPN").groupBy("qid").agg(F.collect_set("text").alias("propn"))
    r = r.join(propn, "qid", "left")
    return D.with_clean_entities_v2(r, "entities", "propn", "fixed").select("qid", _sj("entities").alias("entities"))


_DC_SQL = _with(f"""SELECT qid, {_j('media_type')} AS media_type, {_j('entities')} AS entities, {_j('time')} AS time,
       {_j('descriptions')} AS descriptions,
       (SELECT count(*) FROM events e WHERE e.qid = d.qid)::BIGINT AS n_events
FROM decomp d""")


@register("decomposition", _DC_SQL)
def decomposition(spark, sf_dir):
    """The assembled decomposition row per question."""
    topics, ann, sents = _base(spark, sf_dir)
    d = D.decompose(topics, ann, sents)
    return d.select("qid", _sj("media_type").alias("media_type"), _sj("entities").alias("entities"),
                    _sj("time").alias("time"), _sj("descriptions").alias("descriptions"),
                    F.size("events").cast("bigint").alias("n_events"))


_DV1_SQL = _with(f"""SELECT qid, {_j('media_type')} AS media_type, {_j('entities')} AS entities, {_j('time')} AS time,
       {_j('descriptions')} AS descriptions FROM decomp1""")


@register("decomposition_v1", _DV1_SQL)
def decomposition_v1(spark, sf_dir):
    """N16 for the first decomposer."""
    topics, ann, _ = _base(spark, sf_dir)
    d = D.decompose_v1(topics, ann, "compat")
    return d.select("qid", _sj("media_type").alias("media_type"), _sj("entities").alias("entities"),
                    _sj("time").alias("time"), _sj("descriptions").alias("descriptions"))
