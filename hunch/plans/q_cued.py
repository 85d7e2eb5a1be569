"""Keys whose rules must fire: passages with a cue sentence appended.

The test tables hold no media words, years, negations, ``who``/``where`` clauses or names of
several words, so rules for them pass on empty output elsewhere. Here every ``benchmark``
passage gets one of five fixed cue sentences; two of its own words, capitalised, serve as a
name, which makes an entity whose phrase does occur in the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as A
from ..operators import decompose as D
from ..operators import index as X
from ..session import cut_lineage
from ..sources.tables import read_table
from . import phrase
from . import search as S
from . import sql_rules as R
from .q_search import PHRASE_BODY, _sql
from .registry import register

# FIXED VALUES: cue sentences; {n} stands for the name
CUES = ["George Clooney movie where a woman witnesses a murder through the window and he goes to trial",
        "{n} was a film from 1994. The woman did not find a robot in the 90s.",
        "A man who runs. The man saw {n} and he never liked the house.",
        "{n} directed it with Anna Lee Ray in Boston.",
        "It is a book where women cook."]
SEP = " | "
_PAIR = r"([a-z]{2,}) ([a-z]{2,})"


def cued_topics(spark, sf_dir):
    """``(qid, query)``: every passage and its cue (by item number)."""
    b = read_table(spark, sf_dir, "benchmark")
    low = F.lower("text")
    word = lambda i: F.regexp_extract(low, _PAIR, i)
    cap = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))
    name = F.when(word(1) == "", "Anna Lee").otherwise(F.concat_ws(" ", cap(word(1)), cap(word(2))))
    cue = F.element_at(F.array(*[F.lit(c) for c in CUES]), (F.col("item_id") % len(CUES) + 1).cast("int"))
    return b.select(F.col("item_id").cast("string").alias("qid"), F.concat_ws(" ", "text", F.replace(cue, F.lit("{n}"), name)).alias("query"))


_W = "regexp_extract(lower(text), '([a-z]{{2,}}) ([a-z]{{2,}})', {})".format
_CAP = "upper(substring({0}, 1, 1)) || substring({0}, 2)".format
_NAME = f"CASE WHEN {_W(1)} = '' THEN 'Anna Lee' ELSE {_CAP(_W(1))} || ' ' || {_CAP(_W(2))} END"
CUED_SQL = (f"SELECT CAST(item_id AS VARCHAR) AS qid, text || ' ' || replace(list_extract([{', '.join(repr(c) for c in CUES)}], "
            f"(item_id % {len(CUES)} + 1)::INTEGER), '{{n}}', {_NAME}) AS query FROM benchmark")

_MEMO: dict = {}


def _rules(spark, sf_dir):
    topics = cued_topics(spark, sf_dir)
    return topics, cut_lineage(A.annotate(topics), "annotations"), A.sentences(topics)


def _flow(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = S.search(cued_topics(spark, sf_dir), lambda: X.load_index(spark, sf_dir), S.MAIN)
    return _MEMO[key]


def _with(body: str) -> str:
    return f"WITH RECURSIVE {R.rule_ctes(CUED_SQL)}\n{body}"


def _cued(body: str) -> str:
    return _sql(body, topics=CUED_SQL)


@register("cued_media_type", _with(f"SELECT qid, array_to_string(media_type, '{SEP}') AS media_type FROM media"))
def cued_media_type(spark, sf_dir):
    """N03."""
    return D.media_types(_rules(spark, sf_dir)[1]).select("qid", F.array_join("media_type", SEP).alias("media_type"))


@register("cued_events", _with("SELECT qid, tok_i, subject, verb, object, array_to_string(prep_phrases, ' | ') AS prep_phrases, negated, raw_subject FROM events"))
def cued_events(spark, sf_dir):
    """N07, N07b, N08, N09, N10 with resolved pronouns and negation."""
    _, ann, sents = _rules(spark, sf_dir)
    return D.events(ann, sents).select("qid", "tok_i", "subject", "verb", "object", F.array_join("prep_phrases", SEP).alias("prep_phrases"),
                                       "negated", "raw_subject")


@register("cued_relclause", _with("SELECT qid, tok_i, clause FROM rel"))
def cued_relclause(spark, sf_dir):
    """N11."""
    _, ann, sents = _rules(spark, sf_dir)
    return D.relative_clauses(ann, sents).select("qid", "tok_i", "clause")


@register("cued_decomposition", _with(f"SELECT qid, array_to_string(media_type, '{SEP}') AS media_type, array_to_string(entities, '{SEP}') AS entities, "
                                      f"array_to_string(time, '{SEP}') AS time, array_to_string(descriptions, '{SEP}') AS descriptions FROM decomp"))
def cued_decomposition(spark, sf_dir):
    """N16 with entities, times and media."""
    d = D.decompose(*_rules(spark, sf_dir))
    return d.select("qid", *[F.array_join(c, SEP).alias(c) for c in ("media_type", "entities", "time", "descriptions")])


@register("cued_weighted_query_text", _cued("SELECT qid, text FROM lists WHERE sub_ord = 0"))
def cued_weighted_query_text(spark, sf_dir):
    """I07."""
    return _flow(spark, sf_dir)["lists"].filter("sub_ord = 0").select("qid", "text")


@register("cued_boosted_bag", _cued("SELECT qid, docid, score, rank FROM hits WHERE sub_ord = 0"))
def cued_boosted_bag(spark, sf_dir):
    """I08, bag reading, with boosted extras."""
    return _flow(spark, sf_dir)["hits"].filter("sub_ord = 0").select("qid", "docid", "score", "rank")


@register("cued_boosted_phrase", _cued(PHRASE_BODY))
def cued_boosted_phrase(spark, sf_dir):
    """I08, phrase reading, and I13: names that occur as phrases in documents."""
    return phrase.boosted_phrase_hits(_flow(spark, sf_dir)["decomposition"], X.load_index(spark, sf_dir))


@register("cued_search", _cued("SELECT qid, docid, score, rank FROM fused"))
def cued_search(spark, sf_dir):
    """R05 over questions with every kind of list."""
    return _flow(spark, sf_dir)["fused"]
