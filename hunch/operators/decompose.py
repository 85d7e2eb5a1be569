"""Query decomposition as relational rules over ``annotations``.

Every rule reads the token table and produces per-question rows; the final
``decomposition`` is one row per question with sorted distinct lists, left-joined
from the topics so that a question with nothing found still has its row. All groups
are per question (bounded by the question's length); joins between per-question
tables are on ``qid``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..session import cut_lineage
from . import joins as J

_EVENT_T = ("struct<subject:string, verb:string, object:string, prep_phrases:array<string>, "
            "negated:boolean, clause:string>")


def _ordered_join(tok_col: str = "tok_i", text_col: str = "text") -> Column:
    """Aggregate: texts joined by blanks in token order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(tok_col), F.col(text_col)))),
                                    lambda s: s[text_col]), " ")


def sorted_set(arr) -> Column:
    """``sorted(set(xs))``."""
    return F.array_sort(F.array_distinct(arr))


_strip = T.strip


def _empty() -> Column:
    return F.array().cast("array<string>")


# --- N01 / N02 / N03 --------------------------------------------------------------------

def entity_spans(ann: DataFrame) -> DataFrame:
    """``(qid, ent_id, ent_label, ent_text)`` — one row per span."""
    return ann.filter(F.col("ent_id").isNotNull()).groupBy("qid", "ent_id", "ent_label") \
        .agg(_ordered_join().alias("ent_text"))


def route_labels(spans: DataFrame) -> DataFrame:
    """``(qid, time, entities)`` raw lists (span order)."""
    def coll(labels):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("ent_label").isin(labels),
                                                                F.struct("ent_id", "ent_text")))),
                           lambda s: s["ent_text"])
    return spans.groupBy("qid").agg(coll(C.TIME_LABELS).alias("time"), coll(C.ENTITY_LABELS).alias("entities"))


def with_fallback_names(topics: DataFrame, routed: DataFrame) -> DataFrame:
    """Capitalised-name runs of the raw query when no entity was found."""
    j = topics.join(routed, "qid", "left")
    ents = F.coalesce(F.col("entities"), _empty())
    return j.select("qid", F.when(F.size(ents) == 0, T.capitalised_names("query")).otherwise(ents).alias("entities"),
                    F.coalesce(F.col("time"), _empty()).alias("time"))


def media_types(ann: DataFrame, media=C.MEDIA_TYPES) -> DataFrame:
    """``(qid, media_type)`` sorted distinct lower-cased gazetteer hits."""
    low = F.lower("text")
    return ann.filter(low.isin(list(media))).groupBy("qid").agg(sorted_set(F.collect_list(low)).alias("media_type"))


# --- N04 / N05: noun-chunk descriptions ---------------------------------------------------

def chunk_texts(ann: DataFrame) -> DataFrame:
    """``(qid, chunk_id, chunk_text, root_text)``."""
    return ann.filter(F.col("chunk_id").isNotNull()).groupBy("qid", "chunk_id").agg(
        _ordered_join().alias("chunk_text"),
        F.max(F.when(F.col("is_chunk_root"), F.col("text"))).alias("root_text"))


def chunk_descriptions(chunks: DataFrame, version: int = 2) -> DataFrame:
    """N04 (v1: 2-5 words, 8 stop roots, original case) / N05 (v2: 2-7 words, 6 stop
    roots, lower-cased with a leading article removed): ``(qid, chunk_id, description)``."""
    lo, hi = C.CHUNK_WORDS_V1 if version == 1 else C.CHUNK_WORDS_V2
    roots = C.CHUNK_STOP_ROOTS_V1 if version == 1 else C.CHUNK_STOP_ROOTS_V2
    n = T.word_count("chunk_text")
    keep = (n >= lo) & (n <= hi) & ~F.lower("root_text").isin(roots)
    d = F.col("chunk_text") if version == 1 else T.strip_article("chunk_text")
    return chunks.filter(keep).select("qid", "chunk_id", d.alias("description"))


# --- N06 / N07 / N07b / N08 / N09 / N10 / N12 -----------------------------------------------

def children_summary(ann: DataFrame) -> DataFrame:
    """Per head token: last subject, last and first object, negation — ``(qid, head_i, ...)``."""
    kids = ann.filter(F.col("tok_i") != F.col("head_i"))
    dep = F.col("dep")
    return kids.groupBy("qid", "head_i").agg(
        F.max_by(F.when(dep.isin(C.SUBJECT_DEPS), F.col("text")), F.when(dep.isin(C.SUBJECT_DEPS), F.col("tok_i"))).alias("subj"),
        F.max_by(F.when(dep.isin(C.OBJECT_DEPS), F.col("text")), F.when(dep.isin(C.OBJECT_DEPS), F.col("tok_i"))).alias("obj_last"),
        F.min_by(F.when(dep.isin(C.OBJECT_DEPS), F.col("text")), F.when(dep.isin(C.OBJECT_DEPS), F.col("tok_i"))).alias("obj_first"),
        F.bool_or(dep == "neg").alias("negated"))


def svo_v1(ann: DataFrame) -> DataFrame:
    """For each ``nsubj`` whose head is a VERB with an object child:
    ``(qid, tok_i, phrase)`` = subject, verb text, first object."""
    subj = ann.filter(F.col("dep") == "nsubj").select("qid", "tok_i", F.col("text").alias("s_text"),
                                                       F.col("head_i").alias("v_i"))
    verbs = ann.filter(F.col("pos") == "VERB").select("qid", F.col("tok_i").alias("v_i"), F.col("text").alias("v_text"))
    objs = children_summary(ann).select("qid", F.col("head_i").alias("v_i"), "obj_first")
    j = subj.join(verbs, ["qid", "v_i"]).join(objs, ["qid", "v_i"]).filter(F.col("obj_first").isNotNull())
    return j.select("qid", "tok_i", F.concat_ws(" ", "s_text", "v_text", "obj_first").alias("phrase"))


def subtree_phrases(ann: DataFrame) -> DataFrame:
    """``(qid, prep_i, head_i, phrase)`` — every token below each ``prep``, in order.

    A question's head pointers form one small array. Pointer doubling over it gathers, for
    every token, the ``prep`` tokens among its ancestors: after round k a token knows those on
    the 2**k steps above it. The rounds follow from the question's length, so any depth is
    covered (a cycle of heads, which no tree has, just ends). One group by question; grouping
    by (question, prep) afterwards needs no further exchange."""
    tok = F.array_sort(F.collect_list(F.struct("tok_i", "head_i", (F.col("dep") == "prep").alias("prep"), "text")))
    q = ann.groupBy("qid").agg(tok.alias("t")).withColumn("ids", F.col("t.tok_i"))

    def place(x):
        """Index (from 1) of the head of ``x`` in the array; 0 for a root or a head outside it."""
        guess = x["head_i"] - F.get("ids", F.lit(0)) + 1  # token numbers are usually consecutive
        near = F.get(F.col("ids"), (guess - 1).cast("int")) == x["head_i"]
        at = F.when(F.coalesce(near, F.lit(False)), guess).otherwise(F.array_position("ids", x["head_i"]))
        return F.when((x["head_i"] == x["tok_i"]) | x["head_i"].isNull(), 0).otherwise(at).cast("int")
    none = F.array().cast("array<int>")
    start = F.struct(
        F.transform("t", place).alias("up"),
        F.transform("t", lambda x, i: F.when(x["prep"], F.array((i + 1).cast("int"))).otherwise(none)).alias("preps"))

    def double(acc, _):
        up, preps = acc["up"], acc["preps"]
        return F.struct(
            F.transform(up, lambda u: F.coalesce(F.get(up, u - 1), F.lit(0)).cast("int")).alias("up"),
            F.transform(preps, lambda own, i: F.array_union(own, F.coalesce(F.get(preps, F.get(up, i) - 1), none))).alias("preps"))
    rounds = F.sequence(F.lit(1), (F.ceil(F.log2(F.size("t"))) + 1).cast("int"))
    found = q.select("qid", "t", F.aggregate(rounds, start, double)["preps"].alias("preps"))
    pairs = found.select("qid", "t", F.posexplode("preps").alias("i", "above")) \
        .select("qid", F.get("t", F.col("i"))["tok_i"].alias("tok_i"), F.get("t", F.col("i"))["text"].alias("text"),
                F.explode("above").alias("p"), "t") \
        .select("qid", "tok_i", "text", F.get("t", F.col("p") - 1)["tok_i"].alias("prep_i"), F.get("t", F.col("p") - 1)["head_i"].alias("head_i"))
    return pairs.groupBy("qid", "prep_i").agg(F.first("head_i").alias("head_i"), _ordered_join().alias("phrase")) \
        .select("qid", "prep_i", "head_i", "phrase")


def antecedents(ann: DataFrame) -> DataFrame:
    """N08 (nearest earlier antecedent in the sentence, per token) and N09 (first PERSON
    span of the question): ``(qid, tok_i, back_ref, first_person)``."""
    w = Window.partitionBy("qid", "sent_i").orderBy("tok_i").rowsBetween(Window.unboundedPreceding, -1)
    cond = F.col("ent_type").isin(C.ANTECEDENT_LABELS) | (
        (F.col("pos") == "NOUN") & F.lower("text").isin(C.ANTECEDENT_NOUNS))
    back = ann.select("qid", "tok_i", F.last(F.when(cond, F.col("text")), True).over(w).alias("back_ref"))
    spans = entity_spans(ann).filter(F.col("ent_label") == "PERSON").groupBy("qid") \
        .agg(F.min_by("ent_text", "ent_id").alias("first_person"))
    return back.join(spans, "qid", "left")


def events(ann: DataFrame, sents: DataFrame) -> DataFrame:
    """N07 + N08 + N09 + N10: ``(qid, tok_i, subject, verb, object, prep_phrases,
    negated, clause, raw_subject)`` for verbs passing the filter."""
    verbs = ann.filter(F.col("pos") == "VERB").select("qid", "sent_i", "tok_i", "lemma")
    kids = children_summary(ann).withColumnRenamed("head_i", "tok_i")
    preps = subtree_phrases(ann).groupBy("qid", F.col("head_i").alias("tok_i")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prep_i", "phrase"))), lambda s: s["phrase"]).alias("preps"))
    ante = antecedents(ann)
    ev = verbs.join(kids, ["qid", "tok_i"], "left").join(preps, ["qid", "tok_i"], "left") \
        .join(ante, ["qid", "tok_i"], "left").join(sents, ["qid", "sent_i"], "left")
    pron = F.lower(F.col("subj")).isin(C.RESOLVE_PRONOUNS)
    subject = F.when(pron, F.coalesce(F.col("back_ref"), F.col("first_person"), F.col("subj"))).otherwise(F.col("subj"))
    preps_c = F.coalesce(F.col("preps"), _empty())
    ev = ev.select("qid", "tok_i", subject.alias("subject"), F.col("lemma").alias("verb"),
                   F.col("obj_last").alias("object"), preps_c.alias("prep_phrases"),
                   F.coalesce(F.col("negated"), F.lit(False)).alias("negated"),
                   F.col("sent").alias("clause"), F.col("subj").alias("raw_subject"))
    keep = F.col("subject").isNotNull() & (F.col("subject") != "") & (
        F.col("object").isNotNull() | (F.size("prep_phrases") > 0))
    return ev.filter(keep)


def event_phrases(ev: DataFrame) -> DataFrame:
    """``(qid, tok_i, phrase)`` lower-cased subject + verb + object."""
    p = F.lower(F.concat_ws(" ", "subject", "verb", "object"))
    return ev.select("qid", "tok_i", p.alias("phrase")).filter(F.trim("phrase") != "")


# --- N11 ------------------------------------------------------------------------------------

def relative_clauses(ann: DataFrame, sents: DataFrame) -> DataFrame:
    """``(qid, tok_i, clause)`` — the sentence of every ``where DET? NOUN+ VERB+`` or
    ``who VERB+`` match. Tokens become one tag character each, in the questions that have a
    ``where`` or ``who``; one pass over a question's tag string marks the tokens that begin a
    match (a match holds no other such token), so the work is linear in its length. Only marked
    tokens meet sentences."""
    low = F.lower("text")
    tagc = (F.when(low == "where", "W").when(low == "who", "H").when(F.col("pos") == "DET", "D")
            .when(F.col("pos") == "NOUN", "N").when(F.col("pos") == "VERB", "V").otherwise("x"))
    starts = cut_lineage(ann.filter(low.isin("where", "who")).select("qid", "sent_i", "tok_i"), "clause-starts")
    asked = starts.select("qid").distinct()
    tags = ann.join(J.small(asked), "qid", "left_semi").groupBy("qid").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tok_i", tagc.alias("c")))), lambda s: s["c"]), "").alias("tags"))
    marks = F.split(F.regexp_replace("tags", "W(?=D?N+V)|H(?=V)", "M"), "")
    begin = tags.select("qid", F.posexplode(marks).alias("tok_i", "mark")).filter("mark = 'M'").select("qid", "tok_i")
    m = cut_lineage(starts.join(begin, ["qid", "tok_i"]), "clauses")
    return sents.join(J.small(m), ["qid", "sent_i"]).select("qid", "tok_i", F.col("sent").alias("clause"))


# --- N13 / N14 / N15 ------------------------------------------------------------------------

def _trim_suffix(e: Column) -> Column:
    suffixes = "|".join(s.strip() for s in C.ENTITY_MEDIA_SUFFIXES)
    w = T.words(e)
    return F.when(F.lower(e).rlike(f" ({suffixes})$"), F.array_join(F.slice(w, 1, F.size(w) - 1), " ")).otherwise(e)


def _not_substring_of_other(e: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: F.lower(o).contains(F.lower(e)) & (F.lower(o) != F.lower(e)))


def clean_entities_v1(entities: Column, trim_mode: str = "fixed") -> Column:
    """Drop single words, trim a media suffix, drop substrings of another entity,
    title-case, distinct. ``compat`` compares a trimmed entity with the untrimmed list
    (so every trimmed one drops, V18); ``fixed`` compares trimmed with trimmed."""
    ents = F.transform(entities, _strip)
    multi = F.filter(ents, lambda e: T.word_count(e) != 1)
    others = ents if trim_mode == "compat" else F.transform(ents, _trim_suffix)
    kept = F.filter(F.transform(multi, _trim_suffix), lambda e: _not_substring_of_other(e, others))
    return F.array_distinct(F.transform(kept, T.python_title))


def clean_entities_v2(entities: Column, propn_tokens: Column, trim_mode: str = "fixed") -> Column:
    """As N14, but a single word (after trimming) is kept when it is the exact text
    of a PROPN token of the question."""
    ents = F.filter(F.transform(entities, _strip), lambda e: e != "")
    others = ents if trim_mode == "compat" else F.transform(ents, _trim_suffix)
    trimmed = F.transform(ents, _trim_suffix)
    kept = F.filter(trimmed, lambda e: F.when(T.word_count(e) == 1, F.array_contains(propn_tokens, e))
                    .otherwise(_not_substring_of_other(e, others)))
    return F.array_distinct(F.transform(kept, T.python_title))


def with_clean_entities_v1(df: DataFrame, col: str, trim_mode: str = "compat", out: str | None = None) -> DataFrame:
    """N14 over a DataFrame: the stripped list and its comparison list become columns
    first, so each entity's substring test reads them instead of recomputing them
    (which would be quadratic in the number of entities of a question)."""
    t = df.withColumn("_ents", F.transform(F.coalesce(F.col(col), _empty()), _strip))
    t = t.withColumn("_others", F.col("_ents") if trim_mode == "compat" else F.transform("_ents", _trim_suffix))
    kept = F.filter(F.transform(F.filter("_ents", lambda e: T.word_count(e) != 1), _trim_suffix),
                    lambda e: _not_substring_of_other(e, F.col("_others")))
    return t.withColumn(out or col, sorted_set(F.transform(kept, T.python_title))).drop("_ents", "_others")


def with_clean_entities_v2(df: DataFrame, col: str, propn_col: str, trim_mode: str = "fixed",
                           out: str | None = None) -> DataFrame:
    """N15 over a DataFrame (see ``with_clean_entities_v1``)."""
    t = df.withColumn("_ents", F.filter(F.transform(F.coalesce(F.col(col), _empty()), _strip), lambda e: e != ""))
    t = t.withColumn("_trim", F.transform("_ents", _trim_suffix))
    others = F.col("_ents") if trim_mode == "compat" else F.col("_trim")
    propn = F.coalesce(F.col(propn_col), _empty())
    kept = F.filter("_trim", lambda e: F.when(T.word_count(e) == 1, F.array_contains(propn, e))
                    .otherwise(_not_substring_of_other(e, others)))
    return t.withColumn(out or col, sorted_set(F.transform(kept, T.python_title))).drop("_ents", "_trim")


def clean_descriptions(arr: Column, lo: int, hi: int) -> Column:
    """Distinct, ``lo..hi`` words, sorted."""
    return sorted_set(F.filter(arr, lambda d: (T.word_count(d) >= lo) & (T.word_count(d) <= hi)))


# --- N16 ------------------------------------------------------------------------------------

def _per_qid_list(df: DataFrame, col: str, name: str, order: str = "tok_i") -> DataFrame:
    return df.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, col))),
                                             lambda s: s[col]).alias(name))


def decompose(topics: DataFrame, ann: DataFrame, sents: DataFrame, trim_mode: str = "fixed") -> DataFrame:
    """N16 (v2): ``(qid, query, media_type, entities, time, descriptions, events)``."""
    spans = entity_spans(ann)
    routed = with_fallback_names(topics, route_labels(spans))
    propn = ann.filter(F.col("pos") == "PROPN").groupBy("qid").agg(F.collect_set("text").alias("propn"))
    chunks = _per_qid_list(chunk_descriptions(chunk_texts(ann), 2), "description", "chunk_desc", "chunk_id")
    rel = _per_qid_list(relative_clauses(ann, sents), "clause", "rel_desc")
    ev = events(ann, sents)
    evp = _per_qid_list(event_phrases(ev), "phrase", "event_desc")
    evl = ev.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "tok_i", F.struct("subject", "verb", "object", "prep_phrases", "negated", "clause").alias("e")))),
        lambda s: s["e"]).alias("events"))
    media = media_types(ann)
    j = topics.join(routed, "qid", "left").join(propn, "qid", "left").join(chunks, "qid", "left") \
        .join(rel, "qid", "left").join(evp, "qid", "left").join(evl, "qid", "left").join(media, "qid", "left")
    e = _empty()
    j = with_clean_entities_v2(j, "entities", "propn", trim_mode)
    desc = F.concat(F.coalesce("chunk_desc", e), F.coalesce("rel_desc", e), F.coalesce("event_desc", e))
    lo, hi = C.DESC_WORDS_V2
    return j.select(
        "qid", "query",
        F.coalesce("media_type", e).alias("media_type"),
        "entities",
        sorted_set(F.coalesce("time", e)).alias("time"),
        clean_descriptions(desc, lo, hi).alias("descriptions"),
        F.coalesce("events", F.array().cast(f"array<{_EVENT_T}>")).alias("events"))


def decompose_v1(topics: DataFrame, ann: DataFrame, trim_mode: str = "compat") -> DataFrame:
    """N16 (v1): ``(qid, query, media_type, entities, time, descriptions)``; no name
    fallback, descriptions are original-case chunks plus subject-verb-object phrases."""
    routed = route_labels(entity_spans(ann))
    chunks = _per_qid_list(chunk_descriptions(chunk_texts(ann), 1), "description", "chunk_desc", "chunk_id")
    svo = _per_qid_list(svo_v1(ann), "phrase", "svo_desc")
    media = media_types(ann)
    j = topics.join(routed, "qid", "left").join(chunks, "qid", "left").join(svo, "qid", "left") \
        .join(media, "qid", "left")
    e = _empty()
    j = with_clean_entities_v1(j, "entities", trim_mode)
    lo, hi = C.DESC_WORDS_V1
    return j.select(
        "qid", "query", F.coalesce("media_type", e).alias("media_type"),
        "entities",
        sorted_set(F.coalesce("time", e)).alias("time"),
        clean_descriptions(F.concat(F.coalesce("chunk_desc", e), F.coalesce("svo_desc", e)), lo, hi).alias("descriptions"))


# --- P08 - P10: filters of the model-reply flow ---------------------------------------------

def filter_entities(entities: Column) -> Column:
    """Drop empty and generic entities (case-insensitive)."""
    return F.filter(entities, lambda e: (e != "") & ~F.lower(e).isin(C.GENERIC_ENTITIES))


def normalize_attributes(attrs: Column) -> Column:
    """Lower; contains ``r rated`` -> ``R-rated``; contains the listed phrase -> dropped."""
    mapped = F.transform(attrs, lambda a: F.when(F.lower(a).contains(C.ATTRIBUTE_RATED_MARK), F.lit(C.ATTRIBUTE_RATED_VALUE))
                         .when(F.lower(a).contains(C.ATTRIBUTE_DROP_MARK), F.lit(None).cast("string"))
                         .otherwise(F.lower(a)))
    return F.filter(mapped, lambda a: a.isNotNull())


def filter_descriptions(descs: Column) -> Column:
    """P10: non-empty, more than one word, not containing the listed word."""
    return F.filter(descs, lambda d: (d != "") & (T.word_count(d) > 1) & ~F.lower(d).contains(C.DESCRIPTION_DROP_MARK))


# --- N17 --------------------------------------------------------------------------------------

def subqueries(decomp: DataFrame, norm_col: str = "norm_query", with_attributes: bool = False) -> DataFrame:
    """N17 (V14): ``(qid, sub_ord, kind, text)`` — norm query (1), entities, time,
    descriptions, media types[, attributes]; the same text twice keeps its first place."""
    e = _empty()
    parts = [F.array(F.struct(F.lit("norm").alias("kind"), F.col(norm_col).alias("text")))]
    cols = ["entities", "time", "descriptions", "media_type"] + (["attributes"] if with_attributes else [])
    def tagged(kind):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("text"))

    for c in cols:
        parts.append(F.transform(F.coalesce(F.col(c), e), tagged(c)))
    allq = decomp.select("qid", F.posexplode(F.concat(*parts)).alias("p", "s"))
    allq = allq.select("qid", (F.col("p") + 1).cast("int").alias("sub_ord"), F.col("s.kind").alias("kind"),
                       F.col("s.text").alias("text"))
    first = allq.groupBy("qid", "text").agg(F.min(F.struct("sub_ord", "kind")).alias("f"))
    return first.select("qid", F.col("f.sub_ord").alias("sub_ord"), F.col("f.kind").alias("kind"), "text")
