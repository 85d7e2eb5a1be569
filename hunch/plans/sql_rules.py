"""DuckDB restatement of the rule annotator and the decomposition rules (oracle side).

``rule_ctes(topics_sql)`` returns the body of a ``WITH RECURSIVE`` list defining
``topics, sents, ann, spans, routed, ...`` for the question set selected by
``topics_sql`` (columns ``qid, query``).
"""

from __future__ import annotations

from .. import constants as C
from ..operators import lexicon as L
from .sqlparts import lst, q


def _in(x: str, words) -> str:
    return f"list_contains({lst(words)}, {x})"


def _case_closed(low: str) -> str:
    return "\n".join(f"          WHEN {_in(low, words)} THEN '{tag}'" for tag, words in L.CLOSED)


WS = "(PARTITION BY qid, sent_i ORDER BY tok_i)"
WB = "(PARTITION BY qid, sent_i ORDER BY tok_i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
WU = "(PARTITION BY qid, sent_i ORDER BY tok_i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WA = "(PARTITION BY qid, sent_i ORDER BY tok_i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"


def _full(part: str) -> str:
    return (f"(PARTITION BY qid, sent_i, {part} ORDER BY tok_i "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(C.BLANK_RE)}), lambda w: w <> '')"


def wc(x: str) -> str:
    return f"len({words(x)})"


def ordered_text(tok: str = "tok_i", text: str = "text") -> str:
    return f"array_to_string(list({text} ORDER BY {tok}), ' ')"


def py_title(x: str) -> str:
    """T13 in DuckDB."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')")


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def trim_suffix(x: str) -> str:
    suf = "|".join(s.strip() for s in C.ENTITY_MEDIA_SUFFIXES)
    w = words(x)
    return (f"CASE WHEN regexp_matches(lower({x}), ' ({suf})$') "
            f"THEN array_to_string({w}[1:len({w}) - 1], ' ') ELSE {x} END")


def not_sub(e: str, others: str) -> str:
    return (f"NOT list_bool_or(list_transform({others}, "
            f"lambda o: contains(lower(o), lower({e})) AND lower(o) <> lower({e})))")


def clean_v1(ents: str, mode: str = "compat") -> str:
    stripped = f"list_transform({ents}, lambda e: {strip_ws('e')})"
    others = stripped if mode == "compat" else f"list_transform({stripped}, lambda e: {trim_suffix('e')})"
    multi = f"list_filter({stripped}, lambda e: {wc('e')} <> 1)"
    kept = f"list_filter(list_transform({multi}, lambda e: {trim_suffix('e')}), lambda e: coalesce({not_sub('e', others)}, true))"
    return f"list_distinct(list_transform({kept}, lambda e: {py_title('e')}))"


def clean_v2(ents: str, propn: str, mode: str = "fixed") -> str:
    stripped = f"list_filter(list_transform({ents}, lambda e: {strip_ws('e')}), lambda e: e <> '')"
    others = stripped if mode == "compat" else f"list_transform({stripped}, lambda e: {trim_suffix('e')})"
    trimmed = f"list_transform({stripped}, lambda e: {trim_suffix('e')})"
    keep = (f"CASE WHEN {wc('e')} = 1 THEN list_contains({propn}, e) "
            f"ELSE coalesce({not_sub('e', others)}, true) END")
    kept = f"list_filter({trimmed}, lambda e: {keep})"
    return f"list_distinct(list_transform({kept}, lambda e: {py_title('e')}))"


def sorted_set(x: str) -> str:
    return f"list_sort(list_distinct({x}))"


def entity_ctes(trim_mode_v2: str = "fixed", trim_mode_v1: str = "compat") -> str:
    """N14 / N15 as steps: the stripped list and its trimmed form are columns computed
    once per question, then every entity is tested against them."""
    title = f"lambda e: {py_title('e')}"
    others2 = "ents" if trim_mode_v2 == "compat" else "trimmed"
    others1 = "ents" if trim_mode_v1 == "compat" else "trimmed"
    keep2 = (f"CASE WHEN {wc('e')} = 1 THEN list_contains(propn, e) "
             f"ELSE coalesce({not_sub('e', others2)}, true) END")
    return f"""
ents2a AS (SELECT t.qid, list_filter(list_transform(coalesce(fb.entities, []::VARCHAR[]), lambda e: {strip_ws('e')}), lambda e: e <> '') AS ents,
                  coalesce(pp.propn, []::VARCHAR[]) AS propn
           FROM topics t JOIN fallback fb USING (qid) LEFT JOIN propn pp USING (qid)),
ents2b AS (SELECT *, list_transform(ents, lambda e: {trim_suffix('e')}) AS trimmed FROM ents2a),
ents2 AS (SELECT qid, {sorted_set(f"list_transform(list_filter(trimmed, lambda e: {keep2}), {title})")} AS entities FROM ents2b),
ents1a AS (SELECT t.qid, list_transform(coalesce(r.entities, []::VARCHAR[]), lambda e: {strip_ws('e')}) AS ents
           FROM topics t LEFT JOIN routed r USING (qid)),
ents1b AS (SELECT *, list_transform(ents, lambda e: {trim_suffix('e')}) AS trimmed FROM ents1a),
ents1 AS (SELECT qid, {sorted_set(f"list_transform(list_filter(list_transform(list_filter(ents, lambda e: {wc('e')} <> 1), lambda e: {trim_suffix('e')}), lambda e: coalesce({not_sub('e', others1)}, true)), {title})")} AS entities
          FROM ents1b)"""


def rule_ctes(topics_sql: str, trim_mode: str = "fixed") -> str:
    low = "lower(text)"
    tkind = (f"CASE WHEN {_in(low, L.DATE_WORDS)} OR regexp_matches({low}, {q(L.YEAR_RE)}) "
             f"OR regexp_matches({low}, {q(L.DECADE_RE)}) "
             f"OR (({_in(low, L.MONTHS)} OR {_in(low, L.WEEKDAYS)}) AND regexp_matches(text, '^\\p{{Lu}}')) THEN 'DATE' "
             f"WHEN {_in(low, L.TIME_WORDS)} THEN 'TIME' END")
    pos1 = f"""CASE WHEN NOT regexp_matches(text, '^[\\p{{L}}\\p{{N}}_]') THEN 'PUNCT'
          WHEN regexp_matches(text, '^\\p{{N}}+$') THEN 'NUM'
          WHEN tkind IS NOT NULL THEN 'NOUN'
{_case_closed(low)}
          WHEN regexp_matches(text, '^\\p{{Lu}}') AND (sent_pos > 0 OR coalesce(ncap, false)) THEN 'PROPN'
          WHEN regexp_matches({low}, '.{{3,}}ly$') THEN 'ADV'
          WHEN regexp_matches({low}, '.{{3,}}(ing|ed)$') THEN 'VERB'
          WHEN regexp_matches({low}, '.{{2,}}{L.ADJ_SUFFIX_RE}') THEN 'ADJ'
          ELSE 'NOUN' END"""
    lemma = f"""CASE WHEN pos <> 'VERB' THEN {low}
          WHEN regexp_matches({low}, 'ies$') THEN regexp_replace({low}, 'ies$', 'y')
          WHEN regexp_matches({low}, '(ss|sh|ch|x|z|o)es$') THEN regexp_replace({low}, 'es$', '')
          WHEN regexp_matches({low}, '[^s]s$') THEN regexp_replace({low}, 's$', '')
          WHEN regexp_matches({low}, 'ied$') THEN regexp_replace({low}, 'ied$', 'y')
          WHEN regexp_matches({low}, '.{{3,}}ed$') THEN regexp_replace({low}, 'ed$', '')
          WHEN regexp_matches({low}, '.{{3,}}ing$') THEN regexp_replace({low}, 'ing$', '')
          ELSE {low} END"""
    barrier = "('ADP', 'VERB', 'AUX', 'SCONJ', 'CCONJ', 'PUNCT', 'PART')"
    neg = _in(low, L.NEGATIONS)
    subj_deps = "(" + ", ".join(q(d) for d in C.SUBJECT_DEPS) + ")"
    obj_deps = "(" + ", ".join(q(d) for d in C.OBJECT_DEPS) + ")"
    lo2, hi2 = C.DESC_WORDS_V2
    lo1, hi1 = C.DESC_WORDS_V1
    c1lo, c1hi = C.CHUNK_WORDS_V1
    c2lo, c2hi = C.CHUNK_WORDS_V2
    return f"""
topics AS ({topics_sql}),
s0 AS (SELECT qid, regexp_extract_all(query, {q(L.SENTENCE_RE)}) AS l FROM topics),
s1 AS (SELECT qid, l, unnest(range(len(l))) AS i FROM s0),
sents AS (SELECT qid, i::INTEGER AS sent_i, trim(l[i + 1]) AS sent FROM s1),
t0 AS (SELECT qid, sent_i, regexp_extract_all(sent, {q(L.TOKEN_RE)}) AS l FROM sents),
t1 AS (SELECT qid, sent_i, l, unnest(range(len(l))) AS sent_pos FROM t0),
toks AS (SELECT qid, sent_i, sent_pos::INTEGER AS sent_pos, l[sent_pos + 1] AS text,
                (row_number() OVER (PARTITION BY qid ORDER BY sent_i, sent_pos) - 1)::INTEGER AS tok_i FROM t1),
g0 AS (SELECT *, {tkind} AS tkind, lead(regexp_matches(text, '^\\p{{Lu}}')) OVER {WS} AS ncap FROM toks),
g1 AS (SELECT *, {pos1} AS pos1 FROM g0),
g2 AS (SELECT *, lag(pos1) OVER {WS} AS p1, lead(pos1) OVER {WS} AS n1 FROM g1),
g3 AS (SELECT qid, sent_i, sent_pos, tok_i, text, tkind,
              CASE WHEN pos1 = 'NOUN' AND tkind IS NULL AND (p1 IN ('PRON', 'AUX', 'PART')
                   OR (p1 IN ('NOUN', 'PROPN') AND regexp_matches({low}, 's$') AND n1 IN ('DET', 'ADP', 'PRON', 'NUM', 'PROPN')))
                   THEN 'VERB' ELSE pos1 END AS pos FROM g2),
g4 AS (SELECT *, {lemma} AS lemma FROM g3),
e0 AS (SELECT *, pos = 'PROPN' AS _p, tkind IS NOT NULL AS _t FROM g4),
e1 AS (SELECT *, _p AND NOT coalesce(lag(_p) OVER {WS}, false) AS _pb,
                 _t AND NOT coalesce(lag(_t) OVER {WS}, false) AS _tb FROM e0),
e2 AS (SELECT *, CASE WHEN _p THEN last_value(CASE WHEN _pb THEN tok_i END IGNORE NULLS) OVER {WU} END AS _prun,
                 CASE WHEN _t THEN last_value(CASE WHEN _tb THEN tok_i END IGNORE NULLS) OVER {WU} END AS _trun FROM e1),
e3 AS (SELECT *, lower(array_to_string(list(text) OVER {_full('_prun')}, ' ')) AS ptext,
                 count(*) OVER {_full('_prun')} AS plen,
                 lower(last_value(text) OVER {_full('_prun')}) AS plast,
                 first_value(tkind) OVER {_full('_trun')} AS tfirst FROM e2),
e4 AS (SELECT *, CASE WHEN _t THEN tfirst
                      WHEN _p THEN CASE WHEN {_in('plast', L.ORG_WORDS)} THEN 'ORG'
                                        WHEN {_in('ptext', L.GPE_NAMES)} THEN 'GPE'
                                        WHEN plen >= 2 THEN 'PERSON' END END AS ent_label FROM e3),
e5 AS (SELECT *, CASE WHEN _t THEN _trun WHEN _p AND ent_label IS NOT NULL THEN _prun END AS ent_id FROM e4),
c0 AS (SELECT *, pos IN ('DET', 'ADJ', 'NOUN', 'PROPN', 'NUM') AS _c FROM e5),
c1 AS (SELECT *, _c AND (NOT coalesce(lag(_c) OVER {WS}, false) OR pos = 'DET') AS _cb FROM c0),
c2 AS (SELECT *, CASE WHEN _c THEN last_value(CASE WHEN _cb THEN tok_i END IGNORE NULLS) OVER {WU} END AS _isl FROM c1),
c3 AS (SELECT *, max(CASE WHEN pos IN ('NOUN', 'PROPN') THEN tok_i END) OVER {_full('_isl')} AS _root FROM c2),
c4 AS (SELECT *, _c AND _root IS NOT NULL AND tok_i <= _root AS _member FROM c3),
c5 AS (SELECT *, CASE WHEN _member THEN _isl END AS chunk_id, CASE WHEN _member THEN _root END AS chunk_root_i,
                 coalesce(_member AND tok_i = _root, false) AS is_chunk_root FROM c4),
d0 AS (SELECT *, lag(pos) OVER {WS} AS _prevpos, is_chunk_root OR pos = 'PRON' AS _cand,
                 CASE WHEN is_chunk_root THEN chunk_id WHEN pos = 'PRON' THEN tok_i END AS _nstart FROM c5),
d1 AS (SELECT *, CASE WHEN pos = 'PRON' THEN _prevpos
                      WHEN is_chunk_root THEN first_value(_prevpos) OVER (PARTITION BY qid, sent_i, chunk_id ORDER BY tok_i) END AS _pre FROM d0),
d2 AS (SELECT *, _cand AND coalesce(_pre = 'ADP', false) AS _pobj,
                 last_value(CASE WHEN pos = 'VERB' THEN tok_i END IGNORE NULLS) OVER {WB} AS _lverb,
                 first_value(CASE WHEN pos = 'VERB' THEN tok_i END IGNORE NULLS) OVER {WA} AS _nverb,
                 last_value(CASE WHEN pos IN {barrier} THEN tok_i END IGNORE NULLS) OVER {WB} AS _lbar,
                 last_value(CASE WHEN _cand THEN tok_i END IGNORE NULLS) OVER {WB} AS _lcand FROM d1),
d3 AS (SELECT *, coalesce(_cand AND NOT _pobj AND _lverb IS NOT NULL AND _lbar = _lverb
                          AND (_lcand IS NULL OR _lcand < _lverb), false) AS _obj FROM d2),
d4 AS (SELECT *, _cand AND NOT _pobj AND NOT _obj AS _scand FROM d3),
d5 AS (SELECT *, first_value(CASE WHEN _scand THEN tok_i END IGNORE NULLS) OVER {WA} AS _nscand FROM d4),
d6 AS (SELECT *, coalesce(_scand AND _nverb IS NOT NULL AND (_nscand IS NULL OR _nscand > _nverb), false) AS _subj FROM d5),
ann AS (SELECT qid, sent_i, tok_i, text, lemma, pos,
          CASE WHEN _pobj THEN 'pobj' WHEN _obj THEN 'dobj' WHEN _subj THEN 'nsubj'
               WHEN chunk_id IS NOT NULL AND NOT is_chunk_root THEN
                    CASE WHEN pos = 'DET' THEN 'det' WHEN pos = 'ADJ' THEN 'amod' WHEN pos = 'NUM' THEN 'nummod' ELSE 'compound' END
               WHEN pos = 'ADP' AND (_lverb IS NOT NULL OR _lcand IS NOT NULL) THEN 'prep'
               WHEN {neg} AND _nverb IS NOT NULL THEN 'neg'
               WHEN pos = 'VERB' AND _lverb IS NULL THEN 'ROOT'
               WHEN pos = 'VERB' THEN 'conj'
               WHEN pos = 'AUX' THEN 'aux' WHEN pos = 'CCONJ' THEN 'cc' WHEN pos = 'SCONJ' THEN 'mark'
               WHEN pos = 'PUNCT' THEN 'punct' WHEN pos = 'ADV' THEN 'advmod' ELSE 'dep' END AS dep,
          (CASE WHEN _pobj THEN _nstart - 1 WHEN _obj THEN _lverb WHEN _subj THEN _nverb
               WHEN chunk_id IS NOT NULL AND NOT is_chunk_root THEN chunk_root_i
               WHEN pos = 'ADP' THEN coalesce(_lverb, _lcand, tok_i)
               WHEN {neg} AND _nverb IS NOT NULL THEN _nverb
               WHEN pos = 'VERB' THEN coalesce(_lverb, tok_i)
               ELSE coalesce(_nverb, _lverb, tok_i) END)::INTEGER AS head_i,
          ent_label AS ent_type, ent_id, ent_label, chunk_id, is_chunk_root
        FROM d6),
spans AS (SELECT qid, ent_id, ent_label, {ordered_text()} AS ent_text FROM ann WHERE ent_id IS NOT NULL GROUP BY qid, ent_id, ent_label),
routed AS (SELECT qid,
             coalesce(list(ent_text ORDER BY ent_id) FILTER (WHERE ent_label IN ('DATE', 'TIME')), []::VARCHAR[]) AS time,
             coalesce(list(ent_text ORDER BY ent_id) FILTER (WHERE ent_label IN ('PERSON', 'ORG', 'GPE', 'WORK_OF_ART')), []::VARCHAR[]) AS entities
           FROM spans GROUP BY qid),
fallback AS (SELECT t.qid, CASE WHEN len(coalesce(r.entities, []::VARCHAR[])) = 0
                  THEN regexp_extract_all(t.query, {q(C.CAPITALISED_NAME_RE)}) ELSE r.entities END AS entities,
                  coalesce(r.time, []::VARCHAR[]) AS time
             FROM topics t LEFT JOIN routed r USING (qid)),
media AS (SELECT qid, {sorted_set('list(lower(text))')} AS media_type FROM ann WHERE {_in('lower(text)', C.MEDIA_TYPES)} GROUP BY qid),
chunks AS (SELECT qid, chunk_id, {ordered_text()} AS chunk_text, max(CASE WHEN is_chunk_root THEN text END) AS root_text
           FROM ann WHERE chunk_id IS NOT NULL GROUP BY qid, chunk_id),
cdesc1 AS (SELECT qid, chunk_id, chunk_text AS description FROM chunks
           WHERE {wc('chunk_text')} BETWEEN {c1lo} AND {c1hi} AND NOT {_in('lower(root_text)', C.CHUNK_STOP_ROOTS_V1)}),
cdesc2 AS (SELECT qid, chunk_id, regexp_replace(lower(chunk_text), {q(C.ARTICLE_PREFIX_RE)}, '') AS description FROM chunks
           WHERE {wc('chunk_text')} BETWEEN {c2lo} AND {c2hi} AND NOT {_in('lower(root_text)', C.CHUNK_STOP_ROOTS_V2)}),
kids AS (SELECT qid, head_i,
           arg_max(text, tok_i) FILTER (WHERE dep IN {subj_deps}) AS subj,
           arg_max(text, tok_i) FILTER (WHERE dep IN {obj_deps}) AS obj_last,
           arg_min(text, tok_i) FILTER (WHERE dep IN {obj_deps}) AS obj_first,
           bool_or(dep = 'neg') AS negated
         FROM ann WHERE tok_i <> head_i GROUP BY qid, head_i),
svo AS (SELECT s.qid, s.tok_i, concat_ws(' ', s.text, v.text, k.obj_first) AS phrase
        FROM ann s JOIN ann v ON v.qid = s.qid AND v.tok_i = s.head_i AND v.pos = 'VERB'
        JOIN kids k ON k.qid = s.qid AND k.head_i = s.head_i
        WHERE s.dep = 'nsubj' AND k.obj_first IS NOT NULL),
sub(qid, prep_i, tok_i) AS (
    SELECT qid, tok_i, tok_i FROM ann WHERE dep = 'prep'
    UNION
    SELECT a.qid, s.prep_i, a.tok_i FROM sub s JOIN ann a ON a.qid = s.qid AND a.head_i = s.tok_i AND a.tok_i <> a.head_i),
subtree AS (SELECT s.qid, s.prep_i, any_value(p.head_i) AS head_i, array_to_string(list(a.text ORDER BY a.tok_i), ' ') AS phrase
            FROM sub s JOIN ann a ON a.qid = s.qid AND a.tok_i = s.tok_i
            JOIN ann p ON p.qid = s.qid AND p.tok_i = s.prep_i GROUP BY s.qid, s.prep_i),
preps AS (SELECT qid, head_i AS tok_i, list(phrase ORDER BY prep_i) AS preps FROM subtree GROUP BY qid, head_i),
back AS (SELECT qid, tok_i, last_value(CASE WHEN ent_type IN ('PERSON', 'ORG', 'GPE')
                   OR (pos = 'NOUN' AND {_in('lower(text)', C.ANTECEDENT_NOUNS)}) THEN text END IGNORE NULLS) OVER {WB} AS back_ref FROM ann),
firstp AS (SELECT qid, arg_min(ent_text, ent_id) AS first_person FROM spans WHERE ent_label = 'PERSON' GROUP BY qid),
ev_all AS (SELECT v.qid, v.tok_i, v.lemma AS verb, k.subj AS raw_subject, k.obj_last AS object,
                  coalesce(p.preps, []::VARCHAR[]) AS prep_phrases, coalesce(k.negated, false) AS negated, s.sent AS clause,
                  CASE WHEN {_in('lower(k.subj)', C.RESOLVE_PRONOUNS)} THEN coalesce(b.back_ref, f.first_person, k.subj) ELSE k.subj END AS subject,
                  b.back_ref, f.first_person
           FROM ann v LEFT JOIN kids k ON k.qid = v.qid AND k.head_i = v.tok_i
           LEFT JOIN preps p ON p.qid = v.qid AND p.tok_i = v.tok_i
           LEFT JOIN back b ON b.qid = v.qid AND b.tok_i = v.tok_i
           LEFT JOIN firstp f ON f.qid = v.qid
           LEFT JOIN sents s ON s.qid = v.qid AND s.sent_i = v.sent_i
           WHERE v.pos = 'VERB'),
events AS (SELECT * FROM ev_all WHERE subject IS NOT NULL AND subject <> '' AND (object IS NOT NULL OR len(prep_phrases) > 0)),
evphr AS (SELECT qid, tok_i, lower(concat_ws(' ', subject, verb, object)) AS phrase FROM events
          WHERE trim(lower(concat_ws(' ', subject, verb, object))) <> ''),
tags AS (SELECT qid, array_to_string(list(CASE WHEN lower(text) = 'where' THEN 'W' WHEN lower(text) = 'who' THEN 'H'
                  WHEN pos = 'DET' THEN 'D' WHEN pos = 'NOUN' THEN 'N' WHEN pos = 'VERB' THEN 'V' ELSE 'x' END ORDER BY tok_i), '') AS tags
         FROM ann GROUP BY qid),
rel AS (SELECT a.qid, a.tok_i, s.sent AS clause FROM ann a JOIN tags t USING (qid)
        JOIN sents s ON s.qid = a.qid AND s.sent_i = a.sent_i
        WHERE lower(a.text) IN ('where', 'who') AND regexp_matches(substring(t.tags, a.tok_i + 1), '^(WD?N+V+|HV+)')),
propn AS (SELECT qid, list(DISTINCT text) AS propn FROM ann WHERE pos = 'PROPN' GROUP BY qid),{entity_ctes(trim_mode)},
descs AS (SELECT t.qid,
             list_concat(list_concat(
               coalesce((SELECT list(description ORDER BY chunk_id) FROM cdesc2 c WHERE c.qid = t.qid), []::VARCHAR[]),
               coalesce((SELECT list(clause ORDER BY tok_i) FROM rel r WHERE r.qid = t.qid), []::VARCHAR[])),
               coalesce((SELECT list(phrase ORDER BY tok_i) FROM evphr e WHERE e.qid = t.qid), []::VARCHAR[])) AS d
          FROM topics t),
decomp AS (SELECT t.qid, t.query, coalesce(m.media_type, []::VARCHAR[]) AS media_type,
             e2.entities,
             {sorted_set('fb.time')} AS time,
             {sorted_set(f"list_filter(ds.d, lambda x: {wc('x')} BETWEEN {lo2} AND {hi2})")} AS descriptions
           FROM topics t JOIN fallback fb USING (qid) LEFT JOIN media m USING (qid) JOIN ents2 e2 USING (qid)
           JOIN descs ds USING (qid)),
decomp1 AS (SELECT t.qid, coalesce(m.media_type, []::VARCHAR[]) AS media_type,
             e1.entities,
             {sorted_set('coalesce(r.time, []::VARCHAR[])')} AS time,
             {sorted_set(f"list_filter(list_concat(coalesce((SELECT list(description ORDER BY chunk_id) FROM cdesc1 c WHERE c.qid = t.qid), []::VARCHAR[]), coalesce((SELECT list(phrase ORDER BY tok_i) FROM svo WHERE svo.qid = t.qid), []::VARCHAR[])), lambda x: {wc('x')} BETWEEN {lo1} AND {hi1})")} AS descriptions
           FROM topics t LEFT JOIN routed r USING (qid) LEFT JOIN media m USING (qid) JOIN ents1 e1 USING (qid))"""
