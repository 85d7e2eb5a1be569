"""Pieces of DuckDB SQL used by the oracle texts.

The oracle is an independent restatement of each operator in plain SQL, run by the
checker on the same Parquet tables; these helpers only spell shared literals once.
"""

from __future__ import annotations

from .. import constants as C


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    """DuckDB list literal of strings."""
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


QSTOP = lst(C.QUERY_STOP_WORDS)
ISTOP = lst(C.INDEX_STOP_WORDS)
TERM = q(C.TERM_RE)
PUNCT = q(C.PUNCT_RE)
BLANK = q(C.BLANK_RE)


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {BLANK}), lambda w: w <> '')"


def norm(x: str, stop: str = QSTOP) -> str:
    """T01 in DuckDB."""
    cleaned = f"regexp_replace(lower({x}), {PUNCT}, '', 'g')"
    return f"array_to_string(list_filter({words(cleaned)}, lambda w: NOT list_contains({stop}, w)), ' ')"


def terms(x: str) -> str:
    """T09."""
    return f"regexp_extract_all(lower({x}), {TERM})"


def index_terms(x: str, stop: str = ISTOP) -> str:
    """T09 + T10."""
    return f"list_filter({terms(x)}, lambda w: NOT list_contains({stop}, w))"


def index_ctes(k1: float = C.BM25_K1, b: float = C.BM25_B) -> str:
    """CTEs ``docs, post, dstats, cstats, vocab`` over ``documents``."""
    return f"""
docs AS (SELECT CAST(doc_id AS VARCHAR) AS docid, text AS contents, {index_terms('text')} AS toks FROM documents),
post AS (SELECT term, docid, count(*)::BIGINT AS tf, any_value(dl)::BIGINT AS dl
         FROM (SELECT docid, len(toks) AS dl, unnest(toks) AS term FROM docs) GROUP BY term, docid),
dstats AS (SELECT docid, len(toks)::BIGINT AS dl FROM docs),
cstats AS (SELECT count(*)::DOUBLE AS n_docs, avg(dl)::DOUBLE AS avg_dl FROM dstats),
vocab AS (SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term)"""


def bm25_ctes(subq_cte: str, k: int, k1: float = C.BM25_K1, b: float = C.BM25_B,
              depth_expr: str | None = None, weight_expr: str = "1.0") -> str:
    """CTEs ``qt, sc, hits`` scoring the subquery CTE ``subq_cte(qid, sub_ord, text[, w])``.
    Needs ``index_ctes`` earlier in the same WITH."""
    lim = f"rank <= {k}" + (f" AND rank <= {depth_expr}" if depth_expr else "")
    return f"""
qt AS (SELECT qid, sub_ord, term, sum(w)::DOUBLE AS qtf
       FROM (SELECT qid, sub_ord, ({weight_expr})::DOUBLE AS w, unnest({index_terms('text')}) AS term FROM {subq_cte})
       GROUP BY qid, sub_ord, term),
qti AS (SELECT qt.qid, qt.sub_ord, qt.term, qt.qtf,
               ln(1.0::DOUBLE + (cstats.n_docs - vocab.df + 0.5::DOUBLE) / (vocab.df + 0.5::DOUBLE)) AS idf
        FROM qt JOIN vocab USING (term) CROSS JOIN cstats),
sc AS (SELECT qti.qid, qti.sub_ord, post.docid,
              round(sum(qti.qtf * qti.idf * (post.tf / (post.tf + {k1}::DOUBLE * ({1.0 - b}::DOUBLE + {b}::DOUBLE * post.dl / cstats.avg_dl)))), 6) AS score
       FROM qti JOIN post USING (term) CROSS JOIN cstats GROUP BY qti.qid, qti.sub_ord, post.docid),
ranked AS (SELECT qid, sub_ord, docid, score,
                  row_number() OVER (PARTITION BY qid, sub_ord ORDER BY score DESC, docid ASC)::BIGINT AS rank FROM sc),
hits AS (SELECT * FROM ranked WHERE {lim})"""


def esc(x: str) -> str:
    """T05 in DuckDB: backslash before ASCII punctuation."""
    return f"regexp_replace({x}, '([!-/:-@\\[-`{{-~])', '\\\\\\1', 'g')"


def snippet_terms(raw: str) -> str:
    """T04 in DuckDB."""
    return (f"list_filter({words(raw)}, lambda t: length(t) >= {C.SNIPPET_MIN_TERM_LEN} "
            f"AND NOT list_contains({QSTOP}, lower(t)))")


# Python's \b is Unicode-aware, RE2's is ASCII-only and RE2 has no look-around. The
# oracle therefore spells every character c as  P c N  where P marks the class of the
# character before c and N the class of the one after (word = letter, digit, "_";
# string ends count as non-word). A whole-word test then only needs the markers
# inside the match, so global replacement works as with look-around.
_PW, _PN, _NW, _NN = "chr(57345)", "chr(57344)", "chr(57347)", "chr(57346)"


def _isw(c: str) -> str:
    return f"regexp_matches({c}, '^[\\p{{L}}\\p{{N}}_]$')"


def _chars(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


def _encode_list(ch: str, cls: str) -> str:
    """Encode from a character-list column ``ch`` and its word-class list ``cls``."""
    return (f"array_to_string(list_transform(range(1, len({ch}) + 1), lambda i: "
            f"(CASE WHEN i > 1 AND {cls}[i - 1] THEN {_PW} ELSE {_PN} END) || {ch}[i] || "
            f"(CASE WHEN i < len({ch}) AND {cls}[i + 1] THEN {_NW} ELSE {_NN} END)), '')")


def decode(x: str) -> str:
    return f"regexp_replace({x}, '[' || {_PN} || {_PW} || {_NN} || {_NW} || ']', '', 'g')"


def word_pattern(t: str) -> str:
    """RE2 pattern matching term ``t`` as Python's ``\\bt\\b`` on an encoded string."""
    ch = _chars(t)
    esc_c = "CASE WHEN regexp_matches(c, '^[!-/:-@\\[-`{-~]$') THEN '\\' || c ELSE c END"
    body = (f"list_transform(range(1, len({ch}) + 1), lambda j: "
            f"(CASE WHEN j = 1 THEN (CASE WHEN {_isw(f'{ch}[1]')} THEN {_PN} ELSE {_PW} END) "
            f"ELSE '[' || {_PN} || {_PW} || ']' END) || "
            f"list_transform([{ch}[j]], lambda c: {esc_c})[1] || "
            f"(CASE WHEN j = len({ch}) THEN (CASE WHEN {_isw(f'{ch}[len({ch})]')} THEN {_NN} ELSE {_NW} END) "
            f"ELSE '[' || {_NN} || {_NW} || ']' END))")
    return f"array_to_string({body}, '')"


def snippet_ctes(src: str) -> str:
    """T04-T08 in DuckDB as CTE steps over ``src(..., contents, raw)``; the last CTE,
    ``snip``, adds ``snippet``. Every list is computed once per row."""
    ch_cls = "list_transform(ch, lambda c: regexp_matches(c, '^[\\p{L}\\p{N}_]$'))"
    return f"""
sn0 AS (SELECT *, {snippet_terms('raw')} AS ts, {_chars('contents')} AS ch FROM {src}),
sn1 AS (SELECT *, {ch_cls} AS cls, list_transform(ts, lambda t: {word_pattern('t')}) AS pats FROM sn0),
sn2 AS (SELECT * EXCLUDE (ch, cls), {_encode_list('ch', 'cls')} AS enc FROM sn1),
sn3 AS (SELECT * EXCLUDE (enc), list_filter(list_transform(pats, lambda p: CASE WHEN regexp_matches(enc, '(?i)' || p)
            THEN length(regexp_extract(enc, '(?is)^(.*?)' || p, 1)) // 3 END), lambda x: x IS NOT NULL)[1] AS anchor FROM sn2),
sn4 AS (SELECT *, replace(CASE WHEN anchor IS NULL THEN substring(contents, 1, {C.SNIPPET_FALLBACK})
            ELSE substring(contents, greatest(0, anchor - {C.SNIPPET_BEFORE}) + 1,
                           least(length(contents), anchor + {C.SNIPPET_WINDOW}) - greatest(0, anchor - {C.SNIPPET_BEFORE})) END,
            chr(10), ' ') AS win FROM sn3),
sn5 AS (SELECT *, {_chars('win')} AS wch FROM sn4),
sn6 AS (SELECT * EXCLUDE (wch), {_encode_list('wch', "list_transform(wch, lambda c: regexp_matches(c, '^[\\p{L}\\p{N}_]$'))")} AS wenc FROM sn5),
snip AS (SELECT * EXCLUDE (wenc, pats, ts, anchor, win),
            CASE WHEN len(ts) > 0 THEN {decode("regexp_replace(wenc, '(?i)(' || array_to_string(pats, '|') || ')', '**\\0**', 'g')")}
                 ELSE win END AS snippet FROM sn6)"""


def fusion_ctes(lists_cte: str, c: int, k: int = C.FUSED_DEPTH) -> str:
    """CTEs ``rrfs`` (all fused scores) and ``fused`` (top k) over ``lists_cte(qid, sub_ord, docid, rank)``."""
    return f"""
rrfs AS (SELECT qid, docid, sum(1.0::DOUBLE / ({float(c)}::DOUBLE + rank)) AS score,
                (min(sub_ord * 1000 + rank) // 1000)::INTEGER AS first_sub_ord, min(sub_ord * 1000 + rank) % 1000 AS first_rank
         FROM {lists_cte} GROUP BY qid, docid),
fused_all AS (SELECT qid, docid, round(score, 9) AS score, first_sub_ord, first_rank,
                     row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, first_sub_ord, first_rank)::BIGINT AS rank
              FROM rrfs),
fused AS (SELECT qid, docid, score, rank FROM fused_all WHERE rank <= {k})"""


def search_ctes(topics_sql: str, c: int = C.RRF_C_MAIN, trim_mode: str = "fixed",
                lists_sql: str | None = None) -> str:
    """The whole main flow in DuckDB: rule decomposition, lists, BM25, fusion.
    Defines ``decomp, dn, lists, hits, rrfs, fused`` among others."""
    from .sql_rules import rule_ctes
    wt = (f"array_to_string(list_concat(list_concat([norm_query], "
          f"list_transform(entities, lambda e: '\"' || e || '\"^{C.ENTITY_BOOST}')), "
          f"list_transform(time, lambda t: '\"' || t || '\"^{C.TIME_BOOST}')), ' ')")
    parts = ("list_concat(list_concat(list_concat(list_concat([{'kind': 'norm', 'text': norm_query}], "
             "list_transform(entities, lambda x: {'kind': 'entities', 'text': x})), "
             "list_transform(time, lambda x: {'kind': 'time', 'text': x})), "
             "list_transform(descriptions, lambda x: {'kind': 'descriptions', 'text': x})), "
             "list_transform(media_type, lambda x: {'kind': 'media_type', 'text': x}))")
    lists = lists_sql or f"""
dn AS (SELECT *, {norm('query')} AS norm_query FROM decomp),
sq0 AS (SELECT qid, {parts} AS l FROM dn),
sq1 AS (SELECT qid, l, unnest(range(len(l))) AS i FROM sq0),
sq2 AS (SELECT qid, (i + 1)::INTEGER AS sub_ord, l[i + 1].kind AS kind, l[i + 1].text AS text FROM sq1),
subq AS (SELECT qid, min(sub_ord) AS sub_ord, arg_min(kind, sub_ord) AS kind, text FROM sq2 GROUP BY qid, text),
lists AS (SELECT qid, 0 AS sub_ord, 'weighted' AS kind, {wt} AS text FROM dn
          UNION ALL SELECT qid, sub_ord, kind, text FROM subq)"""
    return f"""{rule_ctes(topics_sql, trim_mode)},
{lists},
{index_ctes()},
{bm25_ctes('lists', C.WEIGHTED_DEPTH, depth_expr=f"CASE WHEN sub_ord = 0 THEN {C.WEIGHTED_DEPTH} ELSE {C.SUBQUERY_DEPTH} END")},
{fusion_ctes('hits', c)}"""
