"""Column expressions for text (T-series). All are built-in Spark functions, so they
stay inside whole-stage code generation; nothing here calls Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_array(values) -> Column:
    """A literal ARRAY<STRING>."""
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


# --- T01 / T02 / T03 -------------------------------------------------------------

def latin1_mode(q) -> Column:
    """Re-read the UTF-8 bytes as ISO-8859-1 (``café`` -> ``cafÃ©``)."""
    return F.decode(F.encode(_col(q), "UTF-8"), "ISO-8859-1")


def words(s) -> Column:
    """Whitespace split with empty pieces removed (Python's ``str.split()``)."""
    return F.filter(F.split(_col(s), C.BLANK_RE), lambda t: t != "")


def drop_stop_words(arr, stop=C.QUERY_STOP_WORDS) -> Column:
    """Keep order and duplicates; only stop words go."""
    stop = list(stop)
    return F.filter(_col(arr), lambda t: ~t.isin(stop)) if stop else _col(arr)


def normalize_query(q, stop=C.QUERY_STOP_WORDS, escape_mode: str = "none") -> Column:
    """Lower -> delete punctuation -> split -> drop stop words -> join with blanks."""
    q = _col(q)
    if escape_mode == "latin1":
        q = latin1_mode(q)
    elif escape_mode != "none":
        raise ValueError(f"escape_mode {escape_mode!r}")
    cleaned = F.regexp_replace(F.lower(q), C.PUNCT_RE, "")
    return F.array_join(drop_stop_words(words(cleaned), stop), " ")


# --- T09 / T10 --------------------------------------------------------------------

def terms(text) -> Column:
    """Lower-cased word tokens, in order, duplicates kept."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(C.TERM_RE), 0)


def index_terms(text, stop=C.INDEX_STOP_WORDS) -> Column:
    """T09 + T10: tokens with the index-side stop list removed."""
    return drop_stop_words(terms(text), stop)


# --- T04 - T08, T19: snippets -------------------------------------------------------

def snippet_terms(raw_query, stop=C.QUERY_STOP_WORDS, min_len: int = C.SNIPPET_MIN_TERM_LEN) -> Column:
    """Raw whitespace tokens (punctuation kept) that are not stop words and are
    longer than two characters."""
    stop = list(stop)
    return F.filter(words(raw_query), lambda t: (F.length(t) >= min_len) & ~F.lower(t).isin(stop))


def regex_escape(t) -> Column:
    """Backslash before every ASCII punctuation character."""
    return F.regexp_replace(_col(t), r"([!-/:-@\[-`{-~])", r"\\$1")


def snippet_anchor(contents, term_arr) -> Column:
    """0-based character offset of the first whole-word, case-insensitive hit of
    the first term (in query order) that occurs anywhere; NULL when none does.

    ``aggregate`` with ``coalesce`` stops testing terms once one has matched, and each
    test is a single ``regexp_instr``. That position counts UTF-16 units, so it is
    turned into characters by decoding the UTF-16 prefix once per row."""
    contents = _col(contents)

    def pos16(t):
        p = F.regexp_instr(contents, F.concat(F.lit(r"(?isu)\b"), regex_escape(t), F.lit(r"\b")))
        return F.when(p > 0, p)

    first = F.aggregate(_col(term_arr), F.lit(None).cast("int"), lambda acc, t: F.coalesce(acc, pos16(t)))
    utf16 = F.encode(contents, "UTF-16LE")
    prefix = F.decode(F.substring(utf16, F.lit(1), (first - 1) * 2), "UTF-16LE")
    return F.when(first.isNotNull(), F.length(prefix))


def snippet_window(contents, anchor, before: int = C.SNIPPET_BEFORE, window: int = C.SNIPPET_WINDOW,
                   fallback: int = C.SNIPPET_FALLBACK) -> Column:
    """[anchor-before, anchor+window) clipped to the text, newlines to blanks;
    the first ``fallback`` characters when there is no anchor."""
    contents, anchor = _col(contents), _col(anchor)
    start = F.greatest(F.lit(0), anchor - before)
    end = F.least(F.length(contents), anchor + window)
    around = F.substring(contents, start + 1, end - start)
    head = F.substring(contents, 1, fallback)
    return F.translate(F.when(anchor.isNull(), head).otherwise(around), "\n", " ")


def highlight(snippet, term_arr) -> Column:
    """Wrap every whole-word hit of any term in ``**``."""
    alt = F.array_join(F.transform(_col(term_arr), regex_escape), "|")
    pat = F.concat(F.lit(r"(?iu)\b("), alt, F.lit(r")\b"))
    return F.when(F.size(_col(term_arr)) > 0, F.regexp_replace(_col(snippet), pat, F.lit("**$1**"))) \
        .otherwise(_col(snippet))


def snippet(contents, raw_query, stop=C.QUERY_STOP_WORDS) -> Column:
    """T04-T08 composed as one expression (for small inputs; see ``with_snippet``)."""
    ts = snippet_terms(raw_query, stop)
    anchor = snippet_anchor(contents, ts)
    return highlight(snippet_window(contents, anchor), ts)


def with_snippet(df, contents: str = "contents", raw_query: str = "query", out: str = "snippet",
                 stop=C.QUERY_STOP_WORDS):
    """T04-T08 as three projections: terms, then anchor, then window + highlight. The
    anchor is an interpreted higher-order expression that the window and the
    highlight each read several times; as its own column it is computed once per row
    (the optimizer does not inline an expensive column into several references)."""
    t = df.withColumn("_st", snippet_terms(raw_query, stop))
    t = t.withColumn("_sa", snippet_anchor(contents, "_st"))
    t = t.withColumn(out, highlight(snippet_window(contents, "_sa"), "_st"))
    return t.drop("_st", "_sa")


def title_of(contents) -> Column:
    """Text before the first newline."""
    return F.substring_index(_col(contents), "\n", 1)


def score_text(score, places: int = 4) -> Column:
    """Fixed-point score text. Python's formatting rounds an exact tie (0.03125)
    to even; Java's ``%f`` would round it up, so round half-even first."""
    return F.format_string(f"%.{places}f", F.bround(_col(score), places))


# --- T12 - T15: decomposition helpers -------------------------------------------------

def strip_article(chunk) -> Column:
    """Lower-case and drop one leading a/the/this/that."""
    return F.regexp_replace(F.lower(_col(chunk)), C.ARTICLE_PREFIX_RE, "")


def python_title(s) -> Column:
    """Python ``str.title()`` — upper after any non-letter, lower elsewhere."""
    runs = F.regexp_extract_all(_col(s), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))),
        "")


def word_count(s) -> Column:
    """Python ``len(s.split())``."""
    return F.size(words(_col(s)))


def capitalised_names(q) -> Column:
    """Runs of two or more capitalised words."""
    return F.regexp_extract_all(_col(q), F.lit(C.CAPITALISED_NAME_RE), 0)


def strip_code_fence(reply) -> Column:
    """Drop a leading triple-backtick json line opener and trailing fences."""
    return F.regexp_replace(F.trim(_col(reply)), C.CODE_FENCE_RE, "")


LINE_END = "__end_of_line__"


def parse_json_strict(e: Column, fields: str) -> Column:
    """``e`` as STRUCT<fields>, or null unless the whole string is exactly one JSON object.

    Spark's parser stops after the first value and takes single quotes. Here quotes must be
    double, and the string is parsed inside an outer object whose last field is only reached
    if nothing but white space follows the inner value."""
    outer = F.concat(F.lit('{"v":'), e, F.lit(f',"{LINE_END}":1}}'))
    j = F.from_json(outer, f"v STRUCT<{fields}>, {LINE_END} INT, _corrupt STRING",
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"})
    whole = j["_corrupt"].isNull() & (j[LINE_END] == 1) & ~F.contains(e, F.lit(LINE_END))
    return F.when(whole, j["v"])


def strip(e: Column) -> Column:
    """Python ``str.strip()``: all white space at both ends, not only blanks."""
    return F.regexp_replace(e, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
