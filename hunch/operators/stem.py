"""T11 term stemming as Column expressions: ``none``, the S stemmer and the Porter stemmer.

A stem is a pure function of the term, so it is applied inline on each token: no
vocabulary join (which would shuffle every token by term and put a frequent term in
one task), no Python. ``stem_vocabulary`` gives the ``(term, stem)`` table for audit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def s_stem(t: Column) -> Column:
    """The S stemmer (Harman, 1991): first matching rule of
    ``-ies -> -y`` (not after e/a), ``-es -> -e`` (not after a/e/o), ``-s -> ''`` (not after u/s)."""
    return (F.when(t.rlike("ies$") & ~t.rlike("[ea]ies$"), F.regexp_replace(t, "ies$", "y"))
            .when(t.rlike("es$") & ~t.rlike("[aeo]es$"), F.regexp_replace(t, "es$", "e"))
            .when(t.rlike("s$") & ~t.rlike("[us]s$"), F.regexp_replace(t, "s$", ""))
            .otherwise(t))


# The measure of a stem as patterns: consonant and vowel runs ([C](VC)^m[V]).
_CONS, _VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
M_POSITIVE = f"^({_CONS})?{_VOWELS}{_CONS}"
M_ONE = f"^({_CONS})?{_VOWELS}{_CONS}({_VOWELS})?$"
M_ABOVE_ONE = f"^({_CONS})?{_VOWELS}{_CONS}{_VOWELS}{_CONS}"
HAS_VOWEL = f"^({_CONS})?[aeiouy]"
SHORT = f"^{_CONS}[aeiouy][^aeiouwxy]$"
DOUBLED = "(" + "|".join(x * 2 for x in "bcdfghjkmnpqrtvwx0123456789") + ")$"


def _steps(word, when, match, part, cat, cut, let, lit):
    """The Porter steps over an engine's own functions, so that both engines share one text:
    ``when(cases, other)``, ``match(e, pattern)``, ``part(e, pattern, group)``, ``cat(*es)``,
    ``cut(e)`` (without the last character), ``let(e, f)`` (bind ``e`` once), ``lit(text)``."""
    def suffixes(table, least):
        pattern = "^(.+?)(" + "|".join(table) + ")$"

        def step(w):
            stem, end = part(w, pattern, 1), part(w, pattern, 2)
            cases = [((match(w, f"^.+{s}$"), match(end, f"^{s}$"), match(stem, least)), cat(stem, lit(r))) for s, r in table.items()]
            return when(cases, w)
        return step

    def step_1a(w):
        return when([((match(w, "^.+(ss|i)es$"),), part(w, "^(.+?(ss|i))es$", 1)), ((match(w, "^.+[^s]s$"),), cut(w))], w)

    def mend(w):
        return when([((match(w, "(at|bl|iz)$"),), cat(w, lit("e"))), ((match(w, DOUBLED),), cut(w)), ((match(w, SHORT),), cat(w, lit("e")))], w)

    def step_1b(w):
        stem = part(w, "^(.+?)(ed|ing)$", 1)
        return when([((match(w, "^.+eed$"), match(part(w, "^(.+?)eed$", 1), M_POSITIVE)), cut(w)), ((match(w, "^.+eed$"),), w),
                     ((match(w, "^.+(ed|ing)$"), match(stem, HAS_VOWEL)), let(stem, mend))], w)

    def step_1c(w):
        return when([((match(w, "^.+y$"), match(part(w, "^(.+?)y$", 1), HAS_VOWEL)), cat(cut(w), lit("i")))], w)

    def step_4(w):
        pattern = "^(.+?)(" + "|".join(C.PORTER_STEP4) + ")$"
        ion = "^(.+?[st])ion$"
        return when([((match(w, pattern), match(part(w, pattern, 1), M_ABOVE_ONE)), part(w, pattern, 1)), ((match(w, pattern),), w),
                     ((match(w, ion), match(part(w, ion, 1), M_ABOVE_ONE)), part(w, ion, 1))], w)

    def step_5a(w):
        stem = part(w, "^(.+?)e$", 1)
        return when([((match(w, "^.+e$"), match(stem, M_ABOVE_ONE)), stem), ((match(w, "^.+e$"), match(stem, SHORT)), w),
                     ((match(w, "^.+e$"), match(stem, M_ONE)), stem)], w)

    def step_5b(w):
        return when([((match(w, "ll$"), match(w, M_ABOVE_ONE)), cut(w))], w)
    first_y = lambda w: when([((match(w, "^y"),), cat(lit("Y"), part(w, "^y(.*)$", 1)))], w)  # noqa: E731  an initial y is a consonant
    last_y = lambda w: when([((match(w, "^Y"),), cat(lit("y"), part(w, "^Y(.*)$", 1)))], w)
    for step in (first_y, step_1a, step_1b, step_1c, suffixes(C.PORTER_STEP2, M_POSITIVE), suffixes(C.PORTER_STEP3, M_POSITIVE),
                 step_4, step_5a, step_5b, last_y):
        word = let(word, step)
    return word


def porter_stem(t: Column) -> Column:
    """The Porter stemmer (Porter, 1980, with the author's later changes); up to two letters stay."""
    def when(cases, other):
        out = None
        for conds, value in cases:
            c = conds[0]
            for more in conds[1:]:
                c = c & more
            out = F.when(c, value) if out is None else out.when(c, value)
        return out.otherwise(other)
    done = _steps(t, when, lambda e, p: e.rlike(p), lambda e, p, i: F.regexp_extract(e, p, i),
                  lambda *es: F.concat(*es), lambda e: F.substring(e, F.lit(1), F.length(e) - 1),
                  lambda e, f: F.get(F.transform(F.array(e), f), F.lit(0)), F.lit)
    return F.when(F.length(t) <= 2, t).otherwise(done)


def porter_sql(t: str) -> str:
    """The same in DuckDB SQL."""
    fresh = iter(range(1000))

    def let(e, f):
        v = f"w{next(fresh)}"
        return f"list_extract(list_transform([{e}], lambda {v}: {f(v)}), 1)"

    def when(cases, other):
        return "CASE " + " ".join(f"WHEN {' AND '.join(c)} THEN {v}" for c, v in cases) + f" ELSE {other} END"
    done = _steps(t, when, lambda e, p: f"regexp_matches({e}, '{p}')", lambda e, p, i: f"regexp_extract({e}, '{p}', {i})",
                  lambda *es: "(" + " || ".join(es) + ")", lambda e: f"substring({e}, 1, length({e}) - 1)", let, lambda x: f"'{x}'")
    return f"CASE WHEN length({t}) <= 2 THEN {t} ELSE {done} END"


def stem_expr(t: Column, stemmer: str) -> Column:
    if stemmer == "none":
        return t
    if stemmer == "s":
        return s_stem(t)
    if stemmer == "porter":
        return porter_stem(t)
    raise ValueError(f"stemmer {stemmer!r}")


def apply_stems(df: DataFrame, col: str, stemmer: str) -> DataFrame:
    return df.withColumn(col, stem_expr(F.col(col), stemmer))


def stem_vocabulary(term_stats: DataFrame, stemmer: str = "s") -> DataFrame:
    """``(term, stem)`` for every indexed term."""
    return term_stats.select("term", stem_expr(F.col("term"), stemmer).alias("stem"))
