"""Shallow rule annotator (A01-A07): fills the ``annotations`` token table.

``annotations(qid, sent_i, tok_i, text, lemma, pos, dep, head_i, ent_type, ent_id,
ent_label, chunk_id, is_chunk_root)`` — one row per token. Tokens, parts of speech and entity
spans (A02, A03, A05, A06) are array expressions in the question's own row, without an
exchange. Chunks and dependencies are windows over the tokens of one sentence (``PARTITION BY
qid, sent_i ORDER BY tok_i``): one shuffle by sentence, then sorted window passes, which a
reader of other columns does not pay. A question is one row of input; its tokens are bounded by
its own length, so no partition grows with the number of questions.

Rules (ours; a trained parser would do better, the downstream rules do not care who
filled the table):

* A01 sentences: runs of text up to and including ``.``/``!``/``?``.
* A02 tokens: words (letters, digits, ``_``, inner apostrophes) and single punctuation
  marks; ``tok_i`` counts across the whole question.
* A03 part of speech: punctuation, digits, time words, closed-class lexicon, then
  capitalisation (PROPN unless a lone sentence-initial word), then suffixes, else NOUN;
  a NOUN becomes VERB after a pronoun/auxiliary/negation, or when it ends in ``s``
  right after a noun and right before a determiner/preposition/pronoun/number/name.
* A07 noun chunks: DET? followed by ADJ/NUM/NOUN/PROPN, up to the last NOUN/PROPN (root).
* A05/A06 entity spans: runs of PROPN (ORG by last word, GPE by gazetteer, else PERSON
  when two or more words); runs of time words / years / decades (DATE or TIME).
* A04 dependencies: chunk members hang on their root; a nominal right after a
  preposition is its ``pobj``; the first nominal after a verb with no barrier between is
  its ``dobj``; the last free nominal before a verb is its ``nsubj``; a preposition hangs
  on the previous verb (else the previous nominal) as ``prep``; not/never is ``neg`` of
  the next verb; the first verb of a sentence is ROOT, later ones ``conj``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import lexicon as L


def _ws():
    """Tokens of one sentence in order."""
    return Window.partitionBy("qid", "sent_i").orderBy("tok_i")


def _wb():
    return _ws().rowsBetween(Window.unboundedPreceding, -1)


def _wu():
    return _ws().rowsBetween(Window.unboundedPreceding, 0)


def _wa():
    """Rows after the current one, seen from the end: ``last(x, ignorenulls)`` over this
    frame is the first non-null value after the row. A reversed running frame is
    evaluated incrementally; a ``1 FOLLOWING .. UNBOUNDED FOLLOWING`` frame would be
    recomputed per row (quadratic in the sentence length)."""
    return Window.partitionBy("qid", "sent_i").orderBy(F.col("tok_i").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)


BARRIER = ["ADP", "VERB", "AUX", "SCONJ", "CCONJ", "PUNCT", "PART"]
CHUNKABLE = ["DET", "ADJ", "NOUN", "PROPN", "NUM"]


def sentences(topics: DataFrame, query_col: str = "query") -> DataFrame:
    """A01 ``(qid, sent_i, sent)``."""
    s = topics.select("qid", F.posexplode(F.regexp_extract_all(F.col(query_col), F.lit(L.SENTENCE_RE), 0))
                      .alias("sent_i", "sent"))
    return s.select("qid", F.col("sent_i").cast("int"), F.trim("sent").alias("sent"))


def _place(s: Column, i: Column) -> Column:
    """Tokens of sentence ``s``, the ``i``-th of its text."""
    return F.transform(F.regexp_extract_all(F.trim(s), F.lit(L.TOKEN_RE), 0),
                       lambda t, p: F.struct(i.cast("int").alias("sent_i"), p.cast("int").alias("sent_pos"), t.alias("text")))


def tokens(topics: DataFrame, query_col: str = "query") -> DataFrame:
    """A02 ``(qid, toks ARRAY<STRUCT<sent_i, sent_pos, text>>)``: a question's tokens in order, in its own
    row; ``tok_i`` is the place in the array. Rows that repeat a ``qid`` are one question: their
    tokens meet by sentence and place, in an exchange that only these rows take."""
    t = topics.select("qid", F.flatten(F.transform(F.regexp_extract_all(F.col(query_col), F.lit(L.SENTENCE_RE), 0), _place)).alias("toks"))
    several = cut_lineage(topics.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("qid").alias("_q")), "repeated")
    if several.isEmpty():
        return t
    same = F.col("qid").eqNullSafe(F.col("_q"))
    merged = t.join(several, same, "left_semi").select("qid", F.inline("toks")) \
        .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("sent_i", "sent_pos", "text"))).alias("toks"))
    return t.join(several, same, "left_anti").unionByName(merged)


def _in(c: Column, words) -> Column:
    return c.isin(list(words))


def is_date(low: Column, cap: Column) -> Column:
    digit = (low >= "0") & (low < ":")
    return (_in(low, L.DATE_WORDS) | (digit & (low.rlike(L.YEAR_RE) | low.rlike(L.DECADE_RE)))
            | (cap & _in(low, L.MONTHS + L.WEEKDAYS)))


#: One character for a part of speech (and for what the rules ask of it): ``n`` is a noun in -s, ``d`` / ``t`` a noun
#: and ``y`` a number of a date or time; ``|`` stands before a sentence's first token.
CODES = {"PUNCT": ".", "NUM": "9", "DET": "D", "PRON": "R", "ADP": "A", "CCONJ": "C", "SCONJ": "S", "AUX": "X", "PART": "T", "ADV": "B",
         "ADJ": "J", "PROPN": "P", "VERB": "V", "NOUN": "N"}
POS = {c: k for k, c in CODES.items()} | {"n": "NOUN", "d": "NOUN", "t": "NOUN", "y": "NUM"}
TO_VERB = "(?<=[RXT])[Nn]|(?<=[NndtP])n(?=[DAR9yP])"
RUN_START = "(?<!P)P|(?<![dty])[dty]|(?<![^Pdty|])[^Pdty|]"


def lexical_code(text: Column, low: Column, cap: Column, sent_pos: Column, next_cap: Column) -> Column:
    """A03 first pass (no context beyond the next token's capital), as one of the codes above."""
    latin = (low >= "a") & (low < "{")  # spares most words two patterns
    e = F.when(~latin & ~text.rlike(r"^[\p{L}\p{N}_]"), F.lit(CODES["PUNCT"])) \
        .when(~latin & text.rlike(r"^\p{N}+$"), F.when(is_date(low, cap), F.lit("y")).otherwise(F.lit(CODES["NUM"]))) \
        .when(is_date(low, cap), F.lit("d")).when(_in(low, L.TIME_WORDS), F.lit("t"))
    for tag, words in L.CLOSED:
        e = e.when(_in(low, words), F.lit(CODES[tag]))
    noun = F.when(low.endswith("s"), F.lit("n")).otherwise(F.lit("N"))
    return (e.when(cap & ((sent_pos > 0) | F.coalesce(next_cap, F.lit(False))), F.lit(CODES["PROPN"]))
            .when(~low.rlike("(ly|ing|ed|" + L.ADJ_SUFFIX_RE[1:]), noun)
            .when(low.rlike(r".{3,}ly$"), F.lit(CODES["ADV"]))
            .when(low.rlike(r".{3,}(ing|ed)$"), F.lit(CODES["VERB"]))
            .when(low.rlike(".{2,}" + L.ADJ_SUFFIX_RE), F.lit(CODES["ADJ"]))
            .otherwise(noun))


def verb_lemma(low: Column) -> Column:
    return (F.when(low.rlike("ies$"), F.regexp_replace(low, "ies$", "y"))
            .when(low.rlike("(ss|sh|ch|x|z|o)es$"), F.regexp_replace(low, "es$", ""))
            .when(low.rlike("[^s]s$"), F.regexp_replace(low, "s$", ""))
            .when(low.rlike("ied$"), F.regexp_replace(low, "ied$", "y"))
            .when(low.rlike(".{3,}ed$"), F.regexp_replace(low, "ed$", ""))
            .when(low.rlike(".{3,}ing$"), F.regexp_replace(low, "ing$", ""))
            .otherwise(low))


def tag(q: DataFrame) -> DataFrame:
    """``tags``, a string with the code of every token of ``toks``, a bar before each sentence. A
    word in context becomes a verb by one pass of a pattern over the string."""
    q = q.withColumn("_words", F.transform("toks", lambda x: F.struct(
        x["sent_i"].alias("sent_i"), x["sent_pos"].alias("sent_pos"), x["text"].alias("text"), F.lower(x["text"]).alias("low"), x["text"].rlike(r"^\p{Lu}").alias("cap"))))

    def code(x, i):
        after, before = F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i - 1)
        own = lexical_code(x["text"], x["low"], x["cap"], x["sent_pos"], (after["sent_i"] == x["sent_i"]) & after["cap"])
        first = (x["sent_pos"] == 0) & ((i == 0) | (before["sent_i"] != x["sent_i"]))
        return F.concat(F.when(first, F.lit("|")).otherwise(F.lit("")), own)
    tags = F.regexp_replace(F.array_join(F.transform("_words", code), ""), TO_VERB, CODES["VERB"])
    return q.select("qid", "toks", tags.alias("tags"))


def _run_break(flag: str) -> Column:
    return F.col(flag) & ~F.coalesce(F.lag(flag).over(_ws()), F.lit(False))


def _run_start(flag: str, brk: str) -> Column:
    """Gaps and islands: first ``tok_i`` of the run of consecutive rows where ``flag``
    holds (NULL off the run)."""
    return F.when(F.col(flag), F.last(F.when(F.col(brk), F.col("tok_i")), True).over(_wu()))


def _whole(part: str):
    """All rows of one run. Rows outside any run (``part`` NULL) get a partition each,
    so a whole-run aggregate such as ``collect_list`` is not copied into every other
    token of the sentence (which would be quadratic in the sentence length)."""
    key = F.coalesce(F.col(part), -1 - F.col("tok_i"))
    return Window.partitionBy("qid", "sent_i", key).orderBy("tok_i") \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def stretches(q: DataFrame, gpe=L.GPE_NAMES, org_words=L.ORG_WORDS) -> DataFrame:
    """A05 + A06: ``_runs``, the stretches of names, of time words and of others that a question falls into, each
    with its start ``s``, its number of tokens ``n`` and its label (null: no span)."""
    def stretch(s, k):
        n = F.coalesce(F.get("_begin", (k + 1).cast("int")), F.size("toks")) - s
        c = F.get("_codes", s)
        text = F.lower(F.array_join(F.transform(F.slice("toks", s + 1, n), lambda t: t["text"]), " "))
        name = F.when(_in(F.lower(F.get("toks", s + n - 1)["text"]), org_words), F.lit("ORG")) \
            .when(_in(text, gpe), F.lit("GPE")).when(n >= 2, F.lit("PERSON"))
        return F.struct(s.alias("s"), n.alias("n"), F.when(c == "P", name).when(c == "t", F.lit("TIME")).when(c.isin("d", "y"), F.lit("DATE")).alias("label"))
    # No filter on these arrays: it would be pushed below the columns that they are made of, which would be evaluated anew for each token.
    chars = lambda c: F.split(F.replace(c, F.lit("|"), F.lit("")), "")
    q = q.withColumns({"_codes": chars(F.col("tags")), "_starts": chars(F.regexp_replace("tags", RUN_START, "#"))})
    q = q.withColumn("_begin", F.array_compact(F.transform("_starts", lambda c, i: F.when(c == "#", i.cast("int")))))
    return q.withColumn("_runs", F.transform("_begin", stretch))


def spans(topics: DataFrame, query_col: str = "query") -> DataFrame:
    """``(qid, ent_id, ent_label, ent_text)``: the spans of every question, made in its own row, so that no
    token becomes a row and nothing is moved or sorted to put them together again."""
    def span(g):
        text = F.array_join(F.transform(F.slice("toks", g["s"] + 1, g["n"]), lambda t: t["text"]), " ")
        return F.when(g["label"].isNotNull(), F.struct(g["s"].alias("ent_id"), g["label"].alias("ent_label"), text.alias("ent_text")))
    q = stretches(tag(tokens(topics, query_col)))
    return q.select("qid", F.inline(F.array_compact(F.transform("_runs", span))))


def entities(q: DataFrame, gpe=L.GPE_NAMES, org_words=L.ORG_WORDS) -> DataFrame:
    """A05 + A06: one row per token of ``toks``, with ``tok_i``, ``ent_id`` (span start) and ``ent_label``.

    A stretch gets its label once, then its tokens are read off it, so the work is linear in the question."""
    def members(g):
        return F.transform(F.slice("toks", g["s"] + 1, g["n"]), lambda x, j: F.struct(
            x["sent_i"].alias("sent_i"), x["sent_pos"].alias("sent_pos"), x["text"].alias("text"), F.get("_codes", g["s"] + j).alias("code"),
            (g["s"] + j).cast("int").alias("tok_i"), F.when(g["label"].isNotNull(), g["s"]).alias("ent_id"), g["label"].alias("ent_label")))
    q = stretches(q, gpe, org_words)
    t = q.select("qid", F.inline(F.flatten(F.transform("_runs", members))))
    pos = F.lit(None).cast("string")
    for c, p in POS.items():
        pos = F.when(F.col("code") == c, F.lit(p)).otherwise(pos)
    low, code = F.lower("text"), F.col("code")
    t = t.withColumns({"pos": pos, "tkind": F.when(code == "t", F.lit("TIME")).when(code.isin("d", "y"), F.lit("DATE"))})
    return t.withColumns({"lemma": F.when(F.col("pos") == "VERB", verb_lemma(low)).otherwise(low), "ent_type": F.col("ent_label")}).drop("code")


def chunks(t: DataFrame) -> DataFrame:
    """``chunk_id`` (first token) for members, ``is_chunk_root`` for the root."""
    t = t.withColumn("_c", F.col("pos").isin(CHUNKABLE))
    t = t.withColumn("_b", F.col("_c") & (~F.coalesce(F.lag("_c").over(_ws()), F.lit(False)) | (F.col("pos") == "DET")))
    t = t.withColumn("_isl", _run_start("_c", "_b"))
    t = t.withColumn("_root", F.max(F.when(F.col("pos").isin("NOUN", "PROPN"), F.col("tok_i"))).over(_whole("_isl")))
    member = F.col("_c") & F.col("_root").isNotNull() & (F.col("tok_i") <= F.col("_root"))
    keep = [c for c in t.columns if not c.startswith("_")]
    return t.select(*keep, F.when(member, F.col("_isl")).alias("chunk_id"),
                    F.when(member, F.col("_root")).alias("chunk_root_i"),
                    F.coalesce(member & (F.col("tok_i") == F.col("_root")), F.lit(False)).alias("is_chunk_root"))


def dependencies(t: DataFrame) -> DataFrame:
    """``dep`` and ``head_i``."""
    pos, tok = F.col("pos"), F.col("tok_i")
    # nominal heads: chunk roots and pronouns, and where their phrase starts
    t = t.withColumns({"_prevpos": F.lag("pos").over(_ws()),
                       "_cand": F.col("is_chunk_root") | (pos == "PRON"),
                       "_nstart": F.when(F.col("is_chunk_root"), F.col("chunk_id")).when(pos == "PRON", tok)})
    # part of speech right before the phrase start (read on the start row)
    wst = Window.partitionBy("qid", "sent_i", "chunk_id").orderBy("tok_i")
    pre = F.when(pos == "PRON", F.col("_prevpos")).when(F.col("is_chunk_root"), F.first("_prevpos").over(wst))
    t = t.withColumns({
        "_pobj": F.col("_cand") & F.coalesce(pre == "ADP", F.lit(False)),
        "_lverb": F.last(F.when(pos == "VERB", tok), True).over(_wb()),
        "_nverb": F.last(F.when(pos == "VERB", tok), True).over(_wa()),
        "_lbar": F.last(F.when(pos.isin(BARRIER), tok), True).over(_wb()),
        "_lcand": F.last(F.when(F.col("_cand"), tok), True).over(_wb())})
    is_obj = (F.col("_cand") & ~F.col("_pobj") & F.col("_lverb").isNotNull()
              & (F.col("_lbar") == F.col("_lverb"))
              & (F.col("_lcand").isNull() | (F.col("_lcand") < F.col("_lverb"))))
    t = t.withColumn("_obj", F.coalesce(is_obj, F.lit(False)))
    t = t.withColumn("_scand", F.col("_cand") & ~F.col("_pobj") & ~F.col("_obj"))
    t = t.withColumn("_nscand", F.last(F.when(F.col("_scand"), tok), True).over(_wa()))
    is_subj = F.coalesce(F.col("_scand") & F.col("_nverb").isNotNull()
                         & (F.col("_nscand").isNull() | (F.col("_nscand") > F.col("_nverb"))), F.lit(False))
    low = F.lower("text")
    member_dep = F.when(pos == "DET", "det").when(pos == "ADJ", "amod").when(pos == "NUM", "nummod") \
        .otherwise("compound")
    loose_head = F.coalesce(F.col("_nverb"), F.col("_lverb"), tok)
    member = F.col("chunk_id").isNotNull() & ~F.col("is_chunk_root")
    is_neg = _in(low, L.NEGATIONS) & F.col("_nverb").isNotNull()
    dep = (F.when(F.col("_pobj"), F.lit("pobj"))
           .when(F.col("_obj"), F.lit("dobj"))
           .when(is_subj, F.lit("nsubj"))
           .when(member, member_dep)
           .when((pos == "ADP") & (F.col("_lverb").isNotNull() | F.col("_lcand").isNotNull()), F.lit("prep"))
           .when(is_neg, F.lit("neg"))
           .when((pos == "VERB") & F.col("_lverb").isNull(), F.lit("ROOT"))
           .when(pos == "VERB", F.lit("conj"))
           .when(pos == "AUX", F.lit("aux")).when(pos == "CCONJ", F.lit("cc"))
           .when(pos == "SCONJ", F.lit("mark")).when(pos == "PUNCT", F.lit("punct"))
           .when(pos == "ADV", F.lit("advmod"))
           .otherwise(F.lit("dep")))
    head = (F.when(F.col("_pobj"), F.col("_nstart") - 1)
            .when(F.col("_obj"), F.col("_lverb"))
            .when(is_subj, F.col("_nverb"))
            .when(member, F.col("chunk_root_i"))
            .when(pos == "ADP", F.coalesce(F.col("_lverb"), F.col("_lcand"), tok))
            .when(is_neg, F.col("_nverb"))
            .when(pos == "VERB", F.coalesce(F.col("_lverb"), tok))
            .otherwise(loose_head))
    keep = [c for c in t.columns if not c.startswith("_")]
    return t.select(*keep, dep.alias("dep"), head.cast("int").alias("head_i"))


COLUMNS = ["qid", "sent_i", "tok_i", "text", "lemma", "pos", "dep", "head_i", "ent_type", "ent_id",
           "ent_label", "chunk_id", "is_chunk_root"]


def annotate(topics: DataFrame, query_col: str = "query", gpe=L.GPE_NAMES, org_words=L.ORG_WORDS,
             phrases: DataFrame | None = None) -> DataFrame:
    """Topics ``(qid, query)`` -> ``annotations``. ``phrases(phrase, label)``: a gazetteer whose
    spans come before those found by rule."""
    t = entities(tag(tokens(topics, query_col)), gpe, org_words)
    if phrases is not None:
        from . import gazetteer
        t = gazetteer.label_tokens(t, gazetteer.phrase_spans(sentences(topics, query_col), phrases))
    t = dependencies(chunks(t))
    return t.select(*COLUMNS)
