"""Spans of a phrase table in sentences, by an n-gram equi-join.

The n-grams of each sentence, of the lengths the table has, are formed in the row and meet
the phrases by their text; where the table is small, only those that it has leave the row. Among overlapping hits the leftmost wins, of one start the longest.
Hits that no chain of overlaps connects are chosen independently, so a choice folds over one
such island only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins as J
from . import lexicon as L

#: Up to this size a table of phrases is part of the plan, and only n-grams that it has become rows; all n-grams of
#: the sentences meet a larger table by join.
LITERAL_PHRASES, LITERAL_CHARS = 5_000, 200_000


def _words(c):
    return F.regexp_extract_all(F.lower(c), F.lit(L.TOKEN_RE), 0)


def _table(found) -> dict[int, tuple[list[str], list[str]]]:
    """By length: the phrases of that length and their first words."""
    by = {}
    for r in found:
        by.setdefault(r["n"], []).append(r["phrase"])
    return {n: (x, sorted({y.split(" ", 1)[0] for y in x})) for n, x in by.items()}


def _grams(words: Column, lengths: list[int], table: dict | None) -> Column:
    """The n-grams of ``words`` of the given lengths, with their starts; with ``table`` its phrases only. An n-gram is
    read word by word: ``slice`` would copy the whole sentence for each."""
    def at(w, i):
        def gram(n):
            text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.get(words, i + k)), " ") if n > 1 else w
            whole = i + n <= F.size(words)
            if table is not None:
                whole = w.isin(table[n][1]) & whole & text.isin(table[n][0])
            return F.when(whole, F.struct(i.cast("int").alias("start"), F.lit(n).alias("n"), text.alias("phrase")))
        each = F.array_compact(F.array(*map(gram, lengths)).cast("array<struct<start:int,n:int,phrase:string>>"))
        return each if table is None else F.when(w.isin(sorted({x for _, first in table.values() for x in first})), each)
    return F.flatten(F.array_compact(F.transform(words, at)))


def phrase_spans(sents: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(qid, sent_i, start, end, phrase, label)``: where ``phrases(phrase, label)`` occur in
    ``sents(qid, sent_i, sent)``, in tokens of the sentence, end exclusive. Case does not matter; a
    phrase with several labels takes the smallest; null and empty phrases, labels and sentences
    give nothing."""
    w = _words(F.col("phrase"))
    p = phrases.filter(F.col("label").isNotNull()).select(F.array_join(w, " ").alias("phrase"), F.size(w).alias("n"), "label") \
        .filter("n > 0").groupBy("phrase", "n").agg(F.min("label").alias("label"))
    found = p.limit(LITERAL_PHRASES + 1).collect()
    table = _table(found) if len(found) <= LITERAL_PHRASES and sum(len(r["phrase"]) for r in found) <= LITERAL_CHARS else None
    lengths = sorted(table or [r["n"] for r in p.select("n").distinct().collect()])  # one row a phrase length
    # No filter on the words: it would be pushed below them, and they would be made twice.
    g = sents.select("qid", "sent_i", _words(F.col("sent")).alias("words")) \
        .select("qid", "sent_i", F.explode(_grams(F.col("words"), lengths, table)).alias("g")).select("qid", "sent_i", "g.*")
    if table is not None:
        p = sents.sparkSession.createDataFrame(found, p.schema)
    hits = g.join(F.broadcast(p) if table is not None or J.fits_broadcast(p) else p, ["phrase", "n"])
    best = hits.groupBy("qid", "sent_i", "start").agg(F.max_by(F.struct("n", "phrase", "label"), "n").alias("h")) \
        .select("qid", "sent_i", "start", (F.col("start") + F.col("h.n")).alias("end"), "h.phrase", "h.label")
    w = Window.partitionBy("qid", "sent_i").orderBy("start")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    best = best.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    best = best.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    h = F.struct("start", "end", "phrase", "label")
    none = F.array().cast("array<struct<start:int,end:int,phrase:string,label:string>>")
    chosen = F.aggregate("hits", none, lambda acc, x: F.when(
        (F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= x["start"]), F.concat(acc, F.array(x))).otherwise(acc))
    return best.groupBy("qid", "sent_i", "island").agg(F.array_sort(F.collect_list(h)).alias("hits")) \
        .select("qid", "sent_i", F.inline(chosen))


def label_tokens(t: DataFrame, spans: DataFrame) -> DataFrame:
    """Tokens ``t`` of ``annotate.entities`` with the spans' ids and labels. A span found by rule that
    a phrase cuts into gives way to it as a whole."""
    s = spans.select("qid", "sent_i", F.col("start").alias("_start"), F.col("label").alias("_label"),
                     F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("sent_pos"))
    j = t.join(s, ["qid", "sent_i", "sent_pos"], "left")
    run = Window.partitionBy("qid", "sent_i", F.coalesce("ent_id", -1 - F.col("tok_i")))
    j = j.withColumn("_cut", F.max(F.col("_label").isNotNull()).over(run))
    own = F.col("_label").isNotNull()
    pick = lambda phrase, rule: F.when(own, phrase).when(~F.col("_cut"), F.col(rule))
    j = j.withColumns({"ent_id": pick(F.col("tok_i") - F.col("sent_pos") + F.col("_start"), "ent_id"),
                       "ent_label": pick(F.col("_label"), "ent_label"), "ent_type": pick(F.col("_label"), "ent_type")})
    return j.select(*t.columns)
