"""Operator 11: personal data by fixed patterns and bootstrapped contexts (DataFrame functions only).

The base patterns report e-mail addresses, IP addresses, card numbers that pass Luhn's test
and international phone numbers. They are written so that matching is linear in the text
(possessive, and no start inside a run that has just failed), which changes no match.

Bootstrapping: a mention is a run of at least six digits with their punctuation, or an
address with ``@`` or ``(at)``. Mentions that are base entities are the seeds; every mention
yields lexical patterns (the two words before it; the words on either side). The graph of
patterns and distinct values is scored in rounds: a pattern's confidence is the share of
known values among its values (plus one), and a value is accepted when its good patterns
(enough known values, enough confidence) together leave little doubt, ``1 - prod(1 - conf)``.
Accepted values count as known in the next round, until nothing changes. Mentions of accepted
values within a good pattern are added as ``number`` or ``handle`` spans; mentions longer than
``MAX_CHARS`` are no identifiers.

A span's place is the sum of the gaps and matches before it, taken by a window over the
matches of a document, so long texts with many matches stay linear. Only matches, contexts
and hashes are shuffled, never texts.

Results: one row per row with an id; null text is empty and has no spans. Spans are code
points, end exclusive, by start, then kind in the order of ``KINDS``. Repeated rows get equal
results, and a value or context counts once however many copies of a row there are. Rows that
repeat an id with other texts are scanned each for itself. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

# FIXED VALUES: the base patterns
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "number", "handle"]
AT = r" ?[(\[][aA][tT][)\]] ?"
NUMBER = r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){5,}+"
MENTION = rf"(?:(?<!{LOCAL})|\G)(?:{LOCAL}++(?:@|{AT})[A-Za-z0-9.-]++|{NUMBER})"

MIN_SUPPORT, MIN_CONF, ACCEPT, MAX_ROUNDS, MAX_CHARS = 3, 0.6, 0.8, 8, 60


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Luhn's test of a digit string."""
    def worth(i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return x - F.when(x > 9, 9).otherwise(0)
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, val: Column) -> Column:
    """Whether a match of a base pattern counts."""
    d = _digits(val)
    part = F.forall(F.split(val, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.concat(F.lit("0"), F.substring(F.ltrim(p, F.lit("0")), 1, 3)).cast("int") <= 255))
    return F.when(kind == 0, True).when(kind == 1, part) \
        .when(kind == 2, F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)) \
        .otherwise(F.length(d).between(10, 15))


def _texts(docs: DataFrame) -> DataFrame:
    return C.id_text(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("h", F.xxhash64("text"))


def _placed(matches: DataFrame) -> DataFrame:
    """``start`` and ``end`` of ``(doc_id, h, kind, pos, gap, val)``: match ``pos`` comes ``gap`` code points
    after the one before."""
    order = Window.partitionBy("doc_id", "h", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.length("val")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return matches.withColumn("end", end).withColumn("start", F.col("end") - F.length("val"))


def _rows(both: Column, kind: int) -> Column:
    return F.transform(both, lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), z["gap"].alias("gap"), z["val"].alias("val")))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, h, kind, start, end, val`` of the base entities of ``docs(doc_id, text, h)``."""
    may = [F.contains("text", F.lit("@")), F.col("text").rlike(r"[0-9]\.[0-9]"), F.col("text").rlike(r"[0-9](?:[ -]?[0-9]){13}"), F.contains("text", F.lit("+"))]
    found = []
    for k, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
        both = F.arrays_zip(F.transform(F.split("text", pattern, -1), F.length).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("val"))
        found.append(F.when(may[k], _rows(both, k)).otherwise(F.array().cast("array<struct<kind:int,pos:int,gap:int,val:string>>")))
    hits = docs.select("doc_id", "h", F.explode(F.concat(*found)).alias("m")).select("doc_id", "h", "m.*").filter("val IS NOT NULL") \
        .dropDuplicates(["doc_id", "h", "kind", "pos"])
    return _placed(hits).filter(_valid(F.col("kind"), F.col("val"))).select("doc_id", "h", "kind", "start", "end")


def mentions(docs: DataFrame) -> DataFrame:
    """``doc_id, h, kind, start, end, value, known, patterns`` of all mentions: ``kind`` 4 (number) or 5
    (handle), ``value`` normalised and hashed with the kind, ``known`` for base entities, ``patterns`` hashed."""
    gaps = F.transform(F.split("text", MENTION, -1), lambda g: F.struct(F.length(g).alias("gap"), F.substring(g, -48, 48).alias("tail"), F.substring(g, 1, 24).alias("front")))
    both = F.arrays_zip(gaps.alias("g"), F.regexp_extract_all("text", F.lit(MENTION), F.lit(0)).alias("val"))
    some = docs.filter(F.col("text").rlike(rf"[0-9]{{2}}|@|{AT}"))
    m = some.select("doc_id", "h", F.posexplode(both).alias("pos", "m")).select("doc_id", "h", F.lit(0).alias("kind"), "pos", "m.g.*", "m.val") \
        .dropDuplicates(["doc_id", "h", "pos"])
    order = Window.partitionBy("doc_id", "h", "kind").orderBy("pos")
    m = _placed(m.withColumn("after", F.lead("front").over(order)).filter("val IS NOT NULL"))
    val = F.col("val")
    handle = val.rlike(f"@|{AT}")
    part = F.when(val.rlike(f"^{PHONE}$"), _valid(F.lit(3), val)).otherwise(False)
    known = F.when(handle, val.rlike(f"^{EMAIL}$")).otherwise(
        part | F.when(val.rlike(f"^{IP}$"), _valid(F.lit(1), val)).otherwise(False) | F.when(val.rlike(f"^{CARD}$"), _valid(F.lit(2), val)).otherwise(False))
    words = [F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)) for c in ("tail", "after")]
    m = m.filter((F.length(val) <= MAX_CHARS) & ~F.col("after").rlike("^[A-Za-z0-9]")) \
        .select("doc_id", "h", F.when(handle, 5).otherwise(4).alias("kind"), "start", "end",
                F.when(handle, F.lower(F.regexp_replace(val, AT, "@"))).otherwise(_digits(val)).alias("value"), known.alias("known"),
                F.try_element_at(words[0], F.lit(-2)).alias("l2"), F.try_element_at(words[0], F.lit(-1)).alias("l1"), F.try_element_at(words[1], F.lit(1)).alias("r1"))
    before = F.when(F.col("l2").isNotNull(), F.xxhash64(F.lit("before"), "kind", "l2", "l1"))
    around = F.when(F.col("l1").isNotNull() & F.col("r1").isNotNull(), F.xxhash64(F.lit("around"), "kind", "l1", "r1"))
    return m.select("doc_id", "h", "kind", "start", "end", F.xxhash64("kind", "value").alias("value"), "known", F.array_compact(F.array(before, around)).alias("patterns"))


def bootstrap(found: DataFrame) -> DataFrame:
    """``doc_id, h, kind, start, end`` of the unknown ones among ``found`` (a written table of mentions)
    that the graph of patterns and values accepts."""
    edges = found.select(F.explode("patterns").alias("pattern"), "value", "known").groupBy("pattern", "value").agg(F.max("known").alias("known"))
    sums = C.cut(edges.groupBy("pattern").agg(F.sum(F.col("known").cast("long")).alias("k"), F.count(F.lit(1)).alias("n"))
                 .filter("k > 0 AND n > k"), "patterns")   # the others have no seed, or nothing to discover
    unknown = C.cut(edges.filter("NOT known").join(sums.select("pattern"), "pattern", "left_semi").select("pattern", "value"), "unknown")

    def good(extra: DataFrame | None) -> DataFrame:
        p = sums.withColumn("x", F.lit(0).cast("long")) if extra is None else sums.join(extra, "pattern", "left").withColumn("x", F.coalesce("x", F.lit(0)))
        p = p.select("pattern", (F.col("k") + F.col("x")).alias("k"), "n")
        return p.withColumn("conf", F.col("k") / (F.col("n") + 1)).filter((F.col("k") >= MIN_SUPPORT) & (F.col("conf") >= MIN_CONF)).select("pattern", "conf")
    accepted, seen, extra = None, -1, None
    for _ in range(MAX_ROUNDS):
        doubt = F.exp(F.sum(F.log(1 - F.col("conf"))))
        accepted = C.cut(unknown.join(good(extra), "pattern").groupBy("value").agg(doubt.alias("d")).filter(F.round(1 - F.col("d"), 9) >= ACCEPT).select("value"), "accepted")
        now = accepted.count()
        if now == seen:
            break
        seen, extra = now, unknown.join(accepted, "value").groupBy("pattern").agg(F.count(F.lit(1)).alias("x"))
    open_ = found.filter("NOT known").select("doc_id", "h", "kind", "start", "end", "value", F.explode("patterns").alias("pattern"))
    return open_.join(accepted, "value").join(good(extra).select("pattern"), "pattern").select("doc_id", "h", "kind", "start", "end").distinct()


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of ``docs(doc_id, text)``."""
    d = _texts(docs)
    found = C.cut(mentions(d), "mentions")
    spans = base_spans(d).unionByName(bootstrap(found)).withColumn("s", F.struct("start", "kind", "end"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    per = spans.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("s")).alias("all"), *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(6)])
    per = per.select("doc_id", "h", *[f"n_{k}" for k in KINDS], F.sha2(text(F.filter("all", lambda s: s["kind"] < 4)), 256).alias("base_sha256"), text(F.col("all")).alias("spans"))
    zero = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", "h").join(per, ["doc_id", "h"], "left").select(
        "doc_id", *zero, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
