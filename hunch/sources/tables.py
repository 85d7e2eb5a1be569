"""Readers for the given Parquet tables and the topic/judgement shapes built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin ``df`` over the cores when its scan has fewer splits than there are cores (a
    small table would otherwise be read, and its per-row work done, by a few tasks). What
    counts are splits: a few large files that Parquet cuts into many are left alone."""
    par = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(par * factor) if splits < par else df


def benchmark_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics ``(qid, query)`` from ``benchmark``: one long passage per question."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("qid"), F.col("text").alias("query"))


def conversation_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from the user turns of ``conversations``: ``qid = conv_id-turn``."""
    c = read_table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
        F.col("text").alias("query"))


def _grams(col: str, n: int) -> Column:
    """Distinct runs of ``n`` code points of ``col``; none if it is shorter. Linear in its length: the
    split is bound to a lambda's argument, so it is made once a row and not once a run."""
    if n == 0:
        return F.array(F.lit(""))
    starts = F.sequence(F.lit(0), F.char_length(col) - n)
    runs = F.transform(F.array(F.split(F.col(col), "")), lambda c: F.transform(starts, lambda i: F.concat(*[F.get(c, i + k) for k in range(n)])))
    return F.when(F.char_length(col) >= n, F.array_distinct(F.flatten(runs))).otherwise(F.array().cast("array<string>"))


def trigram_candidates(passages: DataFrame, docs: DataFrame) -> DataFrame:
    """``(qid, passage, docid)``: a superset of the pairs whose text contains the passage, for passages
    ``(qid, passage)`` of any length and texts ``docs(docid, text)``.

    A text that holds a passage holds each of its trigrams (a passage of fewer code points: the
    passage itself), so only the documents with its rarest one are candidates. One scan counts
    the trigrams that passages have, combined map-side; a second emits the chosen ones only, so
    neither a whole trigram index nor a common trigram's documents are ever stored. The chosen
    ones are broadcast if they fit, else frequent ones are salted. A passage with a trigram that no
    document has is in no pair."""
    from ..operators import joins as J

    p = passages.filter("passage IS NOT NULL").withColumn("n", F.least(F.char_length("passage"), F.lit(3)))
    asked = p.select("qid", "passage", F.explode(F.when(F.col("n") == 3, _grams("passage", 3)).otherwise(F.array("passage"))).alias("gram"))
    sizes = sorted(r["n"] for r in p.select("n").distinct().collect())  # at most 0 to 3
    if not sizes:
        return passages.select("qid", "passage", F.lit(None).cast("string").alias("docid")).limit(0)
    shown = docs.filter("text IS NOT NULL").select("docid", F.explode(F.concat(*[_grams("text", n) for n in sizes])).alias("gram"))
    wanted = asked.select("gram").distinct()
    counts = shown.join(F.broadcast(wanted) if J.fits_broadcast(wanted) else wanted, "gram", "left_semi") \
        .groupBy("gram").agg(F.count(F.lit(1)).alias("rows"))
    rarest = asked.join(counts, "gram", "left").groupBy("qid", "passage").agg(
        F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "gram")).alias("r"))
    chosen = cut_lineage(rarest.filter("r.rows > 0").select("qid", "passage", "r.gram", "r.rows"), "rarest-grams")
    side = chosen.select("qid", "passage", "gram")
    if J.fits_broadcast(side):
        return shown.join(F.broadcast(side), "gram").select("qid", "passage", "docid")
    hot = chosen.filter(F.col("rows") > J.HOT_ROWS).select("gram", "rows")
    return J.salted_join(side, shown, "gram", hot).select("qid", "passage", "docid")


def containing(passages: DataFrame, docs: DataFrame, postings: DataFrame | None = None, term_stats: DataFrame | None = None) -> DataFrame:
    """Distinct ``(qid, docid)``: ``docs(docid, text)`` holds the passage of ``passages(qid, passage)`` verbatim.

    Containment is not an equi-join. Every passage is probed through the postings by its
    longest interior non-stop term — a document holding the passage verbatim holds each
    interior word as a whole token, so the probe loses no match. Passages with no such term
    (fewer than three words), or all of them without ``postings``, are probed by their rarest
    trigram. All candidates are verified with ``contains``. A null passage or text is in no pair;
    the empty passage is in every text."""
    from ..functions import text as T
    from ..operators import joins as J

    if postings is None:
        cand = trigram_candidates(passages, docs)
    else:
        toks = T.index_terms("passage")
        interior = F.slice(toks, 2, F.greatest(F.size(toks) - 2, F.lit(0)))
        probe = F.get(F.array_sort(F.transform(interior, lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), 0)["t"]
        bp = passages.withColumn("probe", F.when(F.size(toks) >= 3, probe))
        # A common probe term would put its whole posting list in one task: salt it.
        post = postings.select(F.col("term").alias("probe"), "docid")
        df = term_stats.select(F.col("term").alias("probe"), F.col("df").alias("rows")) if term_stats is not None else post.groupBy("probe").agg(F.count(F.lit(1)).alias("rows"))
        asked = bp.filter(F.col("probe").isNotNull())
        if J.fits_broadcast(asked):  # the postings stay where they are
            by_term = post.join(F.broadcast(asked), "probe")
        else:
            by_term = J.salted_join(asked, post, "probe", df.filter(F.col("rows") > J.HOT_ROWS))
        short = cut_lineage(bp.filter(F.col("probe").isNull()).select("qid", "passage"), "short-passages")
        cand = by_term.select("qid", "passage", "docid")
        if not short.isEmpty():
            cand = cand.unionByName(trigram_candidates(short, docs))
    cand = cut_lineage(cand, "containment-candidates")
    # a scan of the texts meets the candidates where they fit, so that no text moves
    return J.small(cand).join(docs, "docid").filter(F.col("text").contains(F.col("passage"))).select("qid", "docid").distinct()


def passage_judgements(spark: SparkSession, sf_dir: str, postings: DataFrame | None = None, term_stats: DataFrame | None = None) -> DataFrame:
    """Judgements ``(qid, docid, rel)``: a document is relevant to a passage topic when
    it contains the passage verbatim (see ``containing``)."""
    b = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("qid"), F.col("text").alias("passage"))
    d = spread(read_table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("docid"), F.col("text"))
    return containing(b, d, postings, term_stats).select("qid", "docid", F.lit(1).alias("rel"))
