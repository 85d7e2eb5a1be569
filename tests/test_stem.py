"""The Porter stemmer on the examples of its paper; the analyser's choice reaches the search."""

import duckdb

from hunch.operators import index as X
from hunch.operators import rank as R
from hunch.operators import stem as S
from hunch.session import fresh_path

# FIXED VALUES: word and stem pairs of the published algorithm
PAIRS = dict(x.split(":") for x in """caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster
bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss
fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration valenci:valenc
hesitanci:hesit digitizer:digit conformabli:conform radicalli:radic differentli:differ vileli:vile analogousli:analog
vietnamization:vietnam predication:predic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope callousness:callous
formaliti:formal sensitiviti:sensit sensibiliti:sensibl triplicate:triplic formative:form formalize:formal electriciti:electr
electrical:electr hopeful:hope goodness:good revival:reviv allowance:allow inference:infer airliner:airlin gyroscopic:gyroscop
adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust dependent:depend adoption:adopt
homologou:homolog communism:commun activate:activ angulariti:angular homologous:homolog effective:effect bowdlerize:bowdler
probate:probat rate:rate cease:ceas controll:control roll:roll is:is by:by yes:ye""".split())


def test_porter_pairs_in_both_engines(spark):
    df = spark.createDataFrame([(w,) for w in PAIRS], "w string")
    assert {r["w"]: r["s"] for r in df.select("w", S.porter_stem(df["w"]).alias("s")).collect()} == PAIRS
    values = ", ".join(f"('{w}')" for w in PAIRS)
    assert dict(duckdb.connect().execute(f"SELECT w, {S.porter_sql('w')} FROM (VALUES {values}) t(w)").fetchall()) == PAIRS


def test_search_stems_as_the_index_was(spark):
    corpus = spark.createDataFrame([("d1", "hopping rabbits"), ("d2", "motoring cats")], "docid string, contents string")
    idx = X.build_index(spark, corpus, fresh_path(spark, "t-porter"), stemmer="porter")
    assert idx.stemmer == "porter"
    q = spark.createDataFrame([("q", 1, "hopped cat")], "qid string, sub_ord int, text string")
    assert {r["docid"] for r in R.bm25_search(q, idx).collect()} == {"d1", "d2"}


def test_vocabulary_job_routes_agree(spark, monkeypatch):
    """Stems looked up per distinct term give the rows that stemming every token would, broadcast or joined."""
    from pyspark.sql import functions as F

    from hunch.operators import joins as J

    from .conftest import SF_SMALL
    corpus = X.corpus_from_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    tokens = X.analysed(corpus)
    every = tokens.select("docid", F.posexplode("toks").alias("pos", "term")).withColumn("term", S.porter_stem(F.col("term")))
    want = {(r["term"], r["docid"]): tuple(r["p"]) for r in every.groupBy("term", "docid").agg(F.sort_array(F.collect_list("pos")).alias("p")).collect()}
    a = X.build_index(spark, corpus, fresh_path(spark, "t-stems"), stemmer="porter")
    rows = lambda idx: {(r["term"], r["docid"]): tuple(r["positions"]) for r in idx.postings.collect()}
    assert rows(a) == want
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(J, "HOT_ROWS", 50)
    b = X.build_index(spark, corpus, fresh_path(spark, "t-stems-joined"), stemmer="porter")
    assert rows(b) == want
