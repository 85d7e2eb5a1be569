"""Decomposition rules on the hand-annotated fixture sentence (FIXTURES F6)."""

from pyspark.sql import functions as F

from hunch.operators import annotate as A
from hunch.operators import decompose as D

Q = "George Clooney movie where a woman witnesses a murder through the window and he goes to trial"

# (tok_i, text, pos, head_i, dep, lemma); PERSON span = tokens 0-1
F6 = [
    (0, "George", "PROPN", 1, "compound", "george"), (1, "Clooney", "PROPN", 2, "compound", "clooney"),
    (2, "movie", "NOUN", 2, "ROOT", "movie"), (3, "where", "SCONJ", 6, "advmod", "where"),
    (4, "a", "DET", 5, "det", "a"), (5, "woman", "NOUN", 6, "nsubj", "woman"),
    (6, "witnesses", "VERB", 2, "relcl", "witness"), (7, "a", "DET", 8, "det", "a"),
    (8, "murder", "NOUN", 6, "dobj", "murder"), (9, "through", "ADP", 6, "prep", "through"),
    (10, "the", "DET", 11, "det", "the"), (11, "window", "NOUN", 9, "pobj", "window"),
    (12, "and", "CCONJ", 6, "cc", "and"), (13, "he", "PRON", 14, "nsubj", "he"),
    (14, "goes", "VERB", 6, "conj", "go"), (15, "to", "ADP", 14, "prep", "to"),
    (16, "trial", "NOUN", 15, "pobj", "trial"),
]
CHUNKS = {0: 0, 1: 0, 2: 0, 4: 4, 5: 4, 7: 7, 8: 7, 10: 10, 11: 10, 16: 16}
ROOTS = {2, 5, 8, 11, 16}


def fixture_tables(spark):
    rows = []
    for i, text, pos, head, dep, lemma in F6:
        ent = "PERSON" if i in (0, 1) else None
        rows.append(("f6", 0, i, text, lemma, pos, dep, head, ent, 0 if ent else None, ent,
                     CHUNKS.get(i), i in ROOTS))
    ann = spark.createDataFrame(rows, "qid string, sent_i int, tok_i int, text string, lemma string, pos string, "
                                      "dep string, head_i int, ent_type string, ent_id int, ent_label string, "
                                      "chunk_id int, is_chunk_root boolean")
    topics = spark.createDataFrame([("f6", Q)], "qid string, query string")
    sents = spark.createDataFrame([("f6", 0, Q)], "qid string, sent_i int, sent string")
    return topics, ann, sents


def test_f6_v2(spark):
    topics, ann, sents = fixture_tables(spark)
    r = D.decompose(topics, ann, sents).first()
    assert r["media_type"] == ["movie"]
    assert r["entities"] == ["George Clooney"]
    assert r["descriptions"] == ["george clooney movie", "woman go", "woman witness murder"]
    ev = [(e["subject"], e["verb"], e["object"], list(e["prep_phrases"]), e["negated"]) for e in r["events"]]
    assert ev == [("woman", "witness", "murder", ["through the window"], False),
                  ("woman", "go", None, ["to trial"], False)]


def test_f6_v1(spark):
    topics, ann, sents = fixture_tables(spark)
    r = D.decompose_v1(topics, ann).first()
    assert r["entities"] == ["George Clooney"]
    assert r["descriptions"] == ["George Clooney movie", "a murder", "a woman", "the window", "woman witnesses murder"]


def test_f6_relative_clause_too_long(spark):
    topics, ann, sents = fixture_tables(spark)
    rel = D.relative_clauses(ann, sents).collect()
    assert [r["clause"] for r in rel] == [Q]          # matched, but 17 words > 10 later


def test_entity_clean_modes(spark):
    df = spark.createDataFrame([(["George Clooney movie"], ["Anna Lee", "Anna Lee Ray"], ["Alien movie"])],
                               "a array<string>, b array<string>, c array<string>")
    r = df.select(D.clean_entities_v1(F.col("a"), "compat").alias("compat"),
                  D.clean_entities_v1(F.col("a"), "fixed").alias("fixed"),
                  D.clean_entities_v1(F.col("b"), "fixed").alias("sub"),
                  D.clean_entities_v2(F.col("c"), F.array(F.lit("Alien")), "compat").alias("v2")).first()
    assert r["compat"] == [] and r["fixed"] == ["George Clooney"]
    assert r["sub"] == ["Anna Lee Ray"] and r["v2"] == ["Alien"]


def test_annotator_matches_fixture_shape(spark):
    topics = spark.createDataFrame([("f6", Q)], "qid string, query string")
    ann = A.annotate(topics)
    got = {r["tok_i"]: (r["pos"], r["dep"], r["head_i"]) for r in ann.collect()}
    assert got[5] == ("NOUN", "nsubj", 6) and got[8] == ("NOUN", "dobj", 6)
    assert got[9] == ("ADP", "prep", 6) and got[11] == ("NOUN", "pobj", 9)
    assert got[13] == ("PRON", "nsubj", 14) and got[6][0] == "VERB" and got[14][0] == "VERB"
    sents = A.sentences(topics)
    r = D.decompose(topics, ann, sents).first()
    assert r["entities"] == ["George Clooney"]
    assert r["descriptions"] == ["george clooney movie", "woman go", "woman witness murder"]


def test_subqueries_keep_first(spark):
    df = spark.createDataFrame([("q", "red car", ["Red Car"], [], ["red car"], [])],
                               "qid string, norm_query string, entities array<string>, time array<string>, "
                               "descriptions array<string>, media_type array<string>")
    rows = sorted((r["sub_ord"], r["text"]) for r in D.subqueries(df).collect())
    assert rows == [(1, "red car"), (2, "Red Car")]
