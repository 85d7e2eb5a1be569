"""Annotations are made in the question's row: no exchange of tokens for those who read tags and spans."""

from hunch.operators import annotate as A
from hunch.operators import decompose as D


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_spans_and_words_move_once(spark):
    topics = spark.createDataFrame([("a", "Anna Lee saw a film in 1994. He ran.")], "qid string, query string")
    ann = A.annotate(topics)
    assert _exchanges(ann.select("qid", "tok_i", "text", "lemma", "pos", "ent_id", "ent_label")) == 0
    assert _exchanges(D.entity_spans(ann)) == 1 and _exchanges(D.media_types(ann)) == 1
    assert {(r.ent_text, r.ent_label) for r in D.entity_spans(ann).collect()} == {("Anna Lee", "PERSON"), ("1994", "DATE")}


def test_rows_of_one_id_are_one_question(spark):
    text = "Anna Lee ran"
    topics = spark.createDataFrame([("a", text), ("a", text), (None, "b c"), (None, "b c"), ("n", None), ("e", "")], "qid string, query string")
    rows = A.annotate(topics).collect()
    assert [r.text for r in sorted((r for r in rows if r.qid == "a"), key=lambda r: r.tok_i)] == ["Anna", "Anna", "Lee", "Lee", "ran", "ran"]
    assert sorted((r.tok_i, r.text) for r in rows if r.qid is None) == [(0, "b"), (1, "b"), (2, "c"), (3, "c")]
    assert {r.qid for r in rows} == {"a", None}
    assert [r.ent_text for r in D.entity_spans(A.annotate(topics)).collect()] == ["Anna Anna Lee Lee"]


def test_long_sentence_stays_linear(spark):
    words = ["Anna" if i % 3 else "house" for i in range(60_000)]
    topics = spark.createDataFrame([("a", " ".join(words))], "qid string, query string")
    ann = A.annotate(topics).select("qid", "tok_i", "text", "pos", "ent_id", "ent_label")
    assert D.entity_spans(ann).count() == 20_000


def test_every_relative_clause_of_a_question(spark):
    text = "where the big house runs who sings where houses fall where the who ran. Who runs?"
    tags = [("where", "SCONJ"), ("the", "DET"), ("house", "NOUN"), ("dog", "NOUN"), ("runs", "VERB"), ("who", "PRON"), ("sings", "VERB"),
            ("where", "SCONJ"), ("dogs", "NOUN"), ("x", "ADJ"), ("where", "SCONJ"), ("the", "DET"), ("Who", "PRON"), ("ran", "VERB")]
    ann = spark.createDataFrame([("a", 0, i, t, p) for i, (t, p) in enumerate(tags)] + [("b", 0, 0, "runs", "VERB")],
                                "qid string, sent_i int, tok_i int, text string, pos string")
    sents = spark.createDataFrame([("a", 0, text), ("b", 0, "runs")], "qid string, sent_i int, sent string")
    got = D.relative_clauses(ann, sents).collect()
    assert sorted((r.qid, r.tok_i, r.clause) for r in got) == [("a", 0, text), ("a", 5, text), ("a", 12, text)]
