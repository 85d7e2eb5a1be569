"""Phrase spans: leftmost-longest among overlaps, and their place in the annotations."""

import itertools
import random

from hunch.operators import annotate as A
from hunch.operators import gazetteer as G


def greedy(words, table):
    out, i = [], 0
    while i < len(words):
        n = max((len(p) for p in table if tuple(words[i:i + len(p)]) == p), default=0)
        if n:
            out.append((i, i + n, table[tuple(words[i:i + n])]))
        i += n or 1
    return out


def test_leftmost_longest_against_a_scan(spark):
    r = random.Random(5)
    every = [p for n in (1, 2, 3, 5) for p in itertools.product("abc", repeat=n)]
    table = {p: r.choice(["GPE", "ORG", "WORK_OF_ART"]) for p in r.sample(every, 60) if len(p) > 1}
    sents = [(f"q{i}", i % 2, " ".join(r.choice("abcABCx") for _ in range(r.randrange(0, 60)))) for i in range(40)]
    odd = [(None, "GPE"), ("", "ORG"), ("a b", None)]
    phrases = spark.createDataFrame([(" ".join(p).upper(), x) for p, x in table.items()] + odd, "phrase string, label string")
    got = G.phrase_spans(spark.createDataFrame(sents + [("n", 0, None)], "qid string, sent_i int, sent string"), phrases).collect()
    want = {(q, s, a, b, label) for q, s, x in sents for a, b, label in greedy(x.lower().split(), table)}
    assert {(x.qid, x.sent_i, x.start, x.end, x.label) for x in got} == want and len(got) == len(want) > 100
    assert G.phrase_spans(spark.createDataFrame(sents, "qid string, sent_i int, sent string"), phrases.limit(0)).count() == 0


def test_phrases_come_before_rules(spark):
    topics = spark.createDataFrame([("1", "We saw Harry Stone Miller in gone with the wind. Later Mary Jones left.")], "qid string, query string")
    phrases = spark.createDataFrame([("Stone Miller", "ORG"), ("gone with the wind", "WORK_OF_ART"), ("the wind", "GPE")], "phrase string, label string")
    got = [(x.text, x.ent_label, x.ent_id) for x in A.annotate(topics, phrases=phrases).orderBy("tok_i").collect() if x.ent_label]
    assert got == [("Stone", "ORG", 3), ("Miller", "ORG", 3), ("gone", "WORK_OF_ART", 6), ("with", "WORK_OF_ART", 6), ("the", "WORK_OF_ART", 6),
                   ("wind", "WORK_OF_ART", 6), ("Mary", "PERSON", 12), ("Jones", "PERSON", 12)]


def test_small_and_large_tables_agree(spark, monkeypatch):
    """Phrases in the plan or by join: the same spans; with a small table, only its n-grams become rows."""
    r = random.Random(6)
    sents = spark.createDataFrame([(f"q{i % 25}", 0, " ".join(r.choice("abcdeA'é.") for _ in range(r.randrange(0, 90)))) for i in range(30)] + [("n", 1, None), ("e", 1, "")],
                                  "qid string, sent_i int, sent string")
    phrases = spark.createDataFrame([(" ".join(r.choice("abcde") for _ in range(n)), x) for n in (1, 2, 2, 3, 3, 7) for x in ("GPE", "ORG")], "phrase string, label string")
    few = sorted(map(tuple, G.phrase_spans(sents, phrases).collect()))
    monkeypatch.setattr(G, "LITERAL_PHRASES", 3)
    many = sorted(map(tuple, G.phrase_spans(sents, phrases).collect()))
    assert few == many and len(few) > 50
    words = spark.createDataFrame([(list("abcab") * 40,)], "words array<string>")
    table = G._table([{"n": 2, "phrase": "b c"}, {"n": 3, "phrase": "a b x"}])
    got = words.select(G.F.inline(G._grams(G.F.col("words"), [2, 3], table))).collect()
    assert [(x.start, x.n, x.phrase) for x in got] == [(5 * i + 1, 2, "b c") for i in range(40)]
