from pyspark.sql import functions as F

from hunch.llm import common as C
from hunch.llm import decontam as D
from hunch.llm.linededup import line_dedup

from . import util as U

STRIP = " \t\n\x0b\f\r"


def low(s):
    return s.encode().lower().decode()


def brute_lines(texts):
    owner = {}
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        for line in (t or "").split("\n"):
            owner.setdefault(low(line.strip(STRIP)), i)
    out = []
    for i, t in texts:
        if i is not None:
            lines = (t or "").split("\n")
            kept = [x for x in lines if len(k := low(x.strip(STRIP))) < 10 or owner[k] == i]
            out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_line_dedup_matches_brute_force(spark):
    texts = U.odd_texts() + [(50 + i, f"a very common line\nline {i % 4} of a document\n\nown {i} {i}{i}{i}{i}{i}") for i in range(30)]
    want = brute_lines(texts)
    for batches, fanout in ((1, 2), (5, 2), (4, 3)):
        got = sorted(tuple(r) for r in line_dedup(U.docs(spark, texts), batches, fanout).collect())
        assert got == want
    assert line_dedup(U.docs(spark, [])).count() == 0


def tokens(t):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))


def brute_leaks(texts, items, width=10):
    out = []
    for i, t in texts:
        if i is None:
            continue
        w, hit, ids = tokens(t), set(), set()
        for item, text in items:
            v = tokens(text)
            n = min(width, len(v))
            wins = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if n and item is not None else set()
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit.update(range(j, j + n))
                    ids.add(str(item))
        out.append((i, len(w), len(hit), len(ids), sorted(ids)))
    return sorted(out)


def leak_fixture():
    long = U.words(40, 77)
    items = [(1, long), (2, "three word item"), (3, None), (4, ""), (5, "--- !!"), (11, U.words(12, 78)), (2, "three word item"), (None, "own line")]
    w = long.split()
    texts = U.odd_texts() + [(60, "intro " + long + " outro " + long), (61, " ".join(w[5:15])), (62, " ".join(w[5:14]) + " x " + w[14]),
                             (63, "Three, WORD-item! three word item"), (64, U.words(30, 1) + " " + U.words(12, 78) + " three word item")]
    return texts, items


def test_leaks_match_brute_force(spark, monkeypatch):
    C.ship(spark)
    texts, items = leak_fixture()
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id long")
    want = brute_leaks(texts, items)
    got = lambda: sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], list(r["item_ids"])) for r in D.decontaminate(U.docs(spark, texts), table).collect())
    assert got() == want
    monkeypatch.setattr(D, "MAX_WINDOWS", 5)  # several blocks of items
    assert got() == want
    assert D.decontaminate(U.docs(spark, []), table).count() == 0
    assert D.decontaminate(U.docs(spark, texts), table.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_proximity(spark):
    C.ship(spark)
    texts = [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha beta " + "z " * 20 + "gamma"), (4, "alpha beta"), (5, None)]
    index = D.build_index(C.id_text(U.docs(spark, texts)))
    items = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    got = D.proximity_matches(index, items, slop=2).join(D.index_documents(index), ["segment", "ord"]).collect()
    assert sorted((r["doc_id"], list(r["starts"]), list(r["ends"])) for r in got) == [(1, [0], [5]), (2, [0], [3])]
