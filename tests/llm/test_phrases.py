import random
import re
from collections import Counter

from hunch.llm import common as C
from hunch.llm import phrases as P

from . import util as U


def brute(rows, min_count=30, longest=4, top=2000, inside=(80, 100)):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = []
    for (lang, p), a in cand.items():
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        longer = [b for (la, q), b in cand.items() if la == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if not any(inside[1] * b >= inside[0] * a for b in longer):
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in n:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(best)]
    return sorted(ranked)


def rows(texts):
    return [(r[2], r[1]) for r in U.rows(texts)]


def mined(spark, texts, **how):
    return sorted(tuple(r) for r in P.collocations(U.docs(spark, texts), **how).collect())


def texts():
    r = random.Random(12)
    some = [f"w{i}" for i in range(9)]
    out = [(i, "".join(r.choice(some) + r.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", " \xa0"]) for _ in range(r.randrange(0, 40)))) for i in range(150)]
    return out + [(500 + i, f"Common PHRASE of all {r.choice(some)}") for i in range(60)] + U.odd_texts() + [(900, "same same same same same " * 40)]


def test_matches_brute_force(spark):
    C.ship(spark)
    t = texts()
    for how in ({"min_count": 5}, {"min_count": 12, "longest": 3}, {"min_count": 3, "longest": 2, "top": 7}, {"min_count": 4, "longest": 5, "inside": (50, 100)}):
        assert mined(spark, t, **how) == brute(rows(t), **how)
    assert mined(spark, []) == mined(spark, [(1, None), (None, ""), (2, " . ")]) == []


def test_salted_heads(spark):
    """Two words that open thousands of windows of a slice, beside slices where they are rare."""
    C.ship(spark)
    t = [(1, " ".join(f"of the u{i % 2900} v{i % 7}." for i in range(6000)))] + [(i, f"of the u{i} v{i % 7}") for i in range(2, 60)]
    t += [(9000 + i, f"of the u{i % 40}\x01 v. of the\x01 u{i % 3} of") for i in range(90)]
    want = brute(rows(t), 4)
    assert mined(spark, t, min_count=4) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)  # prefixes go on from batch to batch
    try:
        assert mined(spark, t, min_count=4) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_counts(spark, monkeypatch):
    """Scores are exact where products pass 64 bits."""
    C.ship(spark)
    big = 9 * 10 ** 17
    found = spark.createDataFrame([("en", "", 0, 10 * big), ("en", "a", 1, 3 * big + 1), ("en", "b", 1, 4 * big), ("en", "a b", 2, big + 7)], "lang string, phrase string, size int, f long")
    monkeypatch.setattr(P, "phrase_counts", lambda *a: found)
    assert mined(spark, []) == [("en", 1, "a b", big + 7, 3 * big + 1, 4 * big, 10 * big, 2000000 * (big + 7) // (7 * big + 1))]
