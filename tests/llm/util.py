"""Fixtures of odd rows and plain reference computations for the llm operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rank int, h long, size string, pos int, rep long"


def rows(texts):
    """(id, text) pairs as document rows with extra columns whose names clash with internal ones."""
    return [(i, t, None if t is None or i is None else ["en", "de", None][i % 3], "s", len(t or ""), "k", 1, 2, "z", 3, 4) for i, t in texts]


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    base = words(120, 1)
    many = base.split()
    near = many[:]
    near[60] = "changed"
    out = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, "one  TWO"), (9, "zażółć gęślą jaźń — 日本語"),
           (10, words(30_000, 2)), (11, base.upper()), (12, base + "\n" + base), (13, "A shared line of text\nown line thirteen"),
           (14, "  a SHARED line of text \nown line fourteen\n"), (15, "\n".join(["short"] * 5)), (1, base), (None, base), (None, None), (16, "x\x00y \x0b z")]
    return out


def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def variants(n, seed=5, size=100):
    """Variants of one text that differ from it, and so from each other, by a few words: some link."""
    r = random.Random(seed)
    base = words(size, seed).split()
    out = []
    for i in range(n):
        w = base[:]
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(size)] = f"v{r.randrange(60)}"
        out.append((100 + i, " ".join(w)))
    return out
