"""Topic and judgement files, strict parsing, the split and the subtree walk on hand-made input."""

from pyspark.sql import functions as F

from hunch.operators import decompose as D
from hunch.sources import corpus as K
from hunch.sources import topics as TP


def test_flat_files_are_units(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "r").mkdir()
    (tmp_path / "q" / "a.jsonl").write_text('{"query_id": "1", "query": "old"}\n{"query_id": "1", "query": "first"}\n')
    (tmp_path / "q" / "b.jsonl").write_text('{"query_id": "1", "query": "second"}\n')
    (tmp_path / "r" / "a.txt").write_text("1 0 d1 1\n")
    (tmp_path / "r" / "b.txt").write_text("\t1 0 d2 1\n1 0 d3\n")
    t = TP.read_topics(spark, str(tmp_path / "q"))
    assert sorted(r["query"] for r in t.collect()) == ["first", "second"]
    q = TP.read_qrels(spark, str(tmp_path / "r"))
    got = sorted(tuple(r) for r in TP.pair_files(t, q).collect())
    assert got == [(1, "1", "d1"), (2, "1", "d2")]


def test_strict_lines(spark):
    good = ['{"id": 1, "text": "x"}', '  {"id": "2", "text": "y", "n": [1, {"a": "}"}]}  ']
    bad = ["{'id': 1, 'text': 'x'}", '{"id": 2, "text": "x"} junk', '{"id": 2, "text": "x"}}', '{"id": 1},{"id": 2}', "", "null", "[1]", '"s"', '{"id": 1, "text": ',
           '{"id": 1, "text": "x"}]']
    lines = spark.createDataFrame([(x,) for x in good + bad], "value string")
    assert sorted(r["id"] for r in K.parse_raw(lines).collect()) == ["1", "2"]
    ids = spark.createDataFrame([("\t", "x"), (" 7\n", "x"), (None, "x"), ("8", "")], "id string, text string").withColumns({"title": F.lit(None), "url": F.lit("u")})
    assert [r["id"] for r in K.convert(ids).collect()] == ["7"]


def test_subtree_of_any_depth(spark):
    n = 60
    rows = [("a", 0, 0, "ROOT", "t0")] + [("a", i, i - 1, "prep" if i == 1 else "pobj", f"t{i}") for i in range(1, n)]
    rows += [("b", 10, 11, "x", "u"), ("b", 11, 11, "prep", "v"), ("b", 14, 10, "x", "w"), ("c", 0, 1, "prep", "p"), ("c", 1, 0, "x", "q")]
    ann = spark.createDataFrame(rows, "qid string, tok_i int, head_i int, dep string, text string")
    got = {(r["qid"], r["prep_i"]): (r["head_i"], r["phrase"]) for r in D.subtree_phrases(ann).collect()}
    assert got[("a", 1)] == (0, " ".join(f"t{i}" for i in range(1, n)))
    assert got[("b", 11)] == (11, "u v w")       # gaps in the numbering
    assert got[("c", 0)] == (1, "p q")           # a cycle of heads ends


def test_split_in_order_of_lines(spark):
    sizes = [5, 100, 3, 3, 3, 40, 41, 1, 1, 1, 99, 2]
    lines = spark.createDataFrame([(i, "x" * (s - 1)) for i, s in enumerate(sizes)], "line_no long, value string")
    want, now, chunk = [], 0, 1
    for i, s in enumerate(sizes):
        if now and now + s > 45:
            chunk, now = chunk + 1, 0
        now += s
        want.append((i, chunk))
    got = K.next_fit_chunks(lines, 45)
    assert sorted((r["line_no"], r["chunk_no"]) for r in got.collect()) == want
    assert K.next_fit_chunks(lines.limit(0), 45).count() == 0
    assert [r["line_no"] for r in K.first_chunk(lines, 45).collect()] == [i for i, c in want if c == 1]
