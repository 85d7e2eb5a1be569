import zlib

import corpus_pipeline as P
from hunch.llm import langid as L
from hunch.llm.linededup import line_dedup  # noqa: F401

from . import util as U
from .test_jaccard import brute
from .test_lines_leaks import brute_leaks, brute_lines, leak_fixture

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_match_brute_force(spark, tmp_path):
    """Every stage over all rows of its predecessor, against plain Python; then the whole run."""
    texts, items = leak_fixture()
    texts = [(i, t) for i, t in dict(texts).items()] + [(90, "12 34"), (91, "kept words of a clean document and some more words")]
    U.docs(spark, texts).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    now = {i: t for i, t in texts if i is not None and any(c.isalpha() for c in t or "")}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "lines":
            now = {i: t for i, n, gone, t in brute_lines(list(now.items())) if gone < n and t.strip(" \t\n\x0b\f\r")}
        elif name == "near_duplicates":
            now = {i: now[i] for i, (_, c) in brute(list(now.items()), 5, 80, 100).items() if i == c}
        elif name == "benchmark_leaks":
            now = {i: now[i] for i, _, hit, _, _ in brute_leaks(list(now.items()), items) if not hit}
        if name != "packing":
            assert docs.columns == COLUMNS
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == now, name
    assert {r["doc_id"] for r in docs.collect()} == set(now) and {7, 91} <= set(now)
    whole = P.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, docs.drop("sequence_id", "offset").collect()))
    assert L.SAMPLE_ROWS >= 1000


def test_language_without_a_model(spark):
    """No labelled row, or only held-out ones: documents with a letter stay, with the language they had."""
    from hunch.llm import stages as S
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    for label in (None, "en"):
        rows = [(held, "some words", label, "s", 10), (200, "other words", None, "s", 11), (201, "12 34", None, "s", 5), (202, None, None, "s", None)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        assert sorted(map(tuple, S.language(spark, docs, "").collect())) == sorted(map(tuple, rows[:2]))


def test_repeated_ids_nulls_and_empty_tables(spark, tmp_path):
    """Two rows of one id keep their own texts; stages pass on extra columns, null texts and empty tables."""
    from hunch.llm import stages as S
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string"
    rows = [(1, "first text of one\nshared line here", "en", "s", 1, "k"), (1, "second text of one", "en", "s", 1, "k"), (2, "shared line here\nown text of two", "en", "s", 1, "k"), (3, None, None, None, None, None)]
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/some")
    docs = spark.read.parquet(f"{tmp_path}/some")
    assert sorted(r["text"] for r in S.lines(spark, docs, str(tmp_path)).collect()) == ["first text of one\nshared line here", "own text of two", "second text of one"]
    assert S.near_duplicates(spark, docs, str(tmp_path)).count() == S.benchmark_leaks(spark, docs, str(tmp_path)).count() == 4
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none")
    none = spark.read.parquet(f"{tmp_path}/none")
    for name, stage in P.STAGES:
        out = stage(spark, none, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == none.columns)


def test_stages_delete_their_working_tables(spark, tmp_path):
    import os

    from hunch.session import app_scratch
    texts, items = leak_fixture()
    U.docs(spark, texts[:20]).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    P.run(spark, str(tmp_path))
    before = set(os.listdir(app_scratch(spark)))
    out = P.run(spark, str(tmp_path))
    assert out.count() > 0 and {x.rsplit("-", 1)[0] for x in set(os.listdir(app_scratch(spark))) - before} == {"stage-packing"}


def test_contract():
    import __spark_entry__ as E
    q = E.queries()
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11))
