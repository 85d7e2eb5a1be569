"""Folders of query files against folders of judgement files, and the file of display lines."""

import glob

from hunch.operators import index as X
from hunch.plans.file_runs import run_files
from hunch.session import fresh_path
from hunch.sources import sinks
from hunch.sources import topics as TP


def test_equal_ids_in_two_files_stay_apart(spark, tmp_path):
    corpus = spark.createDataFrame([("d1", "Red kite\nA red kite circles over the harbour."), ("d2", "Old mill\nThe old mill grinds barley."),
                                    ("d3", "Night train\nA night train leaves the valley.")], "docid string, contents string")
    idx = X.build_index(spark, corpus, fresh_path(spark, "t-runs"))
    q, r = tmp_path / "q", tmp_path / "r"
    q.mkdir()
    r.mkdir()
    (q / "a.jsonl").write_text('{"query_id": "1", "query": "kite circles harbour"}\n{"query_id": "2:x", "query": "mill grinds barley"}\n')
    (q / "b.jsonl").write_text('{"query_id": "1", "query": "train leaves valley"}\n{"query_id": "2:x", "query": "kite circles harbour"}\n{"query_id": "3", "query": "barley"}\n')
    (q / "c.jsonl").write_text('{"query_id": "1", "query": "a file without a partner"}\n')
    (r / "a.txt").write_text("1 0 d1 1\n2:x 0 d2 1\n")
    (r / "b.txt").write_text("1 0 d3 1\n2:x 0 d2 1\n9 0 d1 1\n")
    out = run_files(TP.read_topics(spark, str(q)), TP.read_qrels(spark, str(r)), idx)
    assert sorted(map(tuple, out["found"].collect()), key=lambda x: x[:2]) == [
        (1, "1", "d1", 1), (1, "2:x", "d2", 1), (2, "1", "d3", 1), (2, "2:x", "d2", None), (2, "3", None, None)]
    assert {tuple(x) for x in out["accuracy"].collect()} == {(1, 2, 2, 100.0), (2, 1, 2, 50.0), (None, 3, 4, 75.0)}
    first = {(x["file_pos"], x["qid"]): x["docid"] for x in out["results"].filter("rank = 1").collect()}
    assert first == {(1, "1"): "d1", (1, "2:x"): "d2", (2, "1"): "d3", (2, "2:x"): "d1", (2, "3"): "d2"}
    none = run_files(TP.read_topics(spark, str(q)), TP.read_qrels(spark, str(r), glob="none*"), idx)
    assert none["found"].count() == 0


def test_display_lines_in_order(spark, tmp_path):
    rows = [(f"q{i % 3}", i // 3 + 1, f"d{i}", "0.0100", f"title {i}", None if i == 4 else f"text **{i}**") for i in range(60)]
    results = spark.createDataFrame(rows, "qid string, rank int, docid string, score_text string, title string, snippet string").repartition(7)
    path = str(tmp_path / "lines")
    sinks.write_result_lines(results, path)
    lines = "".join(open(p).read() for p in sorted(glob.glob(path + "/part-*"))).splitlines()
    want = [x for r in sorted(rows) for x in (f"Rank {r[1]} | DocID: {r[2]} | Score: {r[3]}", f"Title: {r[4]}", f"Snippet: {r[5] or ''}")]
    assert lines == want
