"""Corpora of real files: numbering over splits, chunk files, one converted file per input."""

import json
import os
import random

from hunch.sources import corpus as K
from hunch.sources import files as FS


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)


def _lines(files, suffix=".jsonl"):
    """(unit, nbytes, line) in order: LF, CRLF and CR end lines; a missing last line end is not counted."""
    out = []
    for name in sorted(files):
        if name.endswith(suffix):
            text = files[name].decode().replace("\r\n", "\n").replace("\r", "\n")
            parts = text.split("\n")
            for i, x in enumerate(parts):
                if i + 1 < len(parts):
                    out.append((name, len(x.encode()) + 1, x))
                elif x:
                    out.append((name, len(x.encode()), x))
    return out


def _corpus(seed=1):
    r = random.Random(seed)
    rec = lambda i: json.dumps({"id": i, "title": f"T{i}", "url": "u", "text": "é" * r.randrange(0, 60) + "x" * r.randrange(0, 300)}, ensure_ascii=False)
    files = {f"f{k}.jsonl": "".join(rec(100 * k + i) + "\n" for i in range(80)).encode() for k in (1, 2, 10)}
    files["f3.jsonl"] = "\r\n".join(rec(300 + i) for i in range(40)).encode() + b"\r\n"
    files["open end.jsonl"] = (rec(500) + "\n" + rec(501)).encode()
    files["broken.jsonl"] = b'{"id": 1, \n\n[1]\n' + rec(7).encode() + b"\n"
    files["empty.jsonl"] = b""
    files["notes.txt"] = b"not a corpus\n"
    return files


def _small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def test_numbers_over_splits(spark, tmp_path):
    files = _corpus()
    _write(tmp_path / "c", files)
    want = [(i + 1, *x) for i, x in enumerate(_lines(files))]
    try:
        for size in ("2k", "700", "1m"):
            _small_splits(spark, size)
            got = FS.read_numbered(spark, str(tmp_path / "c"))
            assert sorted(tuple(r) for r in got.select("line_no", "unit", "nbytes", "value").collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")
    assert FS.read_numbered(spark, str(tmp_path / "none")).count() == 0


def _next_fit(lines, limit):
    chunks, now = [[]], 0
    for unit, n, x in lines:
        if now and now + n > limit:
            chunks.append([])
            now = 0
        now += n
        chunks[-1].append(x)
    return chunks


def test_chunk_files_and_conversion(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "UNIT_BYTES", 1500)  # a unit is written by several tasks
    files = _corpus(2)
    _write(tmp_path / "c", files)
    work = str(tmp_path / "work")
    corpus = FS.prepare_corpus(spark, str(tmp_path / "c"), work, limit=9000)
    want = _next_fit(_lines(files), 9000)
    names = [f"miniCorpus_{i + 1}.jsonl" for i in range(len(want))]
    assert FS.unit_names(spark, f"{work}/chunks") == sorted(names) and len(names) > 3

    def content(folder, name):
        parts = sorted(p for p in os.listdir(f"{folder}/{name}") if p.startswith("part-"))
        return [x for p in parts for x in open(f"{folder}/{name}/{p}", encoding="utf-8", newline="\n").read().split("\n")[:-1]], len(parts)
    several = 0
    for name, lines in zip(names, want, strict=True):
        got, parts = content(f"{work}/chunks", name)
        assert got == lines
        several += parts > 1
    assert several > 1
    total = 0
    for name, lines in zip(names, want, strict=True):
        docs = []
        for x in lines:
            try:
                o = json.loads(x)
            except ValueError:
                continue
            if isinstance(o, dict) and str(o.get("id", "")).strip() and o.get("text"):
                docs.append({"id": str(o["id"]).strip(), "contents": f"{o.get('title', '')}\n{o.get('url', '')}\n{o['text']}"})
        assert [json.loads(x) for x in content(f"{work}/converted", name)[0]] == docs
        total += len(docs)
    assert corpus.count() == total and corpus.columns == ["docid", "contents"]

    # what exists is left alone: only the missing unit is written again
    gone = f"{work}/converted/{names[1]}"
    was = content(f"{work}/converted", names[1])[0]
    kept = {n: os.stat(f"{work}/converted/{n}").st_mtime_ns for n in names if n != names[1]}
    for p in os.listdir(gone):
        os.unlink(f"{gone}/{p}")
    os.rmdir(gone)
    assert FS.convert_files(spark, f"{work}/chunks", f"{work}/converted") == [names[1]]
    assert content(f"{work}/converted", names[1])[0] == was
    assert {n: os.stat(f"{work}/converted/{n}").st_mtime_ns for n in kept} == kept
    assert FS.split_files(spark, str(tmp_path / "c"), f"{work}/chunks", 9000) == FS.convert_files(spark, f"{work}/chunks", f"{work}/converted") == []


def test_sample_mode(spark, tmp_path):
    files = _corpus(3)
    _write(tmp_path / "c", files)
    out = str(tmp_path / "one")
    assert FS.split_files(spark, str(tmp_path / "c"), out, limit=5000, sample=True) == ["miniCorpus_1.jsonl"]
    got = sorted((r["line_no"], r["value"]) for r in FS.read_numbered(spark, out).collect())
    assert [v for _, v in got] == _next_fit(_lines(files), 5000)[0]


def test_line_bytes_of_the_reader_are_kept(spark):
    lines = spark.createDataFrame([(1, 4, "abcd"), (2, 3, "ab")], "line_no long, nbytes long, value string")
    assert [r["nbytes"] for r in K.line_bytes(lines).orderBy("line_no").collect()] == [4, 3]


def test_units_cost_the_driver_few_lookups(spark, tmp_path, monkeypatch):
    """Many units, some without lines: all are there, whole and in order, and no path is looked up for each."""
    looked, path = [], FS._path
    monkeypatch.setattr(FS, "_path", lambda s, p: looked.append(p) or path(s, p))
    rows = spark.createDataFrame([(i % 40, i, f"line {i}") for i in range(400)], "unit_no int, line_no long, value string")
    names = {k: f"u{k:02d}.jsonl" for k in range(43)}
    assert FS.write_units(rows, str(tmp_path / "units"), names, 5000) == [names[k] for k in range(43)]
    assert len(looked) < 10 and sorted(os.listdir(tmp_path / "units")) == sorted(names.values())
    got = FS.read_numbered(spark, str(tmp_path / "units")).orderBy("line_no").collect()
    assert [(r["unit"], r["value"]) for r in got] == [(f"u{k:02d}.jsonl", f"line {i}") for k in range(40) for i in range(k, 400, 40)]
