"""Queries for corpus preparation (S01-S07, P01-P07) over ``pages``, ``events`` and
``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import fresh_path
from ..sources import corpus as K
from ..sources import files as FS
from ..sources.tables import read_table
from .registry import register

# The split is run with a chunk limit chosen so the test corpora produce several
# chunks (the reference's default is 1 GiB; the limit is the function's parameter).
SPLIT_LIMIT = 200_000

_CONTENTS_SQL = r"""
WITH raw AS (SELECT CAST(page_id AS VARCHAR) AS id, url, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
                    html AS text FROM pages),
conv AS (SELECT trim(id) AS id, coalesce(title, '') || chr(10) || coalesce(url, '') || chr(10) || text AS contents
         FROM raw WHERE trim(id) <> '' AND text IS NOT NULL AND text <> '')
SELECT id, contents, split_part(contents, chr(10), 1) AS title FROM conv"""


@register("corpus_contents", _CONTENTS_SQL)
def corpus_contents(spark, sf_dir):
    """Raw page records to ``(id, contents)`` and the displayed title."""
    conv = K.convert(K.pages_as_raw(read_table(spark, sf_dir, "pages")))
    return conv.select("id", "contents", T.title_of("contents").alias("title"))


def _event_lines_spark(ev):
    eid = F.col("event_id")
    good = F.to_json(F.struct(eid.alias("id"), F.col("event_type").alias("url"), F.col("props").alias("text")))
    no_text = F.to_json(F.struct(eid.alias("id"), F.col("event_type").alias("url")))
    value = (F.when(eid % 7 == 0, F.concat(F.lit('{"id": '), eid.cast("string"), F.lit(', "text": ')))
             .when(eid % 11 == 0, no_text)
             .when(eid % 13 == 0, F.lit(""))
             .when(eid % 17 == 0, F.lit("[1]"))
             .when(eid % 19 == 0, F.concat(F.lit("{'id': "), eid.cast("string"), F.lit(", 'text': 'x'}")))
             .when(eid % 23 == 0, F.concat(good, F.lit(" junk")))
             .when(eid % 29 == 0, F.lit('{"id": "\\t", "text": "x"}'))
             .otherwise(good))
    return ev.select(value.alias("value"))


_EVENT_LINES_SQL = """
lines AS (SELECT CASE WHEN event_id % 7 = 0 THEN '{"id": ' || CAST(event_id AS VARCHAR) || ', "text": '
                      WHEN event_id % 11 = 0 THEN json_object('id', event_id, 'url', event_type)::VARCHAR
                      WHEN event_id % 13 = 0 THEN ''
                      WHEN event_id % 17 = 0 THEN '[1]'
                      WHEN event_id % 19 = 0 THEN '{''id'': ' || CAST(event_id AS VARCHAR) || ', ''text'': ''x''}'
                      WHEN event_id % 23 = 0 THEN json_object('id', event_id, 'url', event_type, 'text', props)::VARCHAR || ' junk'
                      WHEN event_id % 29 = 0 THEN '{"id": "\\t", "text": "x"}'
                      ELSE json_object('id', event_id, 'url', event_type, 'text', props)::VARCHAR END AS value
          FROM events)"""

_PARSE_SQL = f"""WITH {_EVENT_LINES_SQL},
ok AS (SELECT json_extract_string(value, '$.id') AS id, json_extract_string(value, '$.url') AS url,
              json_extract_string(value, '$.title') AS title, json_extract_string(value, '$.text') AS text
       FROM lines WHERE json_valid(value) AND json_type(value) = 'OBJECT')
SELECT trim(id, ' ' || chr(9) || chr(10) || chr(13)) AS id, coalesce(title, '') || chr(10) || coalesce(url, '') || chr(10) || text AS contents
FROM ok WHERE trim(id, ' ' || chr(9) || chr(10) || chr(13)) <> '' AND text IS NOT NULL AND text <> ''"""


@register("corpus_tolerant_parse", _PARSE_SQL)
def corpus_tolerant_parse(spark, sf_dir):
    """S03 + P01-P03 over event records written as raw corpus lines, some of them spoiled
    on purpose (cut-off JSON, no text, blank, not an object) — every row is processed."""
    lines = _event_lines_spark(read_table(spark, sf_dir, "events"))
    return K.convert(K.parse_raw(lines))


_ROUNDTRIP_SQL = """SELECT CAST(doc_id AS VARCHAR) AS id, text AS contents FROM documents
WHERE text IS NOT NULL AND text <> ''"""


@register("corpus_jsonl_roundtrip", _ROUNDTRIP_SQL)
def corpus_jsonl_roundtrip(spark, sf_dir):
    """S05/S06 then S01/S02: converted documents written as JSON lines to the shared
    folder (skipped if present) and read back."""
    d = read_table(spark, sf_dir, "documents")
    conv = d.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("contents")) \
        .filter(F.col("contents").isNotNull() & (F.col("contents") != ""))
    return K.write_and_read_converted(spark, conv)


_LINES_SQL = """lines AS (SELECT doc_id AS line_no, (strlen(json_object('id', doc_id, 'text', text)::VARCHAR) + 1)::BIGINT AS nbytes
          FROM documents)"""


@register("corpus_line_bytes", f"WITH {_LINES_SQL} SELECT line_no, nbytes FROM lines")
def corpus_line_bytes(spark, sf_dir):
    """UTF-8 bytes (with newline) of every raw corpus line."""
    return K.line_bytes(K.raw_lines_from_documents(read_table(spark, sf_dir, "documents"))).select("line_no", "nbytes")


_WALK_SQL = f"""WITH RECURSIVE {_LINES_SQL},
ordered AS (SELECT line_no, nbytes, row_number() OVER (ORDER BY line_no) AS i,
                   (sum(nbytes) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS en FROM lines),
walk(i, chunk_no, cur) AS (
    SELECT i, 1, nbytes FROM ordered WHERE i = 1
    UNION ALL
    SELECT o.i,
           CASE WHEN w.cur + o.nbytes > {SPLIT_LIMIT} AND w.cur > 0 THEN w.chunk_no + 1 ELSE w.chunk_no END,
           CASE WHEN w.cur + o.nbytes > {SPLIT_LIMIT} AND w.cur > 0 THEN o.nbytes ELSE w.cur + o.nbytes END
    FROM walk w JOIN ordered o ON o.i = w.i + 1)
SELECT o.line_no, o.nbytes, o.en - o.nbytes AS st, o.en, w.chunk_no FROM ordered o JOIN walk w USING (i)"""


@register("corpus_next_fit_chunks", _WALK_SQL)
def corpus_next_fit_chunks(spark, sf_dir):
    """Greedy next-fit chunk of every raw corpus line (limit 200,000 bytes)."""
    lines = K.raw_lines_from_documents(read_table(spark, sf_dir, "documents"))
    ch = K.next_fit_chunks(lines, SPLIT_LIMIT)
    return ch.select("line_no", "nbytes", "st", "en", "chunk_no")


@register("corpus_first_chunk", _WALK_SQL.replace("SELECT o.line_no, o.nbytes, o.en - o.nbytes AS st, o.en, w.chunk_no",
                                                  "SELECT o.line_no, o.nbytes") + " WHERE w.chunk_no = 1")
def corpus_first_chunk(spark, sf_dir):
    """The lines of the first chunk only (sample mode)."""
    lines = K.raw_lines_from_documents(read_table(spark, sf_dir, "documents"))
    return K.first_chunk(lines, SPLIT_LIMIT).select("line_no", "nbytes")


# --- the same from files: S01, S02, S04-S06 ------------------------------------------------------

N_FILES = 5
# every 50th line is cut off, as in corpus_tolerant_parse
_FILE_LINES_SQL = f"""lines AS (SELECT doc_id AS line_no, doc_id, text,
                 (strlen(CASE WHEN doc_id % 50 = 7 THEN '{{"id": ' || CAST(doc_id AS VARCHAR) || ', "text": '
                              ELSE json_object('id', doc_id, 'text', text)::VARCHAR END) + 1)::BIGINT AS nbytes FROM documents)"""
_FILE_WALK_SQL = _WALK_SQL.replace(_LINES_SQL, _FILE_LINES_SQL).replace("SELECT line_no, nbytes, row_number()", "SELECT line_no, doc_id, text, nbytes, row_number()")


def _corpus_files(spark, sf_dir) -> str:
    """``documents`` as a folder of JSONL files ``raw_0.jsonl`` ... in the order of their ids."""
    d = read_table(spark, sf_dir, "documents")
    top = d.agg(F.max("doc_id")).first()[0] or 0
    value = F.when(F.col("line_no") % 50 == 7, F.concat(F.lit('{"id": '), F.col("line_no").cast("string"), F.lit(', "text": '))).otherwise(F.col("value"))
    rows = K.raw_lines_from_documents(d).select(F.floor(F.col("line_no") * N_FILES / (top + 1)).cast("int").alias("unit_no"), "line_no", value.alias("value"))
    path = fresh_path(spark, "raw-files")
    nbytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    FS.write_units(rows, path, {k: f"raw_{k}.jsonl" for k in range(N_FILES)}, int(nbytes))
    return path


@register("corpus_files_next_fit_chunks", _FILE_WALK_SQL.replace("SELECT o.line_no, o.nbytes, o.en - o.nbytes AS st", "SELECT o.i AS line_no, o.nbytes, o.en - o.nbytes AS st"))
def corpus_files_next_fit_chunks(spark, sf_dir):
    """S01 + S02 + P05 + P06: lines of JSONL files numbered over their splits, and their chunks."""
    lines = FS.read_numbered(spark, _corpus_files(spark, sf_dir))
    return K.next_fit_chunks(lines.select("line_no", "nbytes"), SPLIT_LIMIT).select("line_no", "nbytes", "st", "en", "chunk_no")


@register("corpus_files_first_chunk", _FILE_WALK_SQL.replace("SELECT o.line_no, o.nbytes, o.en - o.nbytes AS st, o.en, w.chunk_no", "SELECT o.i AS line_no, o.nbytes")
          + " WHERE w.chunk_no = 1")
def corpus_files_first_chunk(spark, sf_dir):
    """P07 from files: the sample mode, written as one chunk file and read back."""
    out = fresh_path(spark, "sample-chunk")
    FS.split_files(spark, _corpus_files(spark, sf_dir), out, SPLIT_LIMIT, sample=True)
    return FS.read_numbered(spark, out).select("line_no", "nbytes")


_CONVERTED_SQL = _FILE_WALK_SQL.replace("SELECT o.line_no, o.nbytes, o.en - o.nbytes AS st, o.en, w.chunk_no FROM ordered o JOIN walk w USING (i)", """
SELECT 'miniCorpus_' || CAST(w.chunk_no AS VARCHAR) || '.jsonl' AS unit, row_number() OVER (PARTITION BY w.chunk_no ORDER BY o.i) AS pos,
       CAST(o.doc_id AS VARCHAR) AS id, chr(10) || chr(10) || o.text AS contents
FROM ordered o JOIN walk w USING (i) WHERE o.doc_id % 50 <> 7 AND o.text IS NOT NULL AND o.text <> ''""")


@register("corpus_files_converted", _CONVERTED_SQL)
def corpus_files_converted(spark, sf_dir):
    """S04 + S05: chunk files written, read back and converted one by one; the converted files are
    read back with their names and the place of every line in its file."""
    work = fresh_path(spark, "corpus")
    FS.prepare_corpus(spark, _corpus_files(spark, sf_dir), work, SPLIT_LIMIT)
    lines = FS.read_numbered(spark, f"{work}/converted")
    first = lines.groupBy("unit").agg(F.min("line_no").alias("first"))
    j = lines.join(first, "unit").select("unit", (F.col("line_no") - F.col("first") + 1).alias("pos"), F.from_json("value", "id STRING, contents STRING").alias("j"))
    return j.select("unit", "pos", "j.id", "j.contents")
