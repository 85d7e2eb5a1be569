"""The named queries of the llm operators over the given tables, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


ORACLE["op1_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id
FROM n LEFT JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .linededup import line_dedup
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op5_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, k.pos, k.line, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .decontam import decontaminate
    d = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op4_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS g
        FROM i, unnest(range(1, greatest(len(w) - 8, 2))) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(p)),
hit AS (SELECT o.doc_id, o.p, o.n, win.item_id FROM occ o JOIN win ON o.g = win.g AND o.n = win.n),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .shards import lpt_shards
    return lpt_shards(table(spark, sf_dir, "documents"), n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_id
    return language_id(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan_secrets
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ordering import order_documents
    return order_documents(spark, table(spark, sf_dir, "documents"))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_chats
    return format_chats(table(spark, sf_dir, "conversations"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, n=5, share=(80, 100), label_col=label)


ORACLE["op13_hard_negatives"] = r"""
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations
    return collocations(table(spark, sf_dir, "documents"), min_count=30, longest=4, top=2000, inside=(80, 100))


ORACLE["op12_phrase_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM w, unnest(range(1, 5)) AS t(k), unnest(range(1, len(words) - k + 2)) AS u(i)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f))::BIGINT AS score
        FROM c, unnest(range(1, k)) AS t(j) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:j], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, phrase, max(a) AS f FROM (
             SELECT lang, a, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM c, unnest(range(2, k)) AS t(m), unnest(range(1, k - m + 2)) AS u(i)) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100::HUGEINT * longer.f < 80::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii
    return find_pii(table(spark, sf_dir, "documents"))
