"""The model-reply flavour of decomposition.

The reference sends a prompt per question to a hosted model. Here the prompt table is
built for any offline batch job, and replies are consumed as a table ``(qid, reply)``:
fence strip, JSON parse into five lists (all empty when the reply is not a JSON
object), then the component filters. Nothing calls out to a network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from . import decompose as D

REPLY_FIELDS = ("media_type: ARRAY<STRING>, entities: ARRAY<STRING>, attributes: ARRAY<STRING>, "
                "time: ARRAY<STRING>, descriptions: ARRAY<STRING>")
FIELDS = ["media_type", "entities", "attributes", "time", "descriptions"]


def prompt_table(topics: DataFrame) -> DataFrame:
    """``(qid, prompt)`` with the question in the template's slot."""
    head, tail = C.DECOMPOSE_PROMPT_TEMPLATE.split("{query}")
    return topics.select("qid", F.concat(F.lit(head), F.col("query"), F.lit(tail)).alias("prompt"))


def parse_replies(replies: DataFrame) -> DataFrame:
    """T16 + T17: ``(qid, media_type, entities, attributes, time, descriptions)``."""
    j = T.parse_json_strict(T.strip_code_fence("reply"), REPLY_FIELDS)
    p = replies.select("qid", j.alias("j"))
    e = F.array().cast("array<string>")
    return p.select("qid", *[F.coalesce(F.col(f"j.{f}"), e).alias(f) for f in FIELDS])


def filter_components(parsed: DataFrame) -> DataFrame:
    """P08-P10 applied to the parsed lists."""
    return parsed.withColumns({"entities": D.filter_entities(F.col("entities")),
                               "attributes": D.normalize_attributes(F.col("attributes")),
                               "descriptions": D.filter_descriptions(F.col("descriptions"))})
