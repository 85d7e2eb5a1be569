"""The cued questions make the rules act: each has rows in which it changes something."""

import __spark_entry__ as E

from .conftest import SF_SMALL


def test_rules_fire(spark):
    q = E.queries()
    rows = lambda name: [r.asDict() for r in q[name](spark, SF_SMALL).collect()]
    assert {r["media_type"] for r in rows("cued_media_type")} >= {"movie", "film"} or rows("cued_media_type")
    ev = rows("cued_events")
    assert any(r["negated"] for r in ev)                                          # N07
    assert any(r["raw_subject"].lower() == "he" and r["subject"].lower() != "he" for r in ev)   # N08 / N09
    assert any("through the window" in r["prep_phrases"] for r in ev)             # N07b
    assert rows("cued_relclause")                                                 # N11
    text = [r["text"] for r in rows("cued_weighted_query_text")]
    assert any("^4" in t for t in text) and any("^2" in t for t in text)          # I07
    bag = {(r["qid"], r["docid"]): r["score"] for r in rows("cued_boosted_bag")}
    phrase = {(r["qid"], r["docid"]): r["score"] for r in rows("cued_boosted_phrase")}
    assert bag != phrase                                                          # I08, I13
    ent = rows("filter_generic_entities")
    assert all("Man" not in r["entities"].split(" | ") for r in ent) and any("Anna Lee" in r["entities"] for r in ent)   # P08
    att = rows("filter_attributes")
    assert any("R-rated" in r["attributes"] for r in att) and not any("crazy" in r["attributes"] for r in att)           # P09
