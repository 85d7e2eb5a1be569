"""Operators of a training-data pipeline: near duplicates, secrets, shards, decontamination,
line dedup, packing, training order, chat repair, language spans, nearest neighbours.

Nothing outside this subpackage imports it. Each operator has its own module; the named
queries and their SQL are in ``queries.py``.
"""
