"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` over the given tables, with
an optional DuckDB SQL text computing the same rows (the oracle)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def all_queries() -> dict[str, Callable]:
    from . import catalog  # noqa: F401  (registers everything)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from . import catalog  # noqa: F401
    return dict(ORACLE)
