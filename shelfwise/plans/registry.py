"""Registry of named queries: each is a Spark builder (spark, sf_dir) ->
DataFrame plus, where SQL can express it, the equivalent DuckDB SQL used as
the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
