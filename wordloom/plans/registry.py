"""Registry of the queries exposed by ``__spark_entry__``: each key has a
Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the result is
SQL-expressible, an independent DuckDB oracle over the same tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r6(col: str = "text") -> str:
    """DuckDB spelling of the default tokenizer on lower-cased text."""
    return f"regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def r5(col: str = "text") -> str:
    return f"regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]+')"
