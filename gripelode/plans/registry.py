"""Named queries over the given tables, each with the DuckDB SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gripelode.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    """A shared subquery; SQL that mentions ``name`` gets it and what it needs in its WITH list."""
    CTES[name] = sql


def _needed(sql: str, found: dict[str, str]) -> None:
    for name in re.findall(r"\bx_\w+\b", sql):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            found[name] = CTES[name]


def with_ctes(sql: str) -> str:
    found: dict[str, str] = {}
    _needed(sql, found)
    if not found:
        return sql
    parts = ",\n".join(f"{name} AS ({body})" for name, body in found.items())
    return f"WITH {parts}\n{sql}"


def oracles() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in CHECKS.items()}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register
