"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.oracle_views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """``sql`` preceded by the common table expressions it names, and those they name."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.setdefault(name, body)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} AS ({b})" for n, b in needed.items())
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if own:
        return f"WITH RECURSIVE {parts},\n{sql[own.end():]}"
    return f"WITH {parts}\n{sql}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows in DuckDB."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return register
