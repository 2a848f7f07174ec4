"""Registered queries: a Spark function and, where SQL can say it, the statement it must equal."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberlog.workload.domain import Domain, with_domain

_QUERIES: dict[str, Callable[[Domain], DataFrame]] = {}
_SQL: dict[str, str] = {}
ORACLE_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    """A named step that several check statements share."""
    ORACLE_CTES[name] = sql


def query(name: str, sql: str | None = None):
    """Register ``name``; ``sql`` reads domain tables, shared steps and driver tables."""
    def register(function: Callable[[Domain], DataFrame]):
        _QUERIES[name] = function
        if sql:
            _SQL[name] = sql
        return function
    return register


def statement(name: str) -> str:
    """The check statement of a query that is registered already, to be read as a table."""
    return _SQL[name]


def mean(x: str) -> str:
    """The plain mean; what the engine does to keep its sum exact is not repeated here."""
    return f"AVG({x})"


def half_up(sql: str) -> str:
    """Two-argument ROUND as half up on the decimal value, the rule the library rounds by.

    Plain ROUND of a binary fraction is left to each engine at a tie such as 0.285.
    """
    out, at = [], 0
    for found in re.finditer(r"\bROUND\(", sql):
        if found.start() < at:
            continue
        depth, comma, end = 1, None, found.end()
        while depth:
            char = sql[end]
            depth += (char in "([") - (char in ")]")
            if char == "," and depth == 1:
                comma = end
            end += 1
        inner = sql[found.end():end - 1]
        if comma is None:
            text = f"ROUND({half_up(inner)})"
        else:
            value, places = half_up(sql[found.end():comma]), sql[comma + 1:end - 1].strip()
            text = f"CAST(ROUND(CAST({value} AS DECIMAL(28,9)), {places}) AS DOUBLE)"
        out += [sql[at:found.start()], text]
        at = end
    return "".join([*out, sql[at:]])


def _load() -> None:
    from emberlog.workload import q_gold, q_operators, q_quality, q_silver, q_views  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {n: (lambda spark, sf_dir, f=f: f(Domain(spark, sf_dir))) for n, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {n: half_up(re.sub(r"[ \t]*\n[ \t]*", "\n", with_domain(s, "duckdb", ORACLE_CTES))) for n, s in _SQL.items()}
