"""The table of registered queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.plans.bases import BASE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, bases: str = ""):
    """Register a query; ``bases`` names the base relations its SQL reads."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_bases(sql, bases)
        return f

    return add


def with_bases(sql: str, bases: str) -> str:
    """Put the definitions of base relations in front of a statement."""
    needed: list[str] = []

    def need(base: str) -> None:
        for b in BASE_SQL[base][0]:
            need(b)
        if base not in needed:
            needed.append(base)

    for base in bases.split():
        need(base)
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{b} AS ({BASE_SQL[b][1].strip()})" for b in needed)
    body = sql.strip()
    return f"WITH {parts},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {parts}\n{body}"
