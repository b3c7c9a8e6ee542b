"""Query registry: a Spark callable and, where possible, a DuckDB statement."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spotweave.plans.standin import SQL_VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str) -> str:
    """Prefix the stand-in view definitions the statement mentions, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in SQL_VIEWS and name not in needed:
                visit(SQL_VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    recursive = "recursive " if "with recursive" in sql.lower() else ""
    body = re.sub(r"^\s*with\s+(recursive\s+)?", ", ", sql, flags=re.I) if re.match(
        r"\s*with\s", sql, re.I) else " " + sql
    views = ", ".join(f"{n} as ({SQL_VIEWS[n]})" for n in needed)
    return f"with {recursive}{views}{body}"


def query(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` callable under its operator id."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add
