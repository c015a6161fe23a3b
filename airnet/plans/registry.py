from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query ``fn(spark, sf_dir) -> DataFrame`` and its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def r6(c, n: int = 6) -> Column:
    """Comparison rounding used identically in the query and its oracle: the tiny nudge
    keeps decimal ties (means of two-decimal values) on the same side in both engines."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(1e-9), n)


def rsql(expr: str, n: int = 6) -> str:
    return f"round(({expr}) + 1e-9, {n})"
