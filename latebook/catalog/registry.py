"""Registration of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def money(column: str | Column, digits: int = 2) -> Column:
    """Rounded for publication; adding zero turns a negative zero into zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)
