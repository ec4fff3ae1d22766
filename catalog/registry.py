"""Where the queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame``, with the SQL that checks it."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def r6(column: str | Column) -> Column:
    """Rounded to six places, as the SQL side does; negative zero becomes zero."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, 6) + F.lit(0.0)


def r5(column: str | Column) -> Column:
    """Rounded to five places off the edge, as the SQL side does."""
    from catalog.sql import SHIFT

    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(SHIFT), 5) + F.lit(0.0)
