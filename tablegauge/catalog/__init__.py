"""Named queries over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.functions.scalars import column

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_SECTIONS = ("inspection", "exploration", "vectors", "learning", "grouping", "files")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, folder) -> DataFrame`` under ``name``."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def load_all() -> None:
    for section in _SECTIONS:
        import_module(f"{__name__}.{section}")


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Double columns rounded for comparison; ``special`` sets digits per column."""
    return df.select(
        *[
            F.round(column(n), special.get(n, digits)).alias(n) if t == "double" else column(n)
            for n, t in df.dtypes
        ]
    )
