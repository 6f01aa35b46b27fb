"""Most frequent values of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tablegauge.functions.scalars import share, text_columns
from tablegauge.operators import values as V


def category_columns(df: DataFrame) -> list[str]:
    """Candidates in column order: text, and types that only print as text."""
    other = (T.DateType, T.BinaryType)
    return [f.name for f in df.schema.fields if f.name in set(text_columns(df)) or isinstance(f.dataType, other)]


def top_categories(
    df: DataFrame,
    max_columns: int = 5,
    top_k: int = 5,
    order_by: Column | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """``(ordinal, column, rank, value, count, share)`` of the ``top_k`` values per column.

    The first ``max_columns`` candidates count, empty ones included. Ties go to the value
    seen first under ``order_by``. The share is taken within the listed values.
    """
    names = (category_columns(df) if columns is None else columns)[:max_columns]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "ordinal int, column string, rank int, value string, count bigint, share double"
        )
    top = V.top_values(df, names, top_k, order_by)
    # Long text was counted by digest. With none picked, the read-back is empty and skipped.
    top = V.restore_text(top, df, names, order_by)
    within = Window.partitionBy("c")
    column = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("c") + 1)
    return top.select(
        F.col("c").alias("ordinal"),
        column.alias("column"),
        "rank",
        F.col("s").alias("value"),
        F.col("n").alias("count"),
        share(F.col("n"), F.sum("n").over(within)).alias("share"),
    ).orderBy("ordinal", "rank")
