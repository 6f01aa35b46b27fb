"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that one notion of missing holds."""
    col = column(name)
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(col), col)
    return col


def number_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns; booleans do not count as numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Names of the string columns, the candidates for category tables."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def round_half_even(col: Column, scale: int = 2) -> Column:
    return F.bround(col, scale)


def clip(col: Column, low: float = 0.0, high: float = 1.0) -> Column:
    # greatest and least pass over nulls, so a null is kept apart.
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null when whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * F.lit(100.0)


def as_text(col: Column) -> Column:
    return col.cast("string")


def float_text(col: Column) -> Column:
    """Doubles in shortest positional form: 10.0, 12345678.0, 0.0001, 1e+16, 1e-05."""
    size = F.abs(col)
    text = col.cast("string")
    wide = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(wide, F.lit(".")), F.concat(wide, F.lit("0"))).otherwise(wide)
    parts = F.split(text, "E")
    power = F.get(parts, F.lit(1)).try_cast("int")
    digits = F.when(F.abs(power) < 10, F.concat(F.lit("0"), F.abs(power).cast("string"))).otherwise(
        F.abs(power).cast("string")
    )
    scientific = F.concat(
        F.regexp_replace(F.get(parts, F.lit(0)), r"\.0$", ""),
        F.lit("e"),
        F.when(power < 0, "-").otherwise("+"),
        digits,
    )
    return (
        F.when(size == float("inf"), F.when(col > 0, "inf").otherwise("-inf"))
        .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), scientific)
        .when((size >= 1e7) | ((size < 1e-3) & (size > 0)), plain)
        .otherwise(text)
    )
