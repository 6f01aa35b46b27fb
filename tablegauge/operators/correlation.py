"""Pearson correlation of all numeric column pairs, each over its complete rows."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.scalars import clip, number_columns, present
from tablegauge.operators.profile import project

# Up to this many columns the pair sums are plain aggregate expressions. Beyond it, six sums
# per pair cost more in one aggregate than a matrix product over Arrow batches.
EXPRESSION_COLUMNS = 3

_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_EMPTY = "i int, j int, column_a string, column_b string, n bigint, corr double"


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(i, j, column_a, column_b, n, corr)`` for i <= j; null where a side is constant."""
    names = number_columns(df) if columns is None else columns
    if not names:
        return df.sparkSession.createDataFrame([], _EMPTY)
    numbers = project(df, names)
    means = numbers.agg(*[F.avg(present(numbers, n).cast("double")).alias(f"m{i}") for i, n in enumerate(names)])
    centers = [m or 0.0 for m in means.first()]
    moments = _by_expression if len(names) <= EXPRESSION_COLUMNS else _by_matrix
    sums = moments(numbers, names, centers)

    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    var_x = F.col("sxx") - F.try_divide(sx * sx, n)
    var_y = F.col("syy") - F.try_divide(sy * sy, n)
    cov = F.col("sxy") - F.try_divide(sx * sy, n)
    # Rounding can leave a constant column with a variance just above zero.
    noise_x, noise_y = F.lit(1e-14) * F.col("sxx"), F.lit(1e-14) * F.col("syy")
    corr = F.when((var_x > noise_x) & (var_y > noise_y), cov / (F.sqrt(var_x) * F.sqrt(var_y)))
    corr = clip(corr, -1.0, 1.0)
    listed = F.array(*[F.lit(x) for x in names])
    return sums.select(
        "i",
        "j",
        F.element_at(listed, F.col("i") + 1).alias("column_a"),
        F.element_at(listed, F.col("j") + 1).alias("column_b"),
        n.cast("bigint").alias("n"),
        F.when(corr.isNotNull() & (F.col("i") == F.col("j")), F.lit(1.0)).otherwise(F.when(n > 1, corr)).alias("corr"),
    )


def _by_expression(df: DataFrame, names: list[str], centers: list[float]) -> DataFrame:
    """Six sums per pair in one aggregate, without a shuffle beyond one row per task."""
    shifted = df.select(
        *[(present(df, n).cast("double") - F.lit(float(c))).alias(f"x{i}") for i, (n, c) in enumerate(zip(names, centers))]
    )
    entries = []
    for i, j in itertools.combinations_with_replacement(range(len(names)), 2):
        x, y = F.col(f"x{i}"), F.col(f"x{j}")
        left = x if i == j else F.when(y.isNotNull(), x)
        right = x if i == j else F.when(x.isNotNull(), y)
        sums = [F.count(x + y), F.sum(left), F.sum(right), F.sum(left * left), F.sum(right * right), F.sum(x * y)]
        entries.append(
            F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), *[s.alias(m) for s, m in zip(sums, _MOMENTS)])
        )
    return shifted.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def _by_matrix(df: DataFrame, names: list[str], centers: list[float]) -> DataFrame:
    """Pair sums by matrix products in every task, added up per pair."""
    middle = np.asarray(centers, dtype=np.float64)
    p = len(names)
    upper_i, upper_j = np.triu_indices(p)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((p, p)) for _ in _MOMENTS]
        for batch in batches:
            x = np.column_stack(
                [np.asarray(batch.column(k).to_numpy(zero_copy_only=False), dtype=np.float64) for k in range(p)]
            )
            known = ~np.isnan(x)
            x = np.where(known, x - middle, 0.0)
            mask = known.astype(np.float64)
            squares = x * x
            by_x, by_xx = x.T @ mask, squares.T @ mask
            for total, part in zip(totals, (mask.T @ mask, by_x, by_x.T, by_xx, by_xx.T, x.T @ x)):
                total += part
        columns = [pa.array(upper_i.astype(np.int32)), pa.array(upper_j.astype(np.int32))]
        columns += [pa.array(t[upper_i, upper_j]) for t in totals]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", *_MOMENTS])

    numbers = df.select(*[present(df, n).cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    schema = "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS)
    return numbers.mapInArrow(partial, schema).groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in _MOMENTS])


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form of the full symmetric matrix: ``(column_a, column_b, corr)``."""
    half = correlation_pairs(df, columns)
    mirrored: Column = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j", "column_a", "column_b", "corr")))
    mirrored = mirrored.otherwise(
        F.array(
            F.struct("i", "j", "column_a", "column_b", "corr"),
            F.struct(
                F.col("j").alias("i"),
                F.col("i").alias("j"),
                F.col("column_b").alias("column_a"),
                F.col("column_a").alias("column_b"),
                "corr",
            ),
        )
    )
    return half.select(F.inline(mirrored)).orderBy("i", "j").select("column_a", "column_b", "corr")


def correlation_wide(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The matrix with one row and one column per numeric column."""
    names = number_columns(df) if columns is None else columns
    long = correlation_matrix(df, names)
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("column")) if names else F.lit(0)
    return (
        long.withColumnRenamed("column_a", "column")
        .groupBy("column")
        .pivot("column_b", names)
        .agg(F.first("corr"))
        .orderBy(place)
    )


def heatmap(df: DataFrame) -> DataFrame:
    """The matrix as heat-map cells; empty below two numeric columns."""
    names = number_columns(df)
    return correlation_matrix(df, names if len(names) >= 2 else [])
