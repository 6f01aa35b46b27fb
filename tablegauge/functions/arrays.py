"""Arithmetic over ARRAY<DOUBLE> and ARRAY<ARRAY<DOUBLE>> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def matrix(rows: Sequence[Sequence[float]]) -> Column:
    return F.array(*[vector(r) for r in rows])


def filled(value: float, *shape: int) -> Column:
    """An array of the given shape with one value everywhere."""
    out = F.lit(float(value))
    for length in reversed(shape):
        out = F.array_repeat(out, length)
    return out


def zeros(*shape: int) -> Column:
    return filled(0.0, *shape)


def ones(*shape: int) -> Column:
    return filled(1.0, *shape)


def value_range(start: int, stop: int, step: int = 1) -> Column:
    """start, start + step, ... without reaching stop."""
    last = start + (stop - start - (1 if step > 0 else -1)) // step * step
    if (step > 0 and start >= stop) or (step < 0 and start <= stop):
        return F.array().cast("array<bigint>")
    return F.sequence(F.lit(start).cast("bigint"), F.lit(last).cast("bigint"), F.lit(step).cast("bigint"))


def shape(col: Column, dims: int = 1) -> Column:
    """Lengths per axis, taken along the first element of each."""
    out = []
    for _ in range(dims):
        out.append(F.size(col))
        col = F.get(col, F.lit(0))
    return F.array(*out)


def element(col: Column, *position: int) -> Column:
    """Element by 0-based position on every axis; negative counts from the end."""
    for p in position:
        col = F.element_at(col, F.lit(p + 1 if p >= 0 else p))
    return col


def section(col: Column, start: int, stop: int) -> Column:
    """Elements start up to but not including stop, 0-based; clipped to the array."""
    size = F.size(col)
    first = F.least(F.lit(start), size) if start >= 0 else F.greatest(size + start, F.lit(0))
    last = F.least(F.lit(stop), size) if stop >= 0 else F.greatest(size + stop, F.lit(0))
    return F.slice(col, first + 1, F.greatest(last - first, F.lit(0)))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def total(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean(col: Column) -> Column:
    """Mean over the elements, null for an empty array."""
    return F.try_divide(total(col), F.size(col).cast("double"))


def matrix_mean(col: Column) -> Column:
    """Mean over all elements of a nested array."""
    return mean(F.flatten(col))


def squared_distance(a: Column, b: Column, dims: int) -> Column:
    """Squared Euclidean distance, written out per dimension to stay in generated code."""
    out = F.lit(0.0)
    for i in range(dims):
        gap = a[i] - b[i]
        out = out + gap * gap
    return out
