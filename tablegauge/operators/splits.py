"""Exact stratified splits and folds, decided row by row from a few cut points.

A class is split by comparing each row's hash (or id) with the value at the wanted rank,
so rows never move and a class with most of the rows is no harder than a small one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.operators.ranks import TASK_ROWS, Target, order_statistics, seeded_hash

MAX_CLASSES = 10_000


def class_sizes(df: DataFrame, label: str, row_id: str) -> list[tuple]:
    """``(class, rows, first id)`` ordered by class; classes must be few."""
    found = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first")).orderBy(label)
    rows = found.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"column '{label}' has more than {MAX_CLASSES} classes")
    return [(r[label], r["n"], r["first"]) for r in rows]


def proportional(sizes: list[int], total: int) -> list[int]:
    """``total`` shared out over classes in proportion to their sizes, by largest remainder."""
    whole = sum(sizes)
    exact = [s * total / whole for s in sizes]
    parts = [math.floor(x) for x in exact]
    by_remainder = sorted(range(len(sizes)), key=lambda i: (parts[i] - exact[i], i))
    for i in by_remainder[: total - sum(parts)]:
        parts[i] += 1
    return parts


def _require_bigint(df: DataFrame, row_id: str) -> None:
    if not isinstance(df.schema[row_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"row id '{row_id}' must be a whole number")


def _per_class(label: str, choices: list[tuple[object, Column]], default: Column) -> Column:
    out = None
    for cls, col in choices:
        same = F.col(label).eqNullSafe(F.lit(cls))
        out = F.when(same, col) if out is None else out.when(same, col)
    return default if out is None else out.otherwise(default)


def stratified_split(
    df: DataFrame, label: str, row_id: str, test_size: float, seed: int = 42, limit: int = TASK_ROWS
) -> DataFrame:
    """``df`` with ``is_test``: exactly ceil(test_size * rows) rows, classes in proportion.

    ``row_id`` is a unique whole number; its seeded hash gives the random order.
    """
    _require_bigint(df, row_id)
    classes = class_sizes(df, label, row_id)
    sizes = [n for _, n, _ in classes]
    n_test = math.ceil(test_size * sum(sizes))
    train = proportional(sizes, sum(sizes) - n_test)
    test = [n - t for n, t in zip(sizes, train)]

    hashed = df.select(label, seeded_hash(F.col(row_id), seed).alias("_h"))
    targets = [Target((c,), k, n) for (c, n, _), k in zip(classes, test) if 0 < k < n]
    order_statistics(hashed, [label], "_h", targets, limit)
    bounds = {t.key[0]: t.value for t in targets}
    h = seeded_hash(F.col(row_id), seed)
    choices = [
        (c, h < F.lit(bounds[c]) if c in bounds else F.lit(k > 0)) for (c, _, _), k in zip(classes, test)
    ]
    return df.withColumn("is_test", _per_class(label, choices, F.lit(False)))


def stratified_folds(
    df: DataFrame, label: str, row_id: str, n_folds: int = 5, limit: int = TASK_ROWS, name: str = "fold"
) -> DataFrame:
    """``df`` with a fold number: each class is cut into contiguous runs of its rows by id.

    Fold sizes are those of dealing the rows out fold by fold, class after class in order
    of first appearance.
    """
    _require_bigint(df, row_id)
    classes = sorted(class_sizes(df, label, row_id), key=lambda c: c[2])
    targets, at = [], 0
    runs: list[tuple[object, list[int]]] = []
    for cls, n, _ in classes:
        sizes = [len(range((f - at) % n_folds, n, n_folds)) for f in range(n_folds)]
        starts = [sum(sizes[:f]) for f in range(1, n_folds)]
        runs.append((cls, starts))
        targets += [Target((cls,), s, n) for s in sorted(set(starts)) if s < n]
        at += n
    order_statistics(df.select(label, F.col(row_id).cast("bigint").alias("_id")), [label], "_id", targets, limit)
    values = {(t.key[0], t.rank): t.value for t in targets}
    choices = []
    for cls, starts in runs:
        fold = F.lit(0)
        for s in starts:
            if (cls, s) in values:
                fold = fold + (F.col(row_id) >= F.lit(values[cls, s])).cast("int")
        choices.append((cls, fold))
    return df.withColumn(name, _per_class(label, choices, F.lit(0)))
