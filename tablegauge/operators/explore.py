"""Rule checks, duplicates, group tables, bins and the data behind distribution plots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.functions.scalars import FLOATING, column, number_columns, percent, present, round_half_even
from tablegauge.operators.ranks import TASK_ROWS, Target, exact_quantiles, order_statistics, running_totals
from tablegauge.operators.values import key_text, runs, stack
from tablegauge.session import BROADCAST_ROWS, checkpoint, if_small


COMPARISONS = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "==": lambda c, v: c == v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def compare(df: DataFrame, name: str, op: str, value) -> Column:
    """A condition on one column that missing numbers never meet.

    The engine ranks NaN above all numbers, so the upward comparisons rule it out; the plain
    comparison stays in front, where the scan can use it.
    """
    col = column(name)
    condition = COMPARISONS[op](col, value)
    if op.startswith(">") and isinstance(df.schema[name].dataType, FLOATING):
        condition = condition & ~F.isnan(col)
    return condition


def above(df: DataFrame, name: str, bound: float) -> DataFrame:
    return df.where(compare(df, name, ">", bound))


def below(df: DataFrame, name: str, bound: float) -> DataFrame:
    return df.where(compare(df, name, "<", bound))


def contradiction(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet all conditions at once; see ``compare`` for conditions on numbers."""
    for c in conditions:
        df = df.where(c)
    return df


def equal_to(df: DataFrame, name: str, value) -> DataFrame:
    return df.where(compare(df, name, "==", value))


def without_missing(df: DataFrame, name: str) -> DataFrame:
    col = column(name)
    kept = df.where(col.isNotNull())
    return kept.where(~F.isnan(col)) if isinstance(df.schema[name].dataType, FLOATING) else kept


def without_noise(df: DataFrame, label: str = "label") -> DataFrame:
    """Clustered rows without those marked -1."""
    return df.where(F.col(label) != -1)


def rule_check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, once per rule, in a single pass: ``(rule, *columns)``.

    See ``compare`` for rules on numbers.
    """
    broken = reduce(lambda a, b: a | b, rules.values())
    hits = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda r: r.isNotNull())
    return df.where(broken).select(F.explode(hits).alias("rule"), *[column(c) for c in df.columns])


def flag_duplicates(
    df: DataFrame, row_id: str, columns: list[str] | None = None, few: int = BROADCAST_ROWS
) -> DataFrame:
    """``df`` with ``duplicated``: true for every copy after the first by ``row_id``.

    Grouping finds the combinations that occur more than once and their first row, with
    copies combined before the shuffle. If these are few, each row is checked against them
    where it is. A row without an id is never marked. If they are many, rows look themselves up among the first ids; that key is
    unique, so the copies of one row never meet in one task.
    """
    columns = columns or [c for c in df.columns if c != row_id]
    # Long text is compared by its SHA-256, so that documents do not travel.
    keys = [
        (key_text(column(c)) if isinstance(df.schema[c].dataType, T.StringType) else present(df, c)).alias(f"_k{i}")
        for i, c in enumerate(columns)
    ]
    groups = df.groupBy(*keys).agg(F.min(column(row_id)).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = checkpoint(groups.where("_n > 1").drop("_n"))
    if repeated.limit(few + 1).count() <= few:
        names = [f"_k{i}" for i in range(len(columns))]
        known = F.broadcast(repeated.withColumnsRenamed({n: f"_r{n}" for n in names}))
        same = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in names])
        later = F.coalesce(column(row_id) != F.col("_first"), F.lit(False))
        kept = [column(c) for c in df.columns]
        return df.select("*", *keys).join(known, same, "left").select(*kept, later.alias("duplicated"))
    firsts = groups.select("_first")
    return (
        df.join(firsts, column(row_id) == F.col("_first"), "left")
        .withColumn("duplicated", F.col("_first").isNull() & column(row_id).isNotNull())
        .drop("_first")
    )


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """``(value, count)`` of a column, most frequent first, gaps left out."""
    col = present(df, name)
    return (
        df.where(col.isNotNull())
        .groupBy(col.alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def class_shares(df: DataFrame, name: str) -> DataFrame:
    """``(value, count, percent)`` of a column, most frequent first."""
    counts = df.where(present(df, name).isNotNull()).groupBy(column(name).alias("value"))
    counts = counts.agg(F.count(F.lit(1)).alias("count"))
    whole = counts.agg(F.sum("count")).scalar()
    return counts.select("value", "count", percent(F.col("count"), whole).alias("percent")).orderBy(
        F.desc("count"), "value"
    )


AGGREGATES = {
    "mean": lambda c: F.avg(c),
    "sum": lambda c: F.sum(c),
    "count": lambda c: F.count(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


def group_table(
    df: DataFrame, by: str, measures: dict[str, tuple[str, str]], digits: int | None = 2
) -> DataFrame:
    """Named aggregates per group: ``{"avg_age": ("age", "mean")}``; rows without a group drop out.

    Fractional results are rounded half to even.
    """
    outs = []
    for alias, (name, how) in measures.items():
        col = AGGREGATES[how](present(df, name))
        fractional = how == "mean" or (how != "count" and df.schema[name].dataType.typeName() in ("double", "float"))
        outs.append((round_half_even(col, digits) if fractional and digits is not None else col).alias(alias))
    return df.where(column(by).isNotNull()).groupBy(column(by).alias(by)).agg(*outs).orderBy(column(by))


def cut(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the left-closed bin [edge, next edge) a value falls into, null outside.

    NaN lies beyond every upper edge.
    """
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (col >= low) & (col < high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def binned_table(
    df: DataFrame,
    name: str,
    edges: Sequence[float],
    labels: Sequence[str],
    measures: dict[str, tuple[str, str]],
    bin_name: str = "bin",
) -> DataFrame:
    """``group_table`` over the bins of a column, in bin order, empty bins left out."""
    col = column(name)
    # The outer edges first, in a form the scan can use.
    binned = df.where((col >= edges[0]) & (col < edges[-1])).withColumn(bin_name, cut(col, edges, labels))
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(bin_name))
    return group_table(binned, bin_name, measures).orderBy(place)


def histograms(
    df: DataFrame, bins: int = 20, max_columns: int | None = 6, columns: list[str] | None = None
) -> DataFrame:
    """Equal-width histogram of the first numeric columns.

    ``(ordinal, column, bin, low, high, count)``; empty columns give no rows and a single
    value widens to half a unit on both sides. One scan finds the ranges, one counts.
    """
    names = (number_columns(df) if columns is None else columns)[:max_columns]
    spark = df.sparkSession
    schema = "ordinal int, column string, bin int, low double, high double"
    ends = [f(present(df, n).cast("double")) for n in names for f in (F.min, F.max)]
    found = list(df.agg(*ends).first()) if names else []
    ranges = zip(range(len(names)), names, found[::2], found[1::2])
    filled = [r for r in ranges if r[2] is not None]
    if not filled:
        return spark.createDataFrame([], schema + ", count bigint")
    grid, entries = [], []
    for i, name, low, high in filled:
        if low == float("-inf") or high == float("inf"):
            raise ValueError(f"column '{name}' holds infinite values")
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        edges = [low + k * width for k in range(bins)] + [high]
        grid += [(i, name, k, edges[k], edges[k + 1]) for k in range(bins)]
        x = present(df, name).cast("double")
        place = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("int")
        # Division can land a value next to its bin; the edges decide.
        start = F.lit(low) + place * F.lit(width)
        stop = F.lit(low) + (place + 1) * F.lit(width)
        exact = F.when(x < start, place - 1).when((x >= stop) & (place < bins - 1), place + 1).otherwise(place)
        entries.append(F.struct(F.lit(i).alias("ordinal"), F.when(x.isNotNull(), exact).alias("bin")))
    counted = (
        stack([df.select(F.inline(F.array(*run))) for run in runs(entries)])
        .where(F.col("bin").isNotNull())
        .groupBy("ordinal", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # Both sides hold at most columns x bins rows.
    return (
        spark.createDataFrame(grid, schema)
        .join(F.broadcast(counted), ["ordinal", "bin"], "left")
        .select(
            "ordinal", "column", "bin", "low", "high", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")
        )
        .orderBy("ordinal", "bin")
    )


# Bands whose borders are looked up one by one; for more, rows are numbered.
CUT_BANDS = 256


def missing_matrix(df: DataFrame, order_by: Column, bands: int = 50, limit: int = TASK_ROWS) -> DataFrame:
    """Share of gaps per band of rows and column: ``(band, n_rows, column, missing_share)``.

    Bands split the rows into equal parts in ``order_by`` order, a unique bigint; with as
    many bands as rows the table is the plain row-by-column mask.
    """
    rows = df.withColumn("_at", order_by.cast("bigint"))
    size = rows.count()
    if size == 0:
        return df.sparkSession.createDataFrame([], "band int, n_rows bigint, column string, missing_share double")
    bands = min(bands, size)
    if bands > CUT_BANDS:
        # Rows are numbered in order; the band follows from the number.
        numbers = running_totals(rows.select("_at", F.lit(1).alias("one")), "_at", ["one"], limit=limit)
        place = numbers.select("_at", (F.ceil(F.col("cum_one") * bands / size) - 1).cast("int").alias("_band"))
        rows = rows.join(place, "_at")
        band = F.col("_band")
    else:
        targets = [Target((), size * k // bands, size) for k in range(1, bands)]
        cuts = [t.value for t in order_statistics(rows, [], "_at", targets, limit)]
        at = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
        band = F.size(F.filter(at, lambda c: c <= F.col("_at")))
    shares = [F.avg(present(df, n).isNull().cast("int")).alias(f"m{i}") for i, n in enumerate(df.columns)]
    per_band = rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_rows"), *shares)
    cells = [F.struct(F.lit(n).alias("column"), F.col(f"m{i}").alias("missing_share")) for i, n in enumerate(df.columns)]
    return per_band.select("band", "n_rows", F.inline(F.array(*cells)))


def box_stats(df: DataFrame, group: str, name: str, limit: int = TASK_ROWS) -> DataFrame:
    """Box-plot numbers per group: quartiles, whisker ends within 1.5 IQR, outlier count."""
    rows = df.select(column(group).alias("_g"), present(df, name).cast("double").alias("_x"))
    rows = rows.where(F.col("_x").isNotNull() & F.col("_g").isNotNull())
    quartiles = checkpoint(exact_quantiles(rows, ["_g"], "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, limit))
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_x").between(low, high)
    ends = (
        rows.join(if_small(quartiles), "_g")
        .groupBy("_g", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_x"))).alias("lo"),
            F.max(F.when(inside, F.col("_x"))).alias("hi"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
    return ends.select(
        F.col("_g").alias(group),
        "n",
        "q1",
        "median",
        "q3",
        F.least("q1", "lo").alias("whisker_low"),
        F.greatest("q3", "hi").alias("whisker_high"),
        "n_outliers",
    )


def box_outliers(df: DataFrame, group: str, name: str, limit: int = TASK_ROWS) -> DataFrame:
    """The points beyond the whiskers: ``(group, value)``."""
    rows = df.select(column(group).alias("_g"), present(df, name).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & F.col("_g").isNotNull())
    quartiles = checkpoint(exact_quantiles(rows, ["_g"], "value", {"q1": 0.25, "q3": 0.75}, limit))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    beyond = (F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach)
    return rows.join(if_small(quartiles), "_g").where(beyond).select(F.col("_g").alias(group), "value")


def scatter_series(df: DataFrame, x: str, y: str, group: str) -> DataFrame:
    """The points of a scatter plot with the group that colours them."""
    return df.select(column(group).alias("series"), present(df, x).alias("x"), present(df, y).alias("y"))
