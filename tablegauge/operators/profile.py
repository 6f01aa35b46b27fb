"""Column profiles, missing-value tables and plain inspection of a DataFrame."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.functions.scalars import column, number_columns, present
from tablegauge.operators import values as V
from tablegauge.operators.ranks import exact_quantiles

# Rows from which quartiles of a column are read off a sketch first.
SKETCHED_ROWS = 50_000

PROFILE_SCHEMA = (
    "ordinal int, name string, dtype string, kind string, midnight boolean, non_null bigint, missing bigint, "
    "missing_share double, is_numeric boolean, min double, max double, mean double, std double"
)


@dataclass(frozen=True)
class ColumnStats:
    ordinal: int
    name: str
    kind: str
    numeric_type: bool
    non_null: int
    low: float | None
    high: float | None
    one_value: bool | None
    mean: float | None
    std: float | None
    longest: int
    midnight: bool
    distinct_estimate: int | None


@dataclass(frozen=True)
class TableStats:
    n_rows: int
    columns: list[ColumnStats]

    @property
    def n_cols(self) -> int:
        return len(self.columns)


def table_stats(df: DataFrame, estimate_distinct: bool = False, estimate_numbers: bool = False) -> TableStats:
    """Everything a single scan can tell, brought back as one row.

    The aggregate needs no shuffle beyond one row per task. ``estimate_distinct`` adds
    approximate distinct counts of the non-numeric columns, ``estimate_numbers`` of the rest.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema.fields):
        kind = V.kind_of(field.dataType)
        col = present(df, field.name)
        aggs.append(F.count(col).alias(f"n{i}"))
        if kind in (V.INT, V.BOOL, V.FLOAT, V.SINGLE):
            number = col.cast("int") if kind == V.BOOL else col
            aggs += [
                F.min(number).cast("double").alias(f"lo{i}"),
                F.max(number).cast("double").alias(f"hi{i}"),
                (F.min(number) == F.max(number)).alias(f"same{i}"),
                F.avg(number.cast("double")).alias(f"avg{i}"),
                F.stddev_samp(number.cast("double")).alias(f"std{i}"),
            ]
            if estimate_numbers:
                aggs.append(F.approx_count_distinct(col).alias(f"about{i}"))
        elif kind == V.TIME:
            day = F.lit(86_400_000_000).cast("bigint")
            aggs.append(F.max(F.pmod(V.micros(df, field.name), day) != 0).alias(f"clock{i}"))
            if estimate_distinct:
                aggs.append(F.approx_count_distinct(col).alias(f"about{i}"))
        else:
            text = V.text_slot(df, field.name)
            aggs.append(F.max(F.octet_length(text)).alias(f"len{i}"))
            if estimate_distinct:
                aggs.append(F.approx_count_distinct(text).alias(f"about{i}"))
    row = df.agg(*aggs).first().asDict()
    columns = [
        ColumnStats(
            ordinal=i,
            name=field.name,
            kind=V.kind_of(field.dataType),
            numeric_type=isinstance(field.dataType, T.NumericType),
            non_null=row[f"n{i}"],
            low=row.get(f"lo{i}"),
            high=row.get(f"hi{i}"),
            one_value=row.get(f"same{i}"),
            mean=row.get(f"avg{i}"),
            std=row.get(f"std{i}"),
            longest=row.get(f"len{i}") or 0,
            midnight=not row.get(f"clock{i}"),
            distinct_estimate=row.get(f"about{i}"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return TableStats(row["rows"], columns)


def dtype_label(col: ColumnStats, n_rows: int) -> str:
    """The type name a plain data frame would show for the column."""
    if col.non_null == 0 and col.kind != V.TIME and n_rows > 0:
        return "float64"
    gaps = col.non_null < n_rows
    if col.kind == V.INT:
        return "float64" if gaps else "int64"
    if col.kind == V.BOOL:
        return "object" if gaps else "bool"
    if col.kind in (V.FLOAT, V.SINGLE):
        return "float64"
    return "datetime64[ns]" if col.kind == V.TIME else "object"


def is_numeric(col: ColumnStats, n_rows: int) -> bool:
    return dtype_label(col, n_rows) in ("int64", "float64", "bool")


def stats_frame(df: DataFrame, stats: TableStats) -> DataFrame:
    """One row per column from the collected statistics."""
    n = stats.n_rows
    rows = []
    for c in stats.columns:
        numeric = is_numeric(c, n)
        has_numbers = numeric and c.low is not None
        rows.append(
            (
                c.ordinal,
                c.name,
                dtype_label(c, n),
                c.kind,
                c.midnight,
                c.non_null,
                n - c.non_null,
                (n - c.non_null) / n if n else 0.0,
                numeric,
                c.low if has_numbers else None,
                c.high if has_numbers else None,
                c.mean if has_numbers else None,
                c.std if has_numbers else None,
            )
        )
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def quick_summary(df: DataFrame) -> DataFrame:
    """The profile from a single scan: distinct counts are estimates, examples are left out."""
    stats = table_stats(df, estimate_distinct=True, estimate_numbers=True)
    estimates = F.array(*[F.lit(c.distinct_estimate).cast("bigint") for c in stats.columns])
    frame = stats_frame(df, stats)
    no_examples = F.array().cast("array<string>")
    return _finish(frame.withColumns({"unique": estimates[F.col("ordinal")], "example_values": no_examples}))


def summarize(
    df: DataFrame, order_by: Column | None = None, examples: int = 3, stats: TableStats | None = None
) -> DataFrame:
    """Profile of every column: type, gaps, distinct count, examples, number statistics.

    ``examples`` are the first distinct values in ``order_by`` order, a bigint expression;
    without one they are the smallest values.
    """
    stats = stats or table_stats(df)
    names = [c.name for c in stats.columns]
    frame = stats_frame(df, stats)
    if not names:
        return _finish(frame.withColumns({"unique": F.lit(0).cast("bigint"), "example_values": F.array().cast("array<string>")}))

    # A number per column, worked out once: it also tells which columns have no further example.
    seen = {r["c"]: r["unique"] for r in V.distinct_counts(V.distinct_values(df, names)).collect()}
    unique = df.sparkSession.createDataFrame(list(seen.items()), "c int, unique bigint")
    distinct = [seen.get(c.ordinal, 0) for c in stats.columns]
    first = V.first_values(df, names, examples, order_by, distinct, [c.longest <= V.LONG_TEXT for c in stats.columns])
    about = frame.select(F.col("ordinal").alias("c"), "kind", "dtype", "midnight")
    shown = first.join(F.broadcast(about), "c").select(
        "c",
        F.lit(None).cast("bigint").alias("unique"),
        F.struct("rank", V.printed(F.col("kind"), F.col("dtype"), F.col("midnight")).alias("text")).alias("example"),
    )
    counted = unique.select("c", "unique", F.lit(None).cast(shown.schema["example"].dataType).alias("example"))
    # A few rows per column.
    small = (
        counted.unionByName(shown)
        .groupBy("c")
        .agg(F.max("unique").alias("unique"), F.array_sort(F.collect_list("example")).alias("ranked"))
        .select("c", "unique", F.transform("ranked", lambda e: e["text"]).alias("example_values"))
    )
    out = (
        frame.join(F.broadcast(small), frame["ordinal"] == small["c"], "left")
        .withColumn("unique", F.coalesce("unique", F.lit(0).cast("bigint")))
        .withColumn("example_values", F.coalesce("example_values", F.array().cast("array<string>")))
    )
    return _finish(out)


def _finish(frame: DataFrame) -> DataFrame:
    return frame.select(
        "ordinal", "name", "dtype", "non_null", "missing", "missing_share", "unique", "example_values",
        "is_numeric", "min", "max", "mean", "std",
    )


def flat_summary(profile: DataFrame) -> DataFrame:
    """The printable profile: eleven columns, without ordinal and examples."""
    return profile.select(
        "name", "dtype", "non_null", "missing", "missing_share", "unique", "is_numeric", "min", "max", "mean", "std"
    )


def overview(df: DataFrame, order_by: Column | None = None) -> DataFrame:
    """The printable profile next to the shape of the table."""
    stats = table_stats(df)
    return flat_summary(summarize(df, order_by, stats=stats)).select(
        F.lit(stats.n_rows).cast("bigint").alias("n_rows"), F.lit(stats.n_cols).alias("n_cols"), "*"
    )


def dataset_record(df: DataFrame, order_by: Column | None = None) -> DataFrame:
    """The whole profile as one nested row: n_rows, n_cols, columns."""
    stats = table_stats(df)
    profile = summarize(df, order_by, stats=stats)
    entry = F.struct(*profile.columns)
    return profile.agg(F.array_sort(F.collect_list(entry)).alias("columns")).select(
        F.lit(stats.n_rows).cast("bigint").alias("n_rows"),
        F.lit(stats.n_cols).alias("n_cols"),
        F.transform("columns", lambda c: c.dropFields("ordinal")).alias("columns"),
    )


def missing_table(df: DataFrame, stats: TableStats | None = None) -> DataFrame:
    """``(column, missing_count, missing_share)``, largest share first; empty for no rows."""
    if stats is None:
        rows = _per_column(df, "missing_count", lambda c: F.count_if(c.isNull()))
    else:
        counts = [(c.ordinal, c.name, stats.n_rows - c.non_null, stats.n_rows) for c in stats.columns]
        schema = "ordinal int, column string, missing_count bigint, _n bigint"
        rows = df.sparkSession.createDataFrame(counts, schema)
    rows = rows.where("_n > 0").withColumn("missing_share", F.col("missing_count") / F.col("_n"))
    return rows.orderBy(F.desc("missing_share"), "ordinal").select("column", "missing_count", "missing_share")


def missing_counts(df: DataFrame) -> DataFrame:
    """``(column, missing)`` in column order, as part of the plan."""
    return _per_column(df, "missing", lambda c: F.count_if(c.isNull())).drop("_n")


def missing_shares(df: DataFrame) -> DataFrame:
    """``(column, missing_share)`` in column order."""
    return _per_column(df, "missing_share", lambda c: F.avg(c.isNull().cast("int"))).drop("_n")


def schema_info(df: DataFrame) -> DataFrame:
    """``(ordinal, column, type, non_null)``."""
    entries = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(present(df, f.name)).alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def _per_column(df: DataFrame, label: str, measure) -> DataFrame:
    """One row per column with its measure, next to the row count ``_n``."""
    entries = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column"), measure(present(df, n)).alias(label))
        for i, n in enumerate(df.columns)
    ]
    return df.agg(F.array(*entries).alias("e"), F.count(F.lit(1)).alias("_n")).select(F.inline("e"), "_n")


def column_types(df: DataFrame) -> DataFrame:
    """``(column, type)`` in column order."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns there are of each type."""
    seen = Counter(f.dataType.simpleString() for f in df.schema.fields)
    return df.sparkSession.createDataFrame(sorted(seen.items()), "type string, n_columns bigint")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def column_range(df: DataFrame, name: str) -> DataFrame:
    col = present(df, name)
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def first_rows(df: DataFrame, n: int = 5, *order: Column | str) -> DataFrame:
    """The first rows under ``order``; each task keeps only n."""
    return df.orderBy(*order).limit(n)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[column(c) for c in columns])


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def numbers_only(df: DataFrame) -> DataFrame:
    return project(df, number_columns(df))


def distinct_in_order(df: DataFrame, name: str, order_by: Column) -> DataFrame:
    """Distinct values of a column by first appearance, a missing value included."""
    return df.groupBy(present(df, name).alias(name)).agg(F.min(order_by).alias("first_seen")).orderBy("first_seen")


def describe(df: DataFrame, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max of the numeric columns.

    The quartiles are exact with linear interpolation. Beyond ``SKETCHED_ROWS`` rows they take two
    scans, and no value travels but those near a quartile.
    """
    names = columns or number_columns(df)
    stats = table_stats(project(df, names))
    frame = stats_frame(df, stats).select(
        F.col("ordinal").alias("c"), F.col("name").alias("column"), F.col("non_null").alias("count"),
        "mean", "std", "min", "max",
    )
    entries = [F.struct(F.lit(i).alias("c"), present(df, n).cast("double").alias("v")) for i, n in enumerate(names)]
    # Tasks hold sketches and what lies near quartiles, few values of a column, so more columns share a pass.
    numbers = V.stack([df.select(F.inline(F.array(*run))) for run in V.runs(entries, V.WIDE_PASS_COLUMNS)])
    largest = max((c.non_null for c in stats.columns), default=0)
    extra = {} if limit is None else {"limit": limit}
    if all(c.numeric_type for c in stats.columns):
        # The scan before has counted the values of numbers; other columns may not all read as one.
        extra["group_sizes"] = {(c.ordinal,): c.non_null for c in stats.columns}
    quartiles = exact_quantiles(
        numbers, ["c"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, largest_group=largest, sketch_above=SKETCHED_ROWS, **extra
    )
    return (
        frame.join(F.broadcast(quartiles), "c", "left")
        .orderBy("c")
        .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    )
