"""Data-quality flags, scores and readiness verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.scalars import clip
from tablegauge.operators import values as V
from tablegauge.operators.profile import TableStats, table_stats

# Thresholds and penalties of the dataset rules.
MIN_ROWS = 100
MAX_COLUMNS = 100
MAX_MISSING = 0.5
HIGH_CARDINALITY = 5
FEW_ROWS_PENALTY = 0.2
MANY_COLUMNS_PENALTY = 0.1
CONSTANT_PENALTY = 0.15
CARDINALITY_PENALTY = 0.05

# Thresholds and penalties of the metadata rules.
METADATA_MIN_ROWS = 1000
ONLY_CATEGORICAL_PENALTY = 0.1
ONLY_NUMERIC_PENALTY = 0.05

# Fixed value: the score from which a dataset counts as ready.
READY_SCORE = 0.7

# The verdict texts.
METADATA_READY = "Данных достаточно, модель можно обучать (по текущим эвристикам)."
METADATA_NOT_READY = "Качество данных недостаточно, требуется доработка (по текущим эвристикам)."
DATASET_READY = "CSV выглядит достаточно качественным для обучения модели (по текущим эвристикам)."
DATASET_NOT_READY = "CSV требует доработки перед обучением модели (по текущим эвристикам)."

FLAG_NAMES = (
    "too_few_rows",
    "too_many_columns",
    "too_many_missing",
    "has_constant_columns",
    "has_high_cardinality_categoricals",
)
LIST_NAMES = ("constant_columns_list", "high_cardinality_list")

# An estimate this high cannot come from HIGH_CARDINALITY or fewer values, because each
# value touches one register of the sketch.
_SURELY_MANY = 100


class EmptyDataset(ValueError):
    """There is nothing to judge."""


def _penalty(condition: Column, amount: float) -> Column:
    return F.when(condition, F.lit(amount)).otherwise(F.lit(0.0))


def flags_from_profile(profile: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    """One row of flags, column lists and the score, from a profile frame."""
    constant = F.col("unique") <= 1
    crowded = ~F.col("is_numeric") & (F.col("unique") > HIGH_CARDINALITY)

    def listed(condition: Column) -> Column:
        found = F.array_sort(F.collect_list(F.when(condition, F.struct("ordinal", "name"))))
        return F.transform(found, lambda e: e["name"])

    worst = F.coalesce(F.max("missing_share"), F.lit(0.0)) if n_rows else F.lit(0.0)
    row = profile.agg(
        worst.alias("max_missing_share"),
        listed(constant).alias("constant_columns_list"),
        listed(crowded).alias("high_cardinality_list"),
    )
    return _score(row, n_rows, n_cols)


def _score(row: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    few, many = F.lit(n_rows < MIN_ROWS), F.lit(n_cols > MAX_COLUMNS)
    constant = F.size("constant_columns_list") > 0
    crowded = F.size("high_cardinality_list") > 0
    score = clip(
        F.lit(1.0)
        - F.col("max_missing_share")
        - _penalty(few, FEW_ROWS_PENALTY)
        - _penalty(many, MANY_COLUMNS_PENALTY)
        - _penalty(constant, CONSTANT_PENALTY)
        - _penalty(crowded, CARDINALITY_PENALTY)
    )
    return row.select(
        few.alias("too_few_rows"),
        many.alias("too_many_columns"),
        "max_missing_share",
        (F.col("max_missing_share") > MAX_MISSING).alias("too_many_missing"),
        constant.alias("has_constant_columns"),
        "constant_columns_list",
        crowded.alias("has_high_cardinality_categoricals"),
        "high_cardinality_list",
        score.alias("quality_score"),
    )


def quality_flags(df: DataFrame, stats: TableStats | None = None) -> DataFrame:
    """Flags of a table without counting every distinct value.

    The rules only ask whether a column has at most one value, or more than a handful.
    One scan answers the first from min and max and bounds the second by a sketch; exact
    counts are taken only of text columns the sketch shows to be nearly constant, where
    map-side combining leaves a few rows per task.
    """
    stats = stats or table_stats(df, estimate_distinct=True)
    n = stats.n_rows
    constant, crowded, unclear = set(), set(), []
    for c in stats.columns:
        if c.non_null == 0:
            constant.add(c.ordinal)
        elif c.low is not None:
            if c.one_value:
                constant.add(c.ordinal)
        elif c.distinct_estimate is None or c.distinct_estimate < _SURELY_MANY:
            unclear.append(c)
        else:
            crowded.add(c.ordinal)
    if unclear:
        counts = V.distinct_counts(V.value_counts(df, [c.name for c in unclear]))
        for r in counts.collect():
            c = unclear[r["c"]]
            if r["unique"] <= 1:
                constant.add(c.ordinal)
            if r["unique"] > HIGH_CARDINALITY:
                crowded.add(c.ordinal)
    worst = max(((n - c.non_null) / n for c in stats.columns), default=0.0) if n else 0.0
    names = [c.name for c in stats.columns]
    row = df.sparkSession.createDataFrame(
        [(worst, [names[i] for i in sorted(constant)], [names[i] for i in sorted(crowded)])],
        "max_missing_share double, constant_columns_list array<string>, high_cardinality_list array<string>",
    )
    return _score(row, n, stats.n_cols)


def flags_only(df: DataFrame) -> DataFrame:
    """Five flags and the two column lists; an empty table is an error."""
    stats = _require_rows(df)
    return quality_flags(df, stats).select(
        "too_few_rows", "too_many_columns", "too_many_missing", "has_constant_columns", "constant_columns_list",
        "has_high_cardinality_categoricals", "high_cardinality_list",
    )


def _require_rows(df: DataFrame) -> TableStats:
    stats = table_stats(df, estimate_distinct=True)
    if stats.n_rows == 0 or stats.n_cols == 0:
        raise EmptyDataset("the dataset holds no data")
    return stats


def _verdict(ready: Column, yes: str, no: str) -> Column:
    return F.when(ready, F.lit(yes)).otherwise(F.lit(no))


def _named_map(names: tuple[str, ...]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names]))


def assess(df: DataFrame) -> DataFrame:
    """Readiness of a table: verdict, score, message, flag map and shape."""
    stats = _require_rows(df)
    ready = F.col("quality_score") >= READY_SCORE
    return quality_flags(df, stats).select(
        ready.alias("ok_for_model"),
        "quality_score",
        _verdict(ready, DATASET_READY, DATASET_NOT_READY).alias("message"),
        _named_map(FLAG_NAMES).alias("flags"),
        F.create_map(
            F.lit("n_rows"), F.lit(stats.n_rows).cast("bigint"), F.lit("n_cols"), F.lit(stats.n_cols).cast("bigint")
        ).alias("dataset_shape"),
    )


METADATA_FLAGS = (
    "too_few_rows",
    "too_many_columns",
    "too_many_missing",
    "no_numeric_columns",
    "no_categorical_columns",
)


def valid_metadata() -> Column:
    """Whether a metadata row holds counts from zero on and a share between 0 and 1."""
    counts = [F.col(c) >= 0 for c in ("n_rows", "n_cols", "numeric_cols", "categorical_cols")]
    ok = F.col("max_missing_share").between(0.0, 1.0)
    for c in counts:
        ok = ok & c
    return F.coalesce(ok, F.lit(False))


def rejected_metadata(records: DataFrame) -> DataFrame:
    """The metadata rows that break an input range."""
    return records.where(~valid_metadata())


def score_metadata(records: DataFrame) -> DataFrame:
    """Score every valid row ``(n_rows, n_cols, max_missing_share, numeric_cols, categorical_cols)``.

    All other columns are kept, so many datasets are judged in one pass over a catalogue.
    """
    no_numbers, no_categories = F.col("numeric_cols") == 0, F.col("categorical_cols") == 0
    few, many = F.col("n_rows") < METADATA_MIN_ROWS, F.col("n_cols") > MAX_COLUMNS
    score = clip(
        F.lit(1.0)
        - F.col("max_missing_share")
        - _penalty(few, FEW_ROWS_PENALTY)
        - _penalty(many, MANY_COLUMNS_PENALTY)
        - _penalty(no_numbers & ~no_categories, ONLY_CATEGORICAL_PENALTY)
        - _penalty(no_categories & ~no_numbers, ONLY_NUMERIC_PENALTY)
    )
    ready = F.col("quality_score") >= READY_SCORE
    return (
        records.where(valid_metadata())
        .withColumns(
            {
                "quality_score": score,
                "too_few_rows": few,
                "too_many_columns": many,
                "too_many_missing": F.col("max_missing_share") > MAX_MISSING,
                "no_numeric_columns": no_numbers,
                "no_categorical_columns": no_categories,
            }
        )
        .withColumns(
            {
                "ok_for_model": ready,
                "message": _verdict(ready, METADATA_READY, METADATA_NOT_READY),
                "flags": _named_map(METADATA_FLAGS),
                "dataset_shape": F.create_map(
                    F.lit("n_rows"), F.col("n_rows").cast("bigint"), F.lit("n_cols"), F.col("n_cols").cast("bigint")
                ),
            }
        )
        .drop(*METADATA_FLAGS)
    )
