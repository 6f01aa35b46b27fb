"""The profiling report of one table: tables, plot data and a text digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.operators import categories, correlation, explore, profile, quality
from tablegauge.session import checkpoint
from tablegauge.sources import sinks

# The wording of the digest.
DEFAULT_TITLE = "EDA-отчёт"
DIGEST = """\
# {title}

Исходный файл: `{source}`

Строк: **{n_rows}**, столбцов: **{n_cols}**

## Настройки отчёта

- Top-K категорий: **{top_k}**

## Качество данных (эвристики)

- Оценка качества: **{quality_score:.2f}**
- Макс. доля пропусков по колонке: **{max_missing_share:.2%}**
- Слишком мало строк: **{too_few_rows}**
- Слишком много колонок: **{too_many_columns}**
- Слишком много пропусков: **{too_many_missing}**

{lists}
## Колонки

См. файл `summary.csv`.

## Пропуски

{gaps}

## Корреляция числовых признаков

{correlation}

## Категориальные признаки

{categories}

## Гистограммы числовых колонок

См. файлы `hist_*.png`."""
CONSTANT_LINE = "- Константные колонки: Да. Список: {}\n"
CARDINALITY_LINE = "- Высокая кардинальность: Да. Список: {}\n"
NO_GAPS = "Пропусков нет или датасет пуст."
SEE_GAPS = "См. файлы `missing.csv` и `missing_matrix.png`."
NO_CORRELATION = "Недостаточно числовых колонок для корреляции."
SEE_CORRELATION = "См. `correlation.csv` и `correlation_heatmap.png`."
NO_CATEGORIES = "Категориальные/строковые признаки не найдены."
SEE_CATEGORIES = "См. файлы в папке `top_categories/`."


def digest(
    flags: dict,
    source: str,
    n_rows: int,
    n_cols: int,
    has_gap_table: bool,
    has_correlation: bool,
    has_categories: bool,
    title: str = DEFAULT_TITLE,
    top_k: int = 5,
) -> list[str]:
    """The digest as lines, from the one row of flags; column lists only where flagged."""
    lists = ""
    if flags["has_constant_columns"]:
        lists += CONSTANT_LINE.format(list(flags["constant_columns_list"]))
    if flags["has_high_cardinality_categoricals"]:
        lists += CARDINALITY_LINE.format(list(flags["high_cardinality_list"]))
    text = DIGEST.format(
        **flags,
        title=title,
        source=source,
        n_rows=n_rows,
        n_cols=n_cols,
        top_k=top_k,
        lists=lists,
        gaps=SEE_GAPS if has_gap_table else NO_GAPS,
        correlation=SEE_CORRELATION if has_correlation else NO_CORRELATION,
        categories=SEE_CATEGORIES if has_categories else NO_CATEGORIES,
    )
    return text.split("\n")


def write_report(
    df: DataFrame,
    source: str,
    out_dir: str,
    order_by: Column | None = None,
    max_hist_columns: int = 6,
    title: str = DEFAULT_TITLE,
    top_k: int = 5,
) -> DataFrame:
    """Write all report tables below ``out_dir`` and return the flags row.

    The table statistics are scanned once and shared by profile, gaps and flags.
    """
    stats = profile.table_stats(df, estimate_distinct=True)
    summary = checkpoint(profile.summarize(df, order_by, stats=stats))
    flags = quality.flags_from_profile(summary, stats.n_rows, stats.n_cols)
    sinks.write_table(profile.flat_summary(summary.orderBy("ordinal")), f"{out_dir}/summary", few_rows=True)
    gaps = sinks.write_unless_empty(profile.missing_table(df, stats), f"{out_dir}/missing", few_rows=True)
    matrix = correlation.correlation_wide(df)
    correlated = sinks.write_unless_empty(matrix, f"{out_dir}/correlation", few_rows=True)
    top = categories.top_categories(df, top_k=top_k, order_by=order_by)
    listed = sinks.write_top_categories(top, f"{out_dir}/top_categories")
    bars = explore.histograms(df, max_columns=max_hist_columns)
    sinks.write_unless_empty(bars, f"{out_dir}/histograms", few_rows=True)
    if order_by is not None:
        sinks.write_unless_empty(explore.missing_matrix(df, order_by), f"{out_dir}/missing_matrix")
    row = flags.first().asDict()
    text = digest(row, source, stats.n_rows, stats.n_cols, gaps, correlated, listed, title, top_k)
    sinks.write_text(df.sparkSession, text, f"{out_dir}/report")
    return flags


def report_tables(df: DataFrame, order_by: Column | None = None, top_k: int = 5) -> DataFrame:
    """The cells of the summary, gap, correlation and category tables in one long frame."""
    stats = profile.table_stats(df, estimate_distinct=True)
    summary = profile.summarize(df, order_by, stats=stats)
    parts = [
        summary.select(F.lit("summary").alias("part"), "name", F.lit("unique").alias("item"), F.col("unique").cast("double").alias("value")),
        profile.missing_table(df, stats).select(
            F.lit("missing"), "column", F.lit("missing_share"), "missing_share"
        ),
        correlation.correlation_matrix(df).select(F.lit("correlation"), "column_a", "column_b", "corr"),
        categories.top_categories(df, top_k=top_k, order_by=order_by).select(
            F.lit("top_categories"), "column", "value", "share"
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
