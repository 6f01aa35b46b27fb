"""Writers for tables, metric records, digests and models."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

from tablegauge.session import checkpoint


def write_table(df: DataFrame, path: str, fmt: str = "csv", few_rows: bool = False) -> None:
    """Replace ``path`` by the rows of ``df``; ``few_rows`` puts them into one file."""
    out = (df.coalesce(1) if few_rows else df).write.mode("overwrite")
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    out.format(fmt).save(path)


def write_unless_empty(df: DataFrame, path: str, fmt: str = "csv", few_rows: bool = False) -> bool:
    """Write ``df`` and tell so, or write nothing if it has no rows; it is worked out once."""
    df = checkpoint(df)
    if df.isEmpty():
        return False
    write_table(df, path, fmt, few_rows)
    return True


def write_top_categories(top: DataFrame, path: str) -> bool:
    """One folder ``column=<name>`` per column, holding value, count and share in rank order."""
    top = checkpoint(top)
    if top.isEmpty():
        return False
    (
        top.repartition("column")
        .sortWithinPartitions("ordinal", "rank")
        .select("column", "value", "count", "share")
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .partitionBy("column")
        .csv(path)
    )
    return True


def write_records(df: DataFrame, path: str) -> None:
    """Metric and settings rows as JSON lines."""
    write_table(df, path, "json", few_rows=True)


def write_labels(labels: DataFrame, path: str) -> None:
    """``(sample_id, cluster_label)`` of a clustering."""
    write_table(labels.selectExpr("id as sample_id", "label as cluster_label"), path)


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)
