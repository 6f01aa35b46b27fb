"""Reading and writing: delimited text, report tables, records, labels and models."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import query, rounded
from tablegauge.catalog.inspection import _flat_flags, _flags_sql, _shown
from tablegauge.catalog.learning import FEATURES, _sides
from tablegauge.catalog.sqltext import CUSTOMER, ORDERS, profile_sql, top_sql, union_all
from tablegauge.operators import metrics, models, profile
from tablegauge.plans import report
from tablegauge.session import scratch_path
from tablegauge.sources import load_table, read_delimited, sinks

_RAW_SQL = """(SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders)"""
_RAW_COLUMNS = [(n, "text" if k == "day" else k) for n, k in ORDERS]


def _orders_as_text(spark: SparkSession, folder: str) -> str:
    """Write orders as text with several spellings of a gap; returns the path."""
    path = scratch_path(spark, "orders-text")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = load_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_custkey") == 7, "NA").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 3 == 0, "NULL").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        day.alias("o_orderdate"),
        "o_orderpriority",
    )
    orders.write.option("header", True).option("sep", ";").csv(path)
    return path


@query("s1_s2_delimited_profile", profile_sql(_RAW_SQL, _RAW_COLUMNS, "o_orderkey"))
def delimited(spark: SparkSession, folder: str) -> DataFrame:
    df = read_delimited(spark, _orders_as_text(spark, folder), sep=";")
    return _shown(profile.summarize(df, F.col("o_orderkey")))


def _report(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "report")
    customers = load_table(spark, folder, "customer")
    return path, report.write_report(customers, "customer.parquet", path, F.col("c_custkey"))


@query("s3_s7_report_flags", _flags_sql("customer", CUSTOMER))
def report_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_flags(_report(spark, folder)[1])


@query(
    "s6_report_top_categories",
    f"""SELECT "column", value, "count", share FROM ({top_sql("customer", ["c_name", "c_mktsegment"], "c_custkey")})""",
)
def report_top(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _report(spark, folder)
    written = spark.read.option("header", True).csv(f"{path}/top_categories")
    return rounded(
        written.select(
            "column", "value", F.col("count").cast("bigint").alias("count"), F.col("share").cast("double").alias("share")
        )
    )


_REPORT_NUMBERS = ("c_custkey", "c_nationkey", "c_acctbal")


@query(
    "s3_report_summary_file",
    f"SELECT * EXCLUDE (ordinal, examples) FROM ({profile_sql('customer', CUSTOMER, 'c_custkey')})",
)
def report_summary_file(spark: SparkSession, folder: str) -> DataFrame:
    """The summary as it stands in the report's file."""
    path, _ = _report(spark, folder)
    schema = (
        "name string, dtype string, non_null bigint, missing bigint, missing_share double, `unique` bigint, "
        "is_numeric boolean, min double, max double, mean double, std double"
    )
    return rounded(_written(spark, f"{path}/summary", schema), 4)


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


@query(
    "s4_report_missing_file",
    union_all(
        [
            f"""SELECT '{n}' AS "column", count(*) - count({n}) AS missing_count,
              round((count(*) - count({n})) / count(*)::DOUBLE, 6) AS missing_share FROM customer"""
            for n, _ in CUSTOMER
        ]
    ),
)
def report_missing_file(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _report(spark, folder)
    return rounded(_written(spark, f"{path}/missing", "column string, missing_count bigint, missing_share double"))


@query(
    "s5_report_correlation_file",
    union_all(
        [
            f"""SELECT '{a}' AS "column", {", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in _REPORT_NUMBERS)} FROM customer"""
            for a in _REPORT_NUMBERS
        ]
    ),
)
def report_correlation_file(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _report(spark, folder)
    schema = "column string, " + ", ".join(f"{n} double" for n in _REPORT_NUMBERS)
    return rounded(_written(spark, f"{path}/correlation", schema))


def _digest_sql() -> str:
    """The lines of the digest with all numbers from SQL; the wording is the report's."""

    def said(flag: str) -> str:
        return f"CASE WHEN {flag} THEN 'True' ELSE 'False' END"

    def line(flag: str, text: str, names: str) -> str:
        quoted = f"'[''' || replace({names}, ',', ''', ''') || ''']'"
        whole = text.replace("\n", "' || chr(10) || '").replace("{}", f"' || {quoted} || '")
        return f"CASE WHEN {flag} THEN '{whole}' ELSE '' END"

    constant = line("has_constant_columns", report.CONSTANT_LINE, "constant_columns_list")
    crowded = line("has_high_cardinality_categoricals", report.CARDINALITY_LINE, "high_cardinality_list")
    values = {
        "title": f"'{report.DEFAULT_TITLE}'",
        "source": "'customer.parquet'",
        "top_k": "'5'",
        "n_cols": f"'{len(CUSTOMER)}'",
        "n_rows": "(SELECT count(*) FROM customer)",
        "quality_score": "printf('%.2f', quality_score)",
        "max_missing_share": "printf('%.2f', 100 * max_missing_share) || '%'",
        "lists": f"{constant} || {crowded}",
        "gaps": f"'{report.SEE_GAPS}'",
        "correlation": f"'{report.SEE_CORRELATION}'",
        "categories": f"'{report.SEE_CATEGORIES}'",
    }
    values |= {c: said(c) for c in ("too_few_rows", "too_many_columns", "too_many_missing")}
    text = re.sub(r"\{(\w+)[^}]*\}", lambda m: f"' || {values[m[1]]} || '", report.DIGEST)
    return f"""WITH d AS (SELECT string_split('{text}', chr(10)) AS lines FROM ({_flags_sql("customer", CUSTOMER)}))
      SELECT CAST(i AS INTEGER) AS line, lines[i + 1] AS text FROM (SELECT lines, unnest(range(len(lines))) AS i FROM d)"""


@query("s7_report_digest_file", _digest_sql())
def report_digest_file(spark: SparkSession, folder: str) -> DataFrame:
    """The digest's lines as they stand in its file."""
    path, _ = _report(spark, folder)
    whole = spark.read.text(f"{path}/report", wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("line", "text"))


@query(
    "s4_s5_report_tables",
    union_all(
        [
            f"""SELECT 'missing' AS part, '{n}' AS name, 'missing_share' AS item,
              round((count(*) - count({n})) / count(*)::DOUBLE, 6) AS value FROM customer"""
            for n, _ in CUSTOMER
        ]
        + [
            f"""SELECT 'correlation', '{a}', '{b}', round(corr({a}, {b}), 6) FROM customer"""
            for a in _REPORT_NUMBERS
            for b in _REPORT_NUMBERS
        ]
        + [f"""SELECT 'summary', '{n}', 'unique', count(DISTINCT {n})::DOUBLE FROM customer""" for n, _ in CUSTOMER]
        + [
            f"""SELECT 'top_categories', "column", value, share FROM
              ({top_sql("customer", ["c_name", "c_mktsegment"], "c_custkey")})"""
        ]
    ),
)
def report_tables(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report.report_tables(load_table(spark, folder, "customer"), F.col("c_custkey")))


@query(
    "s8_metric_records",
    """SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy,
      round(2.0 * count(*) FILTER (WHERE quality = 1 AND toxic = 1) / (2.0 * count(*) FILTER (WHERE quality = 1 AND toxic = 1)
        + count(*) FILTER (WHERE (quality = 1) <> (toxic = 1))), 6)::DOUBLE AS f1 FROM labels""",
)
def records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    labels = load_table(spark, folder, "labels")
    sinks.write_records(labels.agg(*metrics.label_metrics(F.col("quality"), F.col("toxic"))), path)
    return rounded(spark.read.json(path).select("accuracy", "f1"))


@query("s9_label_export", "SELECT vec_id AS sample_id, label AS cluster_label FROM embeddings")
def label_export(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    sinks.write_labels(load_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label"), path)
    return spark.read.option("header", True).schema("sample_id bigint, cluster_label int").csv(path)


@query(
    "s10_saved_model",
    "SELECT CAST(ceil(0.25 * count(*)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_different FROM labels JOIN documents USING (doc_id)",
)
def saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """Rows on which a model read back from disk disagrees with the original: none."""
    train, test = _sides(spark, folder)
    model = models.fit_logistic(train, FEATURES)
    path = scratch_path(spark, "model")
    sinks.save_model(model, path)
    fresh = models.predict(PipelineModel.load(path), test).select("doc_id", F.col("score").alias("again"))
    both = models.predict(model, test).join(fresh, "doc_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("score") - F.col("again")) > 1e-12).alias("n_different"))
