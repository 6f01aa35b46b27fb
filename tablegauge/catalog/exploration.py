"""Filters, duplicates, group tables, bins and plot data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import query, rounded
from tablegauge.catalog.inspection import GAPS_SQL, with_gaps
from tablegauge.catalog.sqltext import histogram_sql, union_all
from tablegauge.operators import explore
from tablegauge.sources import load_table


@query("f1_above_bound", "SELECT event_id, value FROM events WHERE value > 30")
def above(spark: SparkSession, folder: str) -> DataFrame:
    return explore.above(load_table(spark, folder, "events"), "value", 30).select("event_id", "value")


@query("f2_below_bound", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def below(spark: SparkSession, folder: str) -> DataFrame:
    return explore.below(load_table(spark, folder, "customer"), "c_acctbal", 0).select("c_custkey", "c_acctbal")


@query(
    "f3_contradiction",
    "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity > 40 AND l_discount = 0",
)
def contradiction(spark: SparkSession, folder: str) -> DataFrame:
    items = load_table(spark, folder, "lineitem")
    conditions = explore.compare(items, "l_quantity", ">", 40), explore.compare(items, "l_discount", "==", 0)
    return explore.contradiction(items, *conditions).select(
        "l_orderkey", "l_quantity", "l_discount"
    )


@query("f4_equal_to", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def equal_to(spark: SparkSession, folder: str) -> DataFrame:
    return explore.equal_to(load_table(spark, folder, "events"), "event_type", "click").select(
        "event_id", "event_type", "value"
    )


@query("f5_without_missing", f"SELECT l_orderkey, l_quantity FROM {GAPS_SQL} WHERE l_quantity IS NOT NULL")
def without_missing(spark: SparkSession, folder: str) -> DataFrame:
    items = with_gaps(load_table(spark, folder, "lineitem"))
    return explore.without_missing(items, "l_quantity").select("l_orderkey", "l_quantity")


@query(
    "f6_without_noise",
    "SELECT vec_id, CASE WHEN label = 0 THEN -1 ELSE label END AS label FROM embeddings WHERE label <> 0",
)
def without_noise(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load_table(spark, folder, "embeddings")
    marked = vectors.select("vec_id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("label"))
    return explore.without_noise(marked)


@query(
    "f3_rule_check",
    union_all(
        [
            f"SELECT '{rule}' AS rule, l_orderkey, l_quantity, l_discount FROM lineitem WHERE {condition}"
            for rule, condition in (
                ("huge_quantity", "l_quantity > 45"),
                ("no_tax", "l_tax = 0"),
                ("early_return", "l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1996-01-01'"),
            )
        ]
    ),
)
def rule_check(spark: SparkSession, folder: str) -> DataFrame:
    items = load_table(spark, folder, "lineitem")
    rules = {
        "huge_quantity": explore.compare(items, "l_quantity", ">", 45),
        "no_tax": explore.compare(items, "l_tax", "==", 0),
        "early_return": (F.col("l_returnflag") == "R") & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")),
    }
    return explore.rule_check(items, rules).select(
        "rule", "l_orderkey", "l_quantity", "l_discount"
    )


@query(
    "f7_duplicated_events",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type, floor(value) ORDER BY event_id) > 1
              AS duplicated FROM events""",
)
def duplicated(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events").select("event_id", "user_id", "event_type", F.floor("value").alias("value"))
    return explore.flag_duplicates(events, "event_id").select("event_id", "duplicated")


@query(
    "f7_duplicated_texts",
    "SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS duplicated FROM documents",
)
def duplicated_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents")
    return explore.flag_duplicates(docs, "doc_id", ["text", "lang"]).select("doc_id", "duplicated")


@query("a1_value_counts", 'SELECT event_type AS value, count(*) AS "count" FROM events GROUP BY 1')
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return explore.value_counts(load_table(spark, folder, "events"), "event_type")


@query(
    "a2_x3_class_shares",
    'SELECT quality AS value, count(*) AS "count", round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percent '
    "FROM labels GROUP BY 1",
)
def class_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.class_shares(load_table(spark, folder, "labels"), "quality"))


@query(
    "a3_x1_group_table",
    """SELECT c_mktsegment, round_even(avg(c_acctbal), 2)::DOUBLE AS avg_balance,
        round_even(sum(c_acctbal), 2)::DOUBLE AS total_balance,
        count(c_custkey) AS customers FROM customer GROUP BY 1""",
)
def group_table(spark: SparkSession, folder: str) -> DataFrame:
    return explore.group_table(
        load_table(spark, folder, "customer"),
        "c_mktsegment",
        {"avg_balance": ("c_acctbal", "mean"), "total_balance": ("c_acctbal", "sum"), "customers": ("c_custkey", "count")},
    )


_BIN = """CASE WHEN l_quantity >= 0 AND l_quantity < 10 THEN '0-10' WHEN l_quantity >= 10 AND l_quantity < 20 THEN '11-20'
  WHEN l_quantity >= 20 AND l_quantity < 50 THEN '21-50' END"""


@query(
    "a4_d1_binned_table",
    f"""SELECT bin, count(l_orderkey) AS items, round_even(avg(l_extendedprice), 2)::DOUBLE AS avg_price FROM
     (SELECT *, {_BIN} AS bin FROM {GAPS_SQL}) WHERE bin IS NOT NULL GROUP BY bin""",
)
def binned(spark: SparkSession, folder: str) -> DataFrame:
    return explore.binned_table(
        with_gaps(load_table(spark, folder, "lineitem")),
        "l_quantity",
        [0, 10, 20, 50],
        ["0-10", "11-20", "21-50"],
        {"items": ("l_orderkey", "count"), "avg_price": ("l_extendedprice", "mean")},
    )


_HIST = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("d2_histograms", histogram_sql(GAPS_SQL, _HIST, 20))
def histograms(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.histograms(with_gaps(load_table(spark, folder, "lineitem"))))


@query("d3_histogram_ten_bins", histogram_sql("customer", ["c_acctbal"], 10))
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.histograms(load_table(spark, folder, "customer"), bins=10, columns=["c_acctbal"]))


_MATRIX_SQL = """(SELECT event_id, nullif(user_id, 7) AS user_id, nullif(event_type, 'view') AS event_type,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events)"""


@query(
    "d4_missing_matrix",
    f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS r, count(*) OVER () AS n FROM {_MATRIX_SQL}),
    b AS (SELECT *, CAST(len(list_filter(range(1, 20), lambda k: r >= (n * k) // 20)) AS INTEGER) AS band FROM t)
    """
    + union_all(
        [
            f"""SELECT band, count(*) AS n_rows, '{c}' AS "column",
              round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS missing_share FROM b GROUP BY band"""
            for c in ("event_id", "user_id", "event_type", "value")
        ]
    ),
)
def missing_matrix(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events").select(
        "event_id",
        F.nullif("user_id", F.lit(7)).alias("user_id"),
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
    )
    return rounded(explore.missing_matrix(events, F.col("event_id"), bands=20))


_BOX = """WITH q AS (SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
  v AS (SELECT e.event_type, n, q1, median, q3, value,
    value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM events e JOIN q ON e.event_type = q.event_type WHERE value IS NOT NULL)"""


@query(
    "d6_box_stats",
    f"""{_BOX} SELECT event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      round(least(q1, min(value) FILTER (WHERE inside)), 6) AS whisker_low,
      round(greatest(q3, max(value) FILTER (WHERE inside)), 6) AS whisker_high,
      count(*) FILTER (WHERE NOT inside) AS n_outliers FROM v GROUP BY event_type, n, q1, median, q3""",
)
def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.box_stats(load_table(spark, folder, "events"), "event_type", "value"))


@query("d6_box_outliers", f"{_BOX} SELECT event_type, value FROM v WHERE NOT inside")
def box_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return explore.box_outliers(load_table(spark, folder, "events"), "event_type", "value")


@query(
    "d7_scatter_series",
    "SELECT c_mktsegment AS series, c_nationkey AS x, c_acctbal AS y FROM customer",
)
def scatter(spark: SparkSession, folder: str) -> DataFrame:
    return explore.scatter_series(load_table(spark, folder, "customer"), "c_nationkey", "c_acctbal", "c_mktsegment")
