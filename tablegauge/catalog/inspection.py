"""Profiles, gap tables, correlation, categories and quality verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import query, rounded
from tablegauge.catalog.sqltext import (
    CUSTOMER,
    DOCUMENTS,
    LINEITEM,
    ORDERS,
    profile_sql,
    top_sql,
    union_all,
)
from tablegauge.operators import categories, correlation, profile, quality
from tablegauge.operators.clustering import points_from_array
from tablegauge.sources import load_table

# No given table has gaps, so some queries blank out fixed values of lineitem.
GAPS_SQL = """(SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber, nullif(l_quantity, 1.0) AS l_quantity,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount, l_tax,
  nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus FROM lineitem)"""
GAPS_COLUMNS = [
    ("l_orderkey", "int"), ("l_linenumber", "int"), ("l_quantity", "float"), ("l_extendedprice", "float"),
    ("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "text"), ("l_linestatus", "text"),
]
LINE_ORDER = "l_orderkey * 10 + l_linenumber"


def with_gaps(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey",
        F.nullif("l_linenumber", F.lit(3)).alias("l_linenumber"),
        F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"),
        F.when(F.col("l_suppkey") % 4 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        "l_linestatus",
    )


def _shown(p: DataFrame) -> DataFrame:
    """A profile with its examples as one text, for comparison."""
    p = p.withColumn("examples", F.nullif(F.array_join("example_values", "|"), F.lit(""))).drop("example_values")
    return rounded(p, 4)


def _profile(name: str, order: str | None):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        order_by = None if order is None else F.expr(order)
        return _shown(profile.summarize(load_table(spark, folder, name), order_by))

    return run


query("a5_profile_lineitem", profile_sql("lineitem", LINEITEM, LINE_ORDER))(
    _profile("lineitem", LINE_ORDER)
)
query("a5_profile_orders", profile_sql("orders", ORDERS, "o_orderkey"))(_profile("orders", "o_orderkey"))
query("a5_profile_customer_unordered", profile_sql("customer", CUSTOMER, None))(_profile("customer", None))
query("a5_profile_documents", profile_sql("documents", DOCUMENTS, "doc_id"))(_profile("documents", "doc_id"))


@query("a5_profile_lineitem_gaps", profile_sql(GAPS_SQL, GAPS_COLUMNS, "l_orderkey"))
def profile_gaps(spark: SparkSession, folder: str) -> DataFrame:
    df = with_gaps(load_table(spark, folder, "lineitem"))
    return _shown(profile.summarize(df, F.col("l_orderkey")))


@query(
    "a5_quick_summary_lineitem",
    f"""SELECT * EXCLUDE ("unique", examples) FROM ({profile_sql("lineitem", LINEITEM, None)})""",
)
def quick(spark: SparkSession, folder: str) -> DataFrame:
    """The single-scan profile; its distinct counts are estimates and not compared."""
    summary = profile.quick_summary(load_table(spark, folder, "lineitem"))
    return rounded(summary.drop("unique", "example_values"), 4)


@query(
    "a5_dataset_record_orders",
    "SELECT count(*) AS n_rows, 6 AS n_cols, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,"
    "o_orderpriority' AS names, count(DISTINCT o_custkey) AS unique_customers FROM orders",
)
def record(spark: SparkSession, folder: str) -> DataFrame:
    r = profile.dataset_record(load_table(spark, folder, "orders"), F.col("o_orderkey"))
    return r.select(
        "n_rows",
        "n_cols",
        F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("names"),
        F.col("columns")[1]["unique"].alias("unique_customers"),
    )


def _without(sql: str, columns: str) -> str:
    return f"SELECT * EXCLUDE ({columns}) FROM ({sql})"


@query("a9_flat_summary_customer", _without(profile_sql("customer", CUSTOMER, None), "ordinal, examples"))
def flat(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.flat_summary(profile.summarize(load_table(spark, folder, "customer"))), 4)


@query(
    "a10_overview_orders",
    f"""SELECT (SELECT count(*) FROM orders) AS n_rows, 6 AS n_cols, *
          FROM ({_without(profile_sql("orders", ORDERS, None), "ordinal, examples")})""",
)
def overview(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.overview(load_table(spark, folder, "orders")), 4)


_MISSING = union_all(
    [
        f"""SELECT '{n}' AS "column", count(*) - count({n}) AS missing_count,
                round((count(*) - count({n})) / count(*)::DOUBLE, 6) AS missing_share FROM {GAPS_SQL}"""
        for n, _ in GAPS_COLUMNS
    ]
)


@query("a6_t1_missing_table", _MISSING)
def missing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.missing_table(with_gaps(load_table(spark, folder, "lineitem"))))


@query(
    "i1_first_rows",
    "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5",
)
def head(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events")
    return profile.first_rows(profile.project(events, ["event_id", "user_id", "event_type", "value"]), 5, "event_id")


_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END"""


@query(
    "i2_schema_info",
    union_all(
        [
            f"""SELECT {i} AS ordinal, '{n}' AS "column",
              (SELECT {_TYPES} FROM (DESCRIBE orders) WHERE column_name = '{n}') AS "type",
              count({n}) AS non_null FROM orders"""
            for i, (n, _) in enumerate(ORDERS)
        ]
    ),
)
def info(spark: SparkSession, folder: str) -> DataFrame:
    return profile.schema_info(load_table(spark, folder, "orders"))


def _describe_sql(source: str, columns: list[str]) -> str:
    return union_all(
        [
            f"""SELECT '{n}' AS "column", count({n}) AS "count", round(avg({n}), 4) AS "mean",
              round(stddev_samp({n}), 4) AS "std", round(min({n})::DOUBLE, 4) AS "min",
              round(quantile_cont({n}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({n}::DOUBLE, 0.5), 4) AS q50,
              round(quantile_cont({n}::DOUBLE, 0.75), 4) AS q75, round(max({n})::DOUBLE, 4) AS "max" FROM {source}"""
            for n in columns
        ]
    )


@query("i3_describe_lineitem", _describe_sql("lineitem", [n for n, k in LINEITEM if k in ("int", "float")]))
def describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(load_table(spark, folder, "lineitem")), 4)


@query("i3_describe_gaps", _describe_sql(GAPS_SQL, [n for n, k in GAPS_COLUMNS if k in ("int", "float")]))
def describe_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(with_gaps(load_table(spark, folder, "lineitem"))), 4)


@query(
    "i4_missing_counts",
    union_all(
        [
            f"""SELECT {i} AS ordinal, '{n}' AS "column", count(*) - count({n}) AS missing FROM {GAPS_SQL}"""
            for i, (n, _) in enumerate(GAPS_COLUMNS)
        ]
    ),
)
def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_counts(with_gaps(load_table(spark, folder, "lineitem")))


@query(
    "i5_missing_shares",
    union_all(
        [
            f"""SELECT {i} AS ordinal, '{n}' AS "column",
              round((count(*) - count({n})) / count(*)::DOUBLE, 6) AS missing_share FROM {GAPS_SQL}"""
            for i, (n, _) in enumerate(GAPS_COLUMNS)
        ]
    ),
)
def missing_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.missing_shares(with_gaps(load_table(spark, folder, "lineitem"))))


@query("i6_column_types", f"""SELECT column_name AS "column", {_TYPES} AS "type" FROM (DESCRIBE lineitem)""")
def types(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_types(load_table(spark, folder, "lineitem"))


@query(
    "i6_type_counts",
    f"""SELECT {_TYPES} AS "type", count(*) AS n_columns FROM (DESCRIBE lineitem) GROUP BY 1""",
)
def type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.type_counts(load_table(spark, folder, "lineitem"))


@query("i7_shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(load_table(spark, folder, "lineitem"))


@query("i8_column_range", 'SELECT min(c_acctbal) AS "min", max(c_acctbal) AS "max" FROM customer')
def value_range(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_range(load_table(spark, folder, "customer"), "c_acctbal")


@query("i9_projection", "SELECT c_custkey, c_acctbal FROM customer")
def projection(spark: SparkSession, folder: str) -> DataFrame:
    return profile.project(load_table(spark, folder, "customer"), ["c_custkey", "c_acctbal"])


@query("i10_drop_columns", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def dropped(spark: SparkSession, folder: str) -> DataFrame:
    return profile.drop_columns(load_table(spark, folder, "customer"), ["c_custkey", "c_name"])


@query("i11_t3_numbers_only", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numbers(spark: SparkSession, folder: str) -> DataFrame:
    return profile.numbers_only(load_table(spark, folder, "part"))


@query(
    "i12_distinct_in_order",
    "SELECT event_type, min(event_id) AS first_seen FROM events GROUP BY event_type ORDER BY first_seen",
)
def distinct_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_in_order(load_table(spark, folder, "events"), "event_type", F.col("event_id"))


def _corr_sql(source: str, columns: list[str]) -> str:
    parts = []
    for a in columns:
        for b in columns:
            parts.append(
                f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
                round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 6) AS corr FROM {source}"""
            )
    return union_all(parts)


_NUMBERS = [n for n, k in LINEITEM if k in ("int", "float")]
_GAP_NUMBERS = [n for n, k in GAPS_COLUMNS if k in ("int", "float")]


@query("a7_correlation_lineitem", _corr_sql("lineitem", _NUMBERS))
def corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.correlation_matrix(load_table(spark, folder, "lineitem")))


@query("a7_d5_correlation_heatmap_gaps", _corr_sql(GAPS_SQL, _GAP_NUMBERS))
def corr_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation.heatmap(with_gaps(load_table(spark, folder, "lineitem"))))


_CONSTANT_SQL = "(SELECT o_totalprice, o_custkey, 7 AS seven, CAST(NULL AS DOUBLE) AS nothing FROM orders)"


@query(
    "a7_correlation_constant_column",
    _corr_sql(_CONSTANT_SQL, ["o_totalprice", "o_custkey", "seven", "nothing"]),
)
def corr_constant(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select(
        "o_totalprice", "o_custkey", F.lit(7).alias("seven"), F.lit(None).cast("double").alias("nothing")
    )
    return rounded(correlation.correlation_matrix(orders))


@query(
    "a7_correlation_wide_embeddings",
    """WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT 'x' || CAST(a.i - 1 AS VARCHAR) AS column_a, 'x' || CAST(b.i - 1 AS VARCHAR) AS column_b,
           round(corr(a.v, b.v), 6) AS corr
      FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.i, b.i""",
)
def corr_wide(spark: SparkSession, folder: str) -> DataFrame:
    points = points_from_array(load_table(spark, folder, "embeddings"), "vec_id", "embedding")
    return rounded(correlation.correlation_matrix(points.select(*[F.col("x")[i].alias(f"x{i}") for i in range(64)])))


@query("a8_t2_top_categories_documents", top_sql("documents", ["text", "lang", "source"], "doc_id"))
def top_documents(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(categories.top_categories(load_table(spark, folder, "documents"), order_by=F.col("doc_id")))


@query("a8_top_categories_orders", top_sql("orders", ["o_orderstatus", "o_orderpriority"], "o_orderkey", 3))
def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    df = load_table(spark, folder, "orders")
    return rounded(categories.top_categories(df, top_k=3, order_by=F.col("o_orderkey")))


@query("a8_top_categories_gaps", top_sql(GAPS_SQL, ["l_returnflag", "l_linestatus"], "l_orderkey", 2))
def top_gaps(spark: SparkSession, folder: str) -> DataFrame:
    df = with_gaps(load_table(spark, folder, "lineitem"))
    return rounded(categories.top_categories(df, top_k=2, order_by=F.col("l_orderkey")))


def _flags_sql(source: str, columns: list[tuple[str, str]]) -> str:
    """Flags and score of a table, by the dataset rules."""
    cols = union_all(
        [
            f"""SELECT {i} AS ordinal, '{n}' AS name, {"true" if k in ("int", "float") else "false"} AS is_numeric,
            count(DISTINCT {n}) AS u, (count(*) - count({n})) / count(*)::DOUBLE AS m, count(*) AS n_rows FROM {source}"""
            for i, (n, k) in enumerate(columns)
        ]
    )
    return f"""SELECT n_rows < 100 AS too_few_rows, n_cols > 100 AS too_many_columns,
       round(mm, 6) AS max_missing_share, mm > 0.5 AS too_many_missing,
       constants <> '' AS has_constant_columns, constants AS constant_columns_list,
       crowded <> '' AS has_high_cardinality_categoricals, crowded AS high_cardinality_list,
       round(greatest(0.0, least(1.0, 1.0 - mm - CASE WHEN n_rows < 100 THEN 0.2 ELSE 0.0 END
         - CASE WHEN n_cols > 100 THEN 0.1 ELSE 0.0 END - CASE WHEN constants <> '' THEN 0.15 ELSE 0.0 END
         - CASE WHEN crowded <> '' THEN 0.05 ELSE 0.0 END))::DOUBLE, 6) AS quality_score
  FROM (SELECT max(n_rows) AS n_rows, count(*) AS n_cols, max(m) AS mm,
               coalesce(string_agg(name, ',' ORDER BY ordinal) FILTER (WHERE u <= 1), '') AS constants,
               coalesce(string_agg(name, ',' ORDER BY ordinal) FILTER (WHERE NOT is_numeric AND u > 5), '') AS crowded
          FROM ({cols}))"""


def _flat_flags(flags: DataFrame) -> DataFrame:
    return rounded(
        flags.withColumns({c: F.array_join(c, ",") for c in ("constant_columns_list", "high_cardinality_list")})
    )


@query("q1_quality_flags_lineitem_gaps", _flags_sql(GAPS_SQL, GAPS_COLUMNS))
def flags_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_flags(quality.quality_flags(with_gaps(load_table(spark, folder, "lineitem"))))


@query("q1_flags_from_profile_orders", _flags_sql("orders", ORDERS))
def flags_profile(spark: SparkSession, folder: str) -> DataFrame:
    df = load_table(spark, folder, "orders")
    stats = profile.table_stats(df)
    return _flat_flags(quality.flags_from_profile(profile.summarize(df, stats=stats), stats.n_rows, stats.n_cols))


_CONST_SQL = "(SELECT *, 'X' AS status, CAST(NULL AS VARCHAR) AS remark FROM customer)"
# A column without any value reads as a number.
_CONST_COLUMNS = [*CUSTOMER, ("status", "text"), ("remark", "float")]


@query("q1_quality_flags_constant_columns", _flags_sql(_CONST_SQL, _CONST_COLUMNS))
def flags_constant(spark: SparkSession, folder: str) -> DataFrame:
    df = load_table(spark, folder, "customer")
    df = df.withColumns({"status": F.lit("X"), "remark": F.lit(None).cast("string")})
    return _flat_flags(quality.quality_flags(df))


_CATALOGUE_SQL = """(SELECT l_suppkey AS dataset, count(*) * 3 AS n_rows, CAST(count(DISTINCT l_shipdate) AS BIGINT) AS n_cols,
  round(avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END), 9) AS max_missing_share,
  count(*) FILTER (WHERE l_linenumber = 1 AND l_returnflag = 'A' AND l_quantity < 3) AS numeric_cols,
  count(*) FILTER (WHERE l_linenumber = 2 AND l_returnflag = 'R' AND l_quantity < 3) AS categorical_cols
  FROM lineitem GROUP BY l_suppkey)"""


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """One metadata row per supplier, with figures taken from its items."""
    q = F.col("l_quantity")

    def few(number: int, flag: str):
        return F.count_if((F.col("l_linenumber") == number) & (F.col("l_returnflag") == flag) & (q < 3))

    return (
        load_table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("dataset"))
        .agg(
            (F.count(F.lit(1)) * 3).alias("n_rows"),
            F.count_distinct("l_shipdate").alias("n_cols"),
            F.round(F.avg(F.when(q > 25, 1.0).otherwise(0.0)), 9).alias("max_missing_share"),
            few(1, "A").alias("numeric_cols"),
            few(2, "R").alias("categorical_cols"),
        )
    )


_SCORE = """greatest(0.0, least(1.0, 1.0 - max_missing_share - CASE WHEN n_rows < 1000 THEN 0.2 ELSE 0.0 END
  - CASE WHEN n_cols > 100 THEN 0.1 ELSE 0.0 END
  - CASE WHEN numeric_cols = 0 AND categorical_cols > 0 THEN 0.1 ELSE 0.0 END
  - CASE WHEN categorical_cols = 0 AND numeric_cols > 0 THEN 0.05 ELSE 0.0 END))"""


@query(
    "q2_x2_score_metadata",
    f"""SELECT dataset, round({_SCORE}, 6) AS quality_score, round({_SCORE}, 9) >= 0.7 AS ok_for_model,
       CASE WHEN round({_SCORE}, 9) >= 0.7 THEN '{quality.METADATA_READY}' ELSE '{quality.METADATA_NOT_READY}' END AS message,
       n_rows < 1000 AS too_few_rows, n_cols > 100 AS too_many_columns, max_missing_share > 0.5 AS too_many_missing,
       numeric_cols = 0 AS no_numeric_columns, categorical_cols = 0 AS no_categorical_columns
  FROM {_CATALOGUE_SQL}""",
)
def score_metadata(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score_metadata(catalogue(spark, folder))
    flags = [F.col("flags")[n].alias(n) for n in quality.METADATA_FLAGS]
    return rounded(scored.select("dataset", "quality_score", "ok_for_model", "message", *flags))


@query(
    "q5_rejected_metadata",
    f"""SELECT dataset, n_rows - 600 AS n_rows, max_missing_share * 2 AS max_missing_share FROM {_CATALOGUE_SQL}
     WHERE NOT (n_rows - 600 >= 0 AND max_missing_share * 2 BETWEEN 0 AND 1)""",
)
def rejected(spark: SparkSession, folder: str) -> DataFrame:
    rows = catalogue(spark, folder).withColumns(
        {"n_rows": F.col("n_rows") - 600, "max_missing_share": F.col("max_missing_share") * 2}
    )
    return quality.rejected_metadata(rows).select("dataset", "n_rows", "max_missing_share")


@query(
    "q3_assess_lineitem_gaps",
    f"""SELECT quality_score >= 0.7 AS ok_for_model, quality_score,
       CASE WHEN quality_score >= 0.7 THEN '{quality.DATASET_READY}' ELSE '{quality.DATASET_NOT_READY}' END AS message,
       too_few_rows, too_many_columns, too_many_missing, has_constant_columns, has_high_cardinality_categoricals,
       (SELECT count(*) FROM lineitem) AS n_rows, CAST({len(GAPS_COLUMNS)} AS BIGINT) AS n_cols
  FROM ({_flags_sql(GAPS_SQL, GAPS_COLUMNS)})""",
)
def assess(spark: SparkSession, folder: str) -> DataFrame:
    verdict = quality.assess(with_gaps(load_table(spark, folder, "lineitem")))
    flags = [F.col("flags")[n].alias(n) for n in quality.FLAG_NAMES]
    size = [F.col("dataset_shape")[n].alias(n) for n in ("n_rows", "n_cols")]
    return rounded(verdict.select("ok_for_model", "quality_score", "message", *flags, *size))


@query(
    "q4_flags_only_orders",
    f"SELECT * EXCLUDE (max_missing_share, quality_score) FROM ({_flags_sql('orders', ORDERS)})",
)
def flags_only(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_flags(quality.flags_only(load_table(spark, folder, "orders")))
