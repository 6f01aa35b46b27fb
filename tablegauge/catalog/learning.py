"""Splits, baselines, classifiers and their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import query, rounded
from tablegauge.operators import metrics, models, pruning, splits
from tablegauge.plans import classification
from tablegauge.session import checkpoint
from tablegauge.sources import load_table

FEATURES = ["n_chars", "n_words", "lang_en", "lang_fr", "lang_de", "source_number"]

_DATA_SQL = "(SELECT doc_id, quality, toxic, n_chars FROM labels JOIN documents USING (doc_id))"


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with number features."""
    docs = load_table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        *[(F.col("lang") == x).cast("double").alias(f"lang_{x}") for x in ("en", "fr", "de")],
        F.regexp_replace("source", "src", "").cast("double").alias("source_number"),
    )
    return load_table(spark, folder, "labels").join(docs, "doc_id")


def _split_sql(table: str, label: str, share: float) -> str:
    """Exact class sizes of a stratified split, by largest remainder."""
    return f"""WITH c AS (SELECT {label} AS label, count(*) AS n FROM {table} GROUP BY 1),
      w AS (SELECT *, sum(n) OVER () AS total FROM c),
      t AS (SELECT *, total - ceil({share} * total) AS n_train FROM w),
      f AS (SELECT *, floor(n * n_train / total) AS base, n * n_train / total - floor(n * n_train / total) AS rest FROM t),
      g AS (SELECT *, row_number() OVER (ORDER BY rest DESC, label) AS place, n_train - sum(base) OVER () AS left_over FROM f),
      s AS (SELECT label, n, base + CASE WHEN place <= left_over THEN 1 ELSE 0 END AS train FROM g),
      p AS (SELECT 'train' AS part, label, CAST(train AS BIGINT) AS "count" FROM s
            UNION ALL SELECT 'test', label, CAST(n - train AS BIGINT) FROM s)
    SELECT part, label, "count", round_even("count" * 100.0 / sum("count") OVER (PARTITION BY part), 2)::DOUBLE AS percent
      FROM p"""


@query("c1_c2_stratified_split_labels", _split_sql("labels", "quality", 0.25))
def split_labels(spark: SparkSession, folder: str) -> DataFrame:
    marked = splits.stratified_split(load_table(spark, folder, "labels"), "quality", "doc_id", 0.25)
    return classification.split_balance(marked, "quality")


@query("c1_c2_stratified_split_orders", _split_sql("orders", "o_orderpriority", 0.2))
def split_orders(spark: SparkSession, folder: str) -> DataFrame:
    marked = splits.stratified_split(load_table(spark, folder, "orders"), "o_orderpriority", "o_orderkey", 0.2)
    return classification.split_balance(marked, "o_orderpriority")


@query(
    "c11_stratified_folds",
    """WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS k FROM labels),
      c AS (SELECT quality, count(*) AS n, min(doc_id) AS first FROM labels GROUP BY 1),
      o AS (SELECT quality, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_
              FROM c),
      z AS (SELECT quality, f, (n - ((f - at_) % 5 + 5) % 5 + 4) // 5 AS size FROM o, range(5) t(f)),
      s AS (SELECT quality, f, sum(size) OVER (PARTITION BY quality ORDER BY f) - size AS start FROM z)
    SELECT doc_id, CAST(max(f) AS INTEGER) AS fold FROM r JOIN s ON r.quality = s.quality AND k >= start GROUP BY doc_id""",
)
def folds(spark: SparkSession, folder: str) -> DataFrame:
    return splits.stratified_folds(load_table(spark, folder, "labels"), "quality", "doc_id").select("doc_id", "fold")


@query(
    "c3_stratified_dummy",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
      SELECT quality, true AS share_within_band, true AS score_is_one_hot FROM c WHERE n > 1""",
)
def stratified_dummy(spark: SparkSession, folder: str) -> DataFrame:
    """Per class: is it drawn as often on the test rows as its share of the training rows allows?

    The band is five standard deviations of a draw of that many rows, and one row.
    """
    labels = load_table(spark, folder, "labels")
    marked = checkpoint(splits.stratified_split(labels, "quality", "doc_id", 0.25))
    train, test = marked.where(~F.col("is_test")), marked.where("is_test")
    guessed = models.stratified_dummy(train, test, "quality", "doc_id")
    one_hot = F.min(F.col("score") == (F.col("prediction") == 1).cast("double")).alias("score_is_one_hot")
    totals = guessed.agg(F.count(F.lit(1)).alias("rows"), one_hot)
    drawn = guessed.groupBy(F.col("prediction").alias("quality")).agg(F.count(F.lit(1)).alias("drawn"))
    n_train = train.agg(F.count(F.lit(1)).alias("n_train"))
    shares = train.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(n_train))
    share = F.col("n") / F.col("n_train")
    gap = F.abs(F.coalesce("drawn", F.lit(0)) - F.col("rows") * share)
    band = 5 * F.sqrt(F.col("rows") * share * (1 - share)) + 1
    found = shares.join(drawn, "quality", "left").join(F.broadcast(totals))
    return found.select("quality", (gap <= band).alias("share_within_band"), "score_is_one_hot")


@query(
    "c4_majority_dummy",
    """SELECT round(avg(CASE WHEN quality = m THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy,
      round(CASE WHEN m = 1 THEN 2.0 * count(*) FILTER (WHERE quality = 1)
                 / (count(*) + count(*) FILTER (WHERE quality = 1)) ELSE 0.0 END, 6)::DOUBLE AS f1, 0.5::DOUBLE AS roc_auc
      FROM labels, (SELECT quality AS m FROM labels GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) GROUP BY m""",
)
def majority_dummy(spark: SparkSession, folder: str) -> DataFrame:
    labels = load_table(spark, folder, "labels")
    return rounded(metrics.classification_metrics(models.majority_dummy(labels, labels, "quality", "doc_id"), "quality"))


@query(
    "c5_standard_scale",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
      round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS c_nationkey FROM customer""",
)
def scale(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return rounded(models.standard_scale(customers, ["c_acctbal", "c_nationkey"]))


@query(
    "a11_confusion",
    """SELECT a.k AS label, b.k AS prediction, count(l.doc_id) AS "count"
      FROM (VALUES (0), (1)) a(k), (VALUES (0), (1)) b(k) LEFT JOIN labels l ON l.quality = a.k AND l.toxic = b.k
      GROUP BY 1, 2""",
)
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(load_table(spark, folder, "labels"), "quality", "toxic")


_AUC_SQL = """(SELECT (sum(rk) FILTER (WHERE quality = 1) - p * (p + 1) / 2.0) / (p * q) FROM
   (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS rk,
     count(*) FILTER (WHERE quality = 1) OVER () AS p, count(*) FILTER (WHERE quality = 0) OVER () AS q FROM {t})
   GROUP BY p, q)"""


@query(
    "c12_classification_metrics",
    f"""SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy,
      round(2.0 * count(*) FILTER (WHERE quality = 1 AND toxic = 1) / (2.0 * count(*) FILTER (WHERE quality = 1 AND toxic = 1)
        + count(*) FILTER (WHERE (quality = 1) <> (toxic = 1))), 6)::DOUBLE AS f1,
      round({_AUC_SQL.format(t=_DATA_SQL)}, 6)::DOUBLE AS roc_auc FROM {_DATA_SQL}""",
)
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.classification_metrics(labelled(spark, folder), "quality", "toxic", "n_chars"))


_LATE_SQL = "(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS quality, l_extendedprice AS n_chars FROM lineitem)"


@query("c12_roc_auc_lineitem", f"SELECT round({_AUC_SQL.format(t=_LATE_SQL)}, 6)::DOUBLE AS roc_auc")
def auc_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    items = load_table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score")
    )
    return rounded(metrics.roc_auc(items))


@query(
    "c13_roc_curve",
    f"""WITH s AS (SELECT n_chars, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS q
                     FROM {_DATA_SQL} GROUP BY 1)
    SELECT n_chars::DOUBLE AS threshold, round(sum(q) OVER w / sum(q) OVER ()::DOUBLE, 6) AS fpr,
           round(sum(p) OVER w / sum(p) OVER ()::DOUBLE, 6) AS tpr FROM s WINDOW w AS (ORDER BY n_chars DESC)
    UNION ALL SELECT 1e9, 0.0, 0.0""",
)
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    curve = rounded(metrics.roc_curve(labelled(spark, folder), "quality", "n_chars"))
    # Infinity as a plain number, for comparison.
    return curve.withColumn("threshold", F.when(F.col("threshold") == float("inf"), 1e9).otherwise(F.col("threshold")))


@query(
    "c13_roc_curve_thinned",
    """WITH s AS (SELECT l_extendedprice AS t, count(*) FILTER (WHERE l_returnflag = 'R') AS p,
        count(*) FILTER (WHERE l_returnflag <> 'R') AS q FROM lineitem GROUP BY 1),
      w AS (SELECT t, sum(q) OVER o / sum(q) OVER ()::DOUBLE AS fpr, sum(p) OVER o / sum(p) OVER ()::DOUBLE AS tpr,
        lag(t) OVER o IS NULL OR lead(t) OVER o IS NULL OR lead(p) OVER o <> p OR lead(q) OVER o <> q AS kept
        FROM s WINDOW o AS (ORDER BY t DESC))
    SELECT t::DOUBLE AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM w WHERE kept
    UNION ALL SELECT 1e9, 0.0, 0.0""",
)
def thinned_roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    """The curve of all lines by price, without points on a straight way."""
    items = load_table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score")
    )
    curve = rounded(metrics.roc_curve(items, drop_collinear=True))
    return curve.withColumn("threshold", F.when(F.col("threshold") == float("inf"), 1e9).otherwise(F.col("threshold")))


@query("a12_mean_and_std", "SELECT round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events")
def mean_and_std(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.mean_and_std(load_table(spark, folder, "events"), "value"))


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    data = labelled(spark, folder)
    _, train, test = classification.split(data, "quality", "doc_id", FEATURES, 0.25, 42)
    return train, test


def _scored(model, test: DataFrame) -> DataFrame:
    return rounded(metrics.classification_metrics(checkpoint(models.predict(model, test))), 4)


@query("c6_c7_c15_logistic_regression")
def logistic(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _sides(spark, folder)
    return _scored(models.fit_logistic(train, FEATURES, 1.0, 1000), test)


@query("c8_decision_tree")
def tree(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _sides(spark, folder)
    return _scored(models.fit_classifier("DecisionTree", train, FEATURES, max_depth=5, min_samples_leaf=10), test)


@query("c8_pruning_path")
def pruning_path(spark: SparkSession, folder: str) -> DataFrame:
    """Alphas, leaves and risk of every subtree of an unlimited tree."""
    train, _ = _sides(spark, folder)
    grown = models.fit_classifier("DecisionTree", train, FEATURES, max_depth=None, min_samples_leaf=1)
    return rounded(pruning.pruning_path(grown.stages[-1]), 9)


@query("c8_c11_pruned_tree_search")
def pruned_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    """The whole grid of depth, leaf size and pruning strength over five folds."""
    train, _ = _sides(spark, folder)
    folded = checkpoint(splits.stratified_folds(train, "label", "doc_id"))
    found = models.grid_search("DecisionTree", folded, FEATURES, parallelism=8)
    rows = [
        (o["max_depth"], o["min_samples_leaf"], o["ccp_alpha"], s, o == found.best_params) for o, s in found.scores
    ]
    schema = "max_depth int, min_samples_leaf int, ccp_alpha double, roc_auc double, is_best boolean"
    return rounded(spark.createDataFrame(rows, schema), 6)


@query("c9_random_forest")
def forest(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _sides(spark, folder)
    fitted = models.fit_classifier("RandomForest", train, FEATURES, n_estimators=100, max_depth=10, max_features="sqrt")
    return _scored(fitted, test)


@query("c10_gradient_boosting")
def boosting(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _sides(spark, folder)
    fitted = models.fit_classifier("GradientBoosting", train, FEATURES, learning_rate=0.1, n_estimators=100, max_depth=3)
    return _scored(fitted, test)


@query("c11_grid_search_logistic")
def search(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _sides(spark, folder)
    folded = checkpoint(splits.stratified_folds(train, "label", "doc_id"))
    found = models.grid_search("LogisticRegression", folded, FEATURES, parallelism=8)
    rows = [(o["C"], s, o == found.best_params) for o, s in found.scores]
    return rounded(spark.createDataFrame(rows, "c double, roc_auc double, is_best boolean"), 4)


@query("c14_d10_t4_permutation_importance")
def importance(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _sides(spark, folder)
    fitted = models.fit_classifier("DecisionTree", train, FEATURES, max_depth=5, min_samples_leaf=10)
    return rounded(models.top_importances(models.permutation_importance(fitted, test, FEATURES, "doc_id")), 4)


SMALL_GRIDS = {
    "RandomForest": {"n_estimators": [20], "max_depth": [5]},
    "GradientBoosting": {"learning_rate": [0.1], "n_estimators": [10], "max_depth": [3]},
}


@query("c16_i13_model_comparison")
def comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All models on one split over five folds: the whole grid of the tree, small ones of the ensembles."""
    result = classification.evaluate(
        labelled(spark, folder), "quality", "doc_id", FEATURES, grids=SMALL_GRIDS, parallelism=8
    )
    searched = result.searches.drop("best_params")
    return rounded(result.metrics.join(searched, "model", "left"), 4)
