"""Evaluation of baselines and classifiers on one table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.operators import metrics, models, splits
from tablegauge.session import checkpoint
from tablegauge.sources import sinks

SEARCHED = ("DecisionTree", "RandomForest", "GradientBoosting")


@dataclass
class Evaluation:
    """Result frames of a run and the model that won on the test rows."""

    balance: DataFrame
    metrics: DataFrame
    searches: DataFrame
    best: DataFrame
    confusion: DataFrame
    roc: DataFrame
    importance: DataFrame
    model: Model


def split(df: DataFrame, label: str, row_id: str, features: list[str], test_size: float, seed: int) -> tuple:
    """Train rows with folds and test rows, written once so that every fit reads the same."""
    data = df.select(row_id, F.col(label).alias("label"), *features)
    marked = checkpoint(splits.stratified_split(data, "label", row_id, test_size, seed))
    train = marked.where(~F.col("is_test")).drop("is_test")
    test = marked.where("is_test").drop("is_test")
    return marked, train, test


def split_balance(marked: DataFrame, label: str = "label") -> DataFrame:
    """``(part, label, count, percent)`` of both sides of a split."""
    counts = marked.groupBy("is_test", label).agg(F.count(F.lit(1)).alias("count"))
    whole = marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("_all"))
    # Two rows, one per side.
    return counts.join(F.broadcast(whole), "is_test").select(
        F.when(F.col("is_test"), "test").otherwise("train").alias("part"),
        F.col(label).alias("label"),
        "count",
        F.bround(F.col("count") / F.col("_all") * 100, 2).alias("percent"),
    )


def evaluate(
    df: DataFrame,
    label: str,
    row_id: str,
    features: list[str],
    test_size: float = 0.2,
    seed: int = 42,
    n_folds: int = 5,
    grids: dict[str, dict[str, list]] | None = None,
    repeats: int = 10,
    parallelism: int = 4,
) -> Evaluation:
    """Both baselines, logistic regression, and searched tree models on one stratified split.

    ``grids`` replaces the searched settings per model. The best model is the one with the
    highest ROC-AUC on the test rows; its confusion table, ROC curve and permutation
    importance are returned with the metrics of all.
    """
    grids = grids or {}
    spark = df.sparkSession
    marked, train, test = split(df, label, row_id, features, test_size, seed)
    folded = checkpoint(splits.stratified_folds(train, "label", row_id, n_folds))

    scored = {
        "Dummy": models.majority_dummy(train, test, "label", row_id),
        "StratifiedDummy": models.stratified_dummy(train, test, "label", row_id, seed),
    }
    fitted: dict[str, Model] = {"LogisticRegression": models.fit_logistic(train, features)}
    searches = []
    for kind in SEARCHED:
        found = models.grid_search(
            kind, folded, features, grids.get(kind), seed=seed, parallelism=parallelism
        )
        fitted[kind] = found.model
        searches.append((kind, str(found.best_params), found.best_score))
    for name, model in fitted.items():
        scored[name] = models.predict(model, test)

    columns = [F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "score"]
    rows = None
    for name, frame in scored.items():
        part = frame.select(F.lit(name).alias("model"), row_id, *columns)
        rows = part if rows is None else rows.unionByName(part)
    rows = checkpoint(rows)
    table = checkpoint(metrics.classification_metrics(rows, model="model"))

    names = list(fitted)
    areas = {r["model"]: r["roc_auc"] for r in table.collect()}
    winner = max(names, key=lambda n: (areas[n], -names.index(n)))
    settings = {k: p for k, p, _ in searches}
    best = spark.createDataFrame(
        [(winner, settings.get(winner, "{}"), areas[winner])], "model_type string, best_params string, test_roc_auc double"
    )
    won = rows.where(F.col("model") == winner)
    return Evaluation(
        balance=split_balance(marked),
        metrics=table,
        searches=spark.createDataFrame(searches, "model string, best_params string, best_cv_score_roc_auc double"),
        best=best,
        confusion=metrics.confusion(won),
        roc=metrics.roc_curve(won, drop_collinear=True),
        importance=models.permutation_importance(fitted[winner], test, features, row_id, repeats=repeats, seed=seed),
        model=fitted[winner],
    )


def write_evaluation(result: Evaluation, out_dir: str) -> None:
    sinks.write_records(result.metrics, f"{out_dir}/metrics_test")
    sinks.write_records(result.searches, f"{out_dir}/search_summaries")
    sinks.write_records(result.best, f"{out_dir}/best_model_meta")
    sinks.write_records(models.top_importances(result.importance), f"{out_dir}/importance")
    sinks.write_table(result.confusion, f"{out_dir}/confusion", few_rows=True)
    sinks.write_table(result.roc, f"{out_dir}/roc_curve")
    sinks.save_model(result.model, f"{out_dir}/best_model")
