"""Baselines, scaling, classifiers, grid search and permutation importance."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.scalars import present
from tablegauge.operators import pruning
from tablegauge.operators.metrics import label_metrics
from tablegauge.operators.ranks import seeded_hash, shuffled_positions
from tablegauge.operators.splits import class_sizes
from tablegauge.session import checkpoint

# The deepest tree the engine grows; stands for "no limit".
DEEPEST = 30

# The search grids of the evaluated models.
LOGISTIC_GRID = {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]}
TREE_GRID = {"max_depth": [3, 5, 10, None], "min_samples_leaf": [1, 5, 10], "ccp_alpha": [0.0, 0.01, 0.1]}
FOREST_GRID = {"n_estimators": [100, 200], "max_depth": [10, 20, None], "max_features": ["sqrt", "log2"]}
BOOSTING_GRID = {"learning_rate": [0.01, 0.1], "n_estimators": [100, 200], "max_depth": [3, 5]}


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns shifted to mean 0 and population deviation 1; constant columns only shifted."""
    stats = df.agg(
        *[F.avg(present(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(present(df, c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        spread = stats[f"s{i}"] or 1.0
        out[c] = (present(df, c) - F.lit(stats[f"m{i}"])) / F.lit(spread)
    return df.withColumns(out)


def stratified_dummy(train: DataFrame, test: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    """``test`` with a prediction drawn from the class shares of ``train`` and a one-hot score."""
    classes = class_sizes(train, label, row_id)
    whole = sum(n for _, n, _ in classes)
    # The top 53 bits of the hash as a fraction of 1.
    draw = F.shiftrightunsigned(seeded_hash(F.col(row_id), seed, "draw"), 11).cast("double") / F.lit(float(2**53))
    pick, upto = None, 0
    for cls, n, _ in classes[:-1]:
        upto += n
        inside = draw < F.lit(upto / whole)
        pick = F.when(inside, F.lit(cls)) if pick is None else pick.when(inside, F.lit(cls))
    last = F.lit(classes[-1][0])
    prediction = last if pick is None else pick.otherwise(last)
    return test.withColumn("prediction", prediction).withColumn("score", (F.col("prediction") == 1).cast("double"))


def majority_dummy(train: DataFrame, test: DataFrame, label: str, row_id: str) -> DataFrame:
    """``test`` with the most frequent class of ``train`` (the smallest on ties) and a 0/1 score."""
    classes = class_sizes(train, label, row_id)
    best = max(classes, key=lambda c: c[1])[0]
    return test.withColumn("prediction", F.lit(best)).withColumn(
        "score", (F.col("prediction") == 1).cast("double")
    )


@dataclass
class Search:
    """Outcome of a grid search: refitted model, best settings, mean fold score of each."""

    name: str
    model: Model
    best_params: dict
    best_score: float
    scores: list[tuple[dict, float]] = field(default_factory=list)


def assembled(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def logistic_pipeline(features: list[str], n_rows: int, c: float = 1.0, max_iter: int = 100) -> Pipeline:
    """Scaling and L2 logistic regression with inverse strength ``c``.

    The engine's loss is a mean and its scaler divides by the sample deviation; the
    strength is converted so that the optimum is that of summed loss on population scale.
    """
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(
        featuresCol="scaled", labelCol="label", regParam=_strength(c, n_rows), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-8,
    )
    return Pipeline(stages=[assembled(features), scaler, model])


def _strength(c: float, n_rows: int) -> float:
    return (n_rows - 1) / (c * n_rows * n_rows) if n_rows > 1 else 1.0 / c


def _estimator(kind: str, seed: int):
    # Nodes are binned per feature; more bins than the default come close to exact splits.
    if kind == "DecisionTree":
        return DecisionTreeClassifier(seed=seed, maxBins=128, maxMemoryInMB=512)
    if kind == "RandomForest":
        return RandomForestClassifier(seed=seed, maxBins=128, maxMemoryInMB=512)
    if kind == "GradientBoosting":
        return GBTClassifier(seed=seed, maxBins=128, maxMemoryInMB=512)
    raise ValueError(f"unknown model '{kind}'")


# Each setting as (parameter of the engine's estimator, conversion).
_SETTINGS = {
    "max_depth": ("maxDepth", lambda v: DEEPEST if v is None else v),
    "min_samples_leaf": ("minInstancesPerNode", int),
    # The least gain of a split while the tree grows.
    "min_info_gain": ("minInfoGain", float),
    "n_estimators": ("numTrees", int),
    "max_features": ("featureSubsetStrategy", str),
    "learning_rate": ("stepSize", float),
}


def _setting(estimator, name: str, value):
    target, convert = _SETTINGS[name]
    if name == "n_estimators" and isinstance(estimator, GBTClassifier):
        target = "maxIter"
    return estimator.getParam(target), convert(value)


def combinations(grid: dict[str, list]) -> list[dict]:
    """All settings of a grid; names in alphabetical order, the last one varies fastest."""
    names = sorted(grid)
    return [dict(zip(names, vs)) for vs in itertools.product(*(grid[n] for n in names))]


def grid_search(
    kind: str,
    train: DataFrame,
    features: list[str],
    grid: dict[str, list] | None = None,
    fold: str = "fold",
    seed: int = 42,
    parallelism: int = 4,
    max_iter: int = 100,
) -> Search:
    """Cross-validated search by ROC-AUC over the folds in column ``fold``, refitted on all rows.

    ``train`` holds ``label`` and ``fold``. The first of equally good settings wins. The
    folds of one setting and the settings run side by side, each fit a distributed job.
    """
    n_folds = train.agg(F.max(fold)).first()[0] + 1
    n_rows = train.count()
    # A tree's raw prediction is its leaf's class counts, which do not rank rows.
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="probability", metricName="areaUnderROC", numBins=0
    )
    train = train.withColumn("label", F.col("label").cast("double"))
    if kind == "LogisticRegression":
        options = combinations(grid or LOGISTIC_GRID)
        in_fold = n_rows - n_rows // n_folds
        estimator = logistic_pipeline(features, in_fold, max_iter=max_iter)
        last = estimator.getStages()[-1]
        maps = [{last.regParam: _strength(o["C"], in_fold)} for o in options]
    else:
        default = {"DecisionTree": TREE_GRID, "RandomForest": FOREST_GRID, "GradientBoosting": BOOSTING_GRID}[kind]
        options = combinations(grid or default)
        if kind == "DecisionTree" and "ccp_alpha" in options[0]:
            return _pruned_search(train, features, options, n_folds, fold, seed, parallelism)
        last = _estimator(kind, seed)
        estimator = Pipeline(stages=[assembled(features), last])
        maps = [dict(_setting(last, k, v) for k, v in o.items()) for o in options]
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps or ParamGridBuilder().build(), evaluator=evaluator,
        numFolds=n_folds, foldCol=fold, parallelism=parallelism,
    )
    fitted = validator.fit(train)
    scores = [float(s) for s in fitted.avgMetrics]
    at = max(range(len(scores)), key=lambda i: (scores[i], -i))
    model: PipelineModel = fitted.bestModel
    if kind == "LogisticRegression":
        model = logistic_pipeline(features, n_rows, options[at]["C"], max_iter).fit(train)
    return Search(kind, model, options[at], scores[at], list(zip(options, scores)))


def _pruned_search(
    train: DataFrame, features: list[str], options: list[dict], n_folds: int, fold: str, seed: int, parallelism: int
) -> Search:
    """A search over trees and pruning strengths: a tree is grown once per fold for all strengths.

    The rows left out are counted by leaf of the grown tree, which gives the area at every strength.
    """
    rows = checkpoint(assembled(features).transform(train).select("features", "label", fold))
    alphas = sorted({o["ccp_alpha"] for o in options})
    grown = list(dict.fromkeys(tuple((k, v) for k, v in o.items() if k != "ccp_alpha") for o in options))

    def areas(job: tuple[tuple, int]) -> list[float]:
        settings, f = job
        model = _tree(seed, **dict(settings)).fit(rows.where(F.col(fold) != f))
        counts = pruning.leaf_counts(model, rows.where(F.col(fold) == f))
        return [pruning.area_by_leaf(s, counts) for s in pruning.leaf_scores(model, alphas).T]

    jobs = [(g, f) for g in grown for f in range(n_folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(zip(jobs, pool.map(inheritable_thread_target(train.sparkSession)(areas), jobs)))
    means = {
        (g, a): sum(found[g, f][k] for f in range(n_folds)) / n_folds for g in grown for k, a in enumerate(alphas)
    }
    scores = [means[tuple((k, v) for k, v in o.items() if k != "ccp_alpha"), o["ccp_alpha"]] for o in options]
    at = max(range(len(scores)), key=lambda i: (scores[i], -i))
    model = fit_classifier("DecisionTree", train, features, seed, **options[at])
    return Search("DecisionTree", model, options[at], scores[at], list(zip(options, scores)))


def _tree(seed: int, **settings) -> DecisionTreeClassifier:
    estimator = _estimator("DecisionTree", seed)
    for name, value in settings.items():
        estimator.set(*_setting(estimator, name, value))
    return estimator


def fit_logistic(train: DataFrame, features: list[str], c: float = 1.0, max_iter: int = 100) -> PipelineModel:
    train = train.withColumn("label", F.col("label").cast("double"))
    return logistic_pipeline(features, train.count(), c, max_iter).fit(train)


def fit_classifier(kind: str, train: DataFrame, features: list[str], seed: int = 42, **settings) -> PipelineModel:
    """One tree model with the given settings, without a search.

    ``ccp_alpha`` prunes a decision tree after growth; 0 leaves it as grown.
    """
    alpha = settings.pop("ccp_alpha", 0.0)
    if alpha and kind != "DecisionTree":
        raise ValueError("only a decision tree can be pruned")
    estimator = _estimator(kind, seed)
    for name, value in settings.items():
        estimator.set(*_setting(estimator, name, value))
    train = train.withColumn("label", F.col("label").cast("double"))
    fitted = Pipeline(stages=[assembled(features), estimator]).fit(train)
    if not alpha:
        return fitted
    return PipelineModel([fitted.stages[0], pruning.prune(fitted.stages[1], alpha)])


def predict(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and the probability of class 1 as ``score``."""
    scored = model.transform(df)
    extra = [c for c in ("features", "scaled", "rawPrediction", "probability") if c not in df.columns]
    return (
        scored.withColumn("score", vector_to_array("probability")[1])
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop(*[c for c in extra if c in scored.columns])
    )


def permutation_importance(
    model: Model,
    df: DataFrame,
    features: list[str],
    row_id: str,
    label: str = "label",
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """``(feature, importance, std)``: mean drop in accuracy with one feature's values shuffled.

    Each repeat has a random order of its own, independent of the others and of splits with
    the same seed; a row takes a feature's value from the row at its place there. One join
    per repeat serves all features, and accuracy is counted where the rows are.
    """
    n_rows = df.count()
    schema = "feature string, importance double, std double"
    if n_rows == 0:
        return df.sparkSession.createDataFrame([], schema)
    base = predict(model, df).agg(*label_metrics(F.col(label), F.col("prediction"))).first()["accuracy"]
    rows = df.select(row_id, label, *features)
    placed = checkpoint(shuffled_positions(rows, row_id, seed, n_rows, "_place", "takers"))
    both = None
    for r in range(repeats):
        order = shuffled_positions(rows, row_id, seed, n_rows, "_taker", f"donors {r}")
        donors = order.select("_taker", *[F.col(f).alias(f"_new_{f}") for f in features])
        pairs = placed.join(donors, placed["_place"] == donors["_taker"]).withColumn("repeat", F.lit(r))
        both = pairs if both is None else both.unionByName(pairs)
    both = checkpoint(both)
    variants = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                *[F.col(f"_new_{g}" if g == f else g).cast("double").alias(g) for g in features],
            )
            for f in features
        ]
    )
    swapped = both.select(F.col(label), "repeat", F.inline(variants))
    parts = (
        predict(model, swapped)
        .groupBy("feature", "repeat")
        .agg(*label_metrics(F.col(label), F.col("prediction")))
        .withColumn("drop", F.lit(base) - F.col("accuracy"))
    )
    return (
        parts.groupBy("feature")
        .agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))
        .orderBy(F.desc("importance"), "feature")
    )


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)
