import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablegauge.operators import metrics, models, splits
from tablegauge.plans import classification


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    n = 600
    x = rng.normal(size=(n, 3))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 0.7)))
    return pd.DataFrame(
        {"id": np.arange(n) * 3 + 1, "f0": x[:, 0] * 5 + 2, "f1": x[:, 1], "f2": x[:, 2], "label": (rng.random(n) < p).astype(int)}
    )


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data).repartition(3)


FEATURES = ["f0", "f1", "f2"]


@pytest.mark.parametrize("limit", [30, 10_000])
def test_split_sizes_are_exact(data, df, limit):
    got = splits.stratified_split(df, "label", "id", 0.25, seed=3, limit=limit).toPandas()
    assert len(got) == len(data) and got.is_test.sum() == math.ceil(0.25 * len(data))
    for c, n in data.label.value_counts().items():
        assert abs((got.is_test & (got.label == c)).sum() - 0.25 * n) < 1
    again = splits.stratified_split(df, "label", "id", 0.25, seed=3).toPandas()
    assert set(got[got.is_test].id) == set(again[again.is_test].id)
    other = splits.stratified_split(df, "label", "id", 0.25, seed=4).toPandas()
    assert set(got[got.is_test].id) != set(other[other.is_test].id)


def test_split_with_a_rare_class(spark):
    frame = spark.createDataFrame([(i, "rare" if i == 5 else "common") for i in range(50)], "id bigint, label string")
    got = splits.stratified_split(frame, "label", "id", 0.2).toPandas()
    assert got.is_test.sum() == 10
    with pytest.raises(TypeError):
        splits.stratified_split(frame, "id", "label", 0.2)


@pytest.mark.parametrize("limit", [20, 10_000])
def test_folds(data, df, limit):
    got = splits.stratified_folds(df, "label", "id", 5, limit).toPandas().sort_values("id")
    y = data.label.to_numpy()
    first = list(dict.fromkeys(y))
    coded = np.array([first.index(v) for v in y])
    ordered = np.sort(coded)
    want = np.empty(len(y), dtype=int)
    for c in range(2):
        sizes = [(ordered[f::5] == c).sum() for f in range(5)]
        want[coded == c] = np.repeat(np.arange(5), sizes)
    assert got.fold.tolist() == want.tolist()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("limit", [15, 10_000])
def test_area_and_curve(data, df, limit):
    s = data.f1.round(1).to_numpy()
    rows = df.select("label", F.round("f1", 1).alias("score"))
    got = metrics.roc_auc(rows, limit=limit).first()[0]
    assert got == pytest.approx(brute_auc(data.label.to_numpy(), s))
    curve = metrics.roc_curve(rows, limit=limit).toPandas().sort_values("threshold", ascending=False)
    assert (curve.fpr.iloc[0], curve.tpr.iloc[0], curve.fpr.iloc[-1], curve.tpr.iloc[-1]) == (0, 0, 1, 1)
    assert np.trapezoid(curve.tpr, curve.fpr) == pytest.approx(got)


@pytest.mark.parametrize("limit", [7, 10_000])
def test_thinned_curve(spark, limit):
    """Points whose step the next one repeats are left out, per group; the ends stay."""
    rng = np.random.default_rng(8)
    rows = [(g, int(rng.random() < 0.5), float(rng.integers(0, 40) if g != "one" else 3)) for g in ("a", "b", "one") for _ in range(120)]
    frame = spark.createDataFrame(rows, "g string, label int, score double").repartition(3)
    got = metrics.roc_curve(frame, groups=["g"], limit=limit, drop_collinear=True).toPandas()
    for g in ("a", "b", "one"):
        y, s = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        levels = np.sort(np.unique(s))[::-1]
        steps = np.array([[((s == v) & (y == c)).sum() for c in (0, 1)] for v in levels])
        whole = np.cumsum(steps, axis=0)
        keep = [i for i in range(len(levels)) if i in (0, len(levels) - 1) or (steps[i] != steps[i + 1]).any()]
        want = {np.inf: (0.0, 0.0)} | {levels[i]: tuple(whole[i] / whole[-1]) for i in keep}
        mine = got[got.g == g]
        found = {r.threshold: (r.fpr, r.tpr) for r in mine.itertuples()}
        assert found.keys() == want.keys() and all(np.allclose(found[k], want[k]) for k in want)


def test_metrics_per_model(spark):
    rows = [("a", 1, 1, 0.9), ("a", 0, 1, 0.8), ("a", 1, 0, 0.3), ("a", 0, 0, 0.1), ("b", 1, 0, 0.5), ("b", 0, 0, 0.5)]
    frame = spark.createDataFrame(rows, "model string, label int, prediction int, score double")
    got = {r.model: r for r in metrics.classification_metrics(frame, model="model").collect()}
    assert (got["a"].accuracy, got["a"].f1, got["a"].roc_auc) == (0.5, 0.5, 0.75)
    assert (got["b"].accuracy, got["b"].f1, got["b"].roc_auc) == (0.5, 0.0, 0.5)
    cells = {(r.label, r.prediction): r["count"] for r in metrics.confusion(frame.where("model = 'b'")).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_dummies(df, data):
    guessed = models.majority_dummy(df, df, "label", "id").toPandas()
    best = data.label.mode()[0]
    assert set(guessed.prediction) == {best} and set(guessed.score) == {float(best == 1)}
    drawn = models.stratified_dummy(df, df, "label", "id").toPandas()
    assert abs(drawn.prediction.mean() - data.label.mean()) < 0.08
    assert (drawn.score == (drawn.prediction == 1)).all()


def newton_logistic(x, y, c):
    """Minimum of c * summed log loss + half the squared weights, intercept free."""
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    z = np.column_stack([x, np.ones(len(x))])
    keep = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(c * (z * (p * (1 - p))[:, None]).T @ z + keep, c * z.T @ (p - y) + keep @ w)
    return 1 / (1 + np.exp(-z @ w))


@pytest.mark.parametrize("c", [0.01, 1.0])
def test_logistic_strength_on_population_scale(df, data, c):
    got = models.predict(models.fit_logistic(df, FEATURES, c, 1000), df).toPandas().sort_values("id").score
    assert np.allclose(got, newton_logistic(data[FEATURES].to_numpy(), data.label.to_numpy(), c), atol=1e-4)


def test_standard_scale(df, data):
    got = models.standard_scale(df.withColumn("k", F.lit(4.0)), [*FEATURES, "k"]).toPandas().sort_values("id")
    for f in FEATURES:
        assert np.allclose(got[f], (data[f] - data[f].mean()) / data[f].std(ddof=0))
    assert set(got.k) == {0.0}


def test_combinations_vary_the_last_name_fastest():
    got = models.combinations({"b": [1, 2], "a": [3, 4]})
    assert got == [{"a": 3, "b": 1}, {"a": 3, "b": 2}, {"a": 4, "b": 1}, {"a": 4, "b": 2}]
    assert len(models.combinations(models.TREE_GRID)) == 36


def test_search_finds_the_useful_strength(df):
    folded = splits.stratified_folds(df, "label", "id", 3).persist()
    found = models.grid_search("LogisticRegression", folded, FEATURES, {"C": [1e-6, 1.0]}, parallelism=2)
    scores = [s for _, s in found.scores]
    assert found.best_score == max(scores) > 0.8
    found = models.grid_search("DecisionTree", folded, FEATURES, {"max_depth": [1, 4], "min_samples_leaf": [5]}, parallelism=2)
    assert found.best_params["max_depth"] == 4


def test_importance_ranks_the_driving_feature_first(df):
    model = models.fit_classifier("DecisionTree", df, FEATURES, max_depth=4)
    got = models.permutation_importance(model, df, FEATURES, "id", repeats=4).toPandas()
    assert got.feature.iloc[0] == "f0" and got.importance.iloc[0] > 0.1
    assert got.importance.is_monotonic_decreasing and len(got) == 3
    assert models.top_importances(models.permutation_importance(model, df, FEATURES, "id", repeats=2), 1).count() == 1


def test_whole_evaluation(df, tmp_path):
    grids = {
        "DecisionTree": {"max_depth": [3], "min_samples_leaf": [5]},
        "RandomForest": {"n_estimators": [10], "max_depth": [4], "max_features": ["sqrt"]},
        "GradientBoosting": {"learning_rate": [0.1], "n_estimators": [5], "max_depth": [2]},
    }
    result = classification.evaluate(df, "label", "id", FEATURES, grids=grids, n_folds=3, repeats=2)
    table = result.metrics.toPandas().set_index("model")
    assert set(table.index) == {
        "Dummy", "StratifiedDummy", "LogisticRegression", "DecisionTree", "RandomForest", "GradientBoosting",
    }
    assert table.loc["Dummy", "roc_auc"] == 0.5
    best = result.best.first()
    assert best.test_roc_auc == table.drop(["Dummy", "StratifiedDummy"]).roc_auc.max()
    assert result.confusion.agg(F.sum("count")).first()[0] == 120
    classification.write_evaluation(result, str(tmp_path))
    written = df.sparkSession.read.json(f"{tmp_path}/metrics_test")
    assert written.count() == 6
