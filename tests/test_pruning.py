"""Pruning against a search over all subtrees, and the searched grid."""

import itertools

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from tablegauge.operators import models, pruning


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 2)).round(2)
    y = ((x[:, 0] > 0.3) ^ (rng.random(400) < 0.25)).astype(int)
    data = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id bigint, f0 double, f1 double, label int").cache()


def nodes_of(model, tmp_path):
    return pruning.nodes_of(pruning.saved_nodes(model, str(tmp_path / "tree")))


def subtrees(nodes, at=0):
    """All prunings below a node, each as the set of its leaves."""
    found = [frozenset([at])]
    if nodes.left[at] >= 0:
        parts = (subtrees(nodes, nodes.left[at]), subtrees(nodes, nodes.right[at]))
        found += [a | b for a, b in itertools.product(*parts)]
    return found


def best_subtree(nodes, alpha):
    """The smallest of the subtrees with the least cost."""
    cost = {t: sum(nodes.risk[i] for i in t) + alpha * len(t) for t in subtrees(nodes)}
    least = min(cost.values())
    return min((t for t, c in cost.items() if c <= least + 1e-12), key=len)


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_links_give_the_best_of_all_subtrees(rows, tmp_path, depth):
    fitted = models.fit_classifier("DecisionTree", rows, ["f0", "f1"], max_depth=depth).stages[-1]
    nodes = nodes_of(fitted, tmp_path)
    links = pruning.weakest_links(nodes)
    strengths = [s for s, _ in links]
    assert strengths == sorted(strengths) and links[-1][1] == 0
    middles = [(a + b) / 2 for a, b in itertools.pairwise([0.0, *strengths]) if b - a > 1e-9]
    for alpha in [*middles, *strengths, strengths[-1] + 1]:
        ends = pruning._standing(nodes, pruning._cut(links, alpha))
        assert frozenset(pruning._leaves_below(nodes, ends, 0)) == best_subtree(nodes, alpha), alpha


def test_path_is_that_of_pruned_models(rows, tmp_path):
    fitted = models.fit_classifier("DecisionTree", rows, ["f0", "f1"], max_depth=5).stages[-1]
    path = pruning.pruning_path(fitted).orderBy("step").collect()
    assert path[0].n_leaves == (fitted.numNodes + 1) // 2 and path[-1].n_leaves == 1
    for before, step in itertools.pairwise(path):
        assert before.alpha <= step.alpha and before.n_leaves > step.n_leaves and before.risk <= step.risk + 1e-12
    for step in path[1:]:
        last = [p for p in path if p.alpha <= step.alpha * (1 + 1e-12)][-1]
        pruned = pruning.prune(fitted, step.alpha)
        assert (pruned.numNodes + 1) // 2 == last.n_leaves
        nodes = nodes_of(pruned, tmp_path)
        assert nodes.risk[nodes.left < 0].sum() == pytest.approx(last.risk)


def test_pruned_model_predicts_saves_and_loads(rows, tmp_path):
    whole = models.fit_classifier("DecisionTree", rows, ["f0", "f1"], max_depth=6)
    alphas = [0.0, 0.002, 0.01, 0.05, 1.0]
    vectors = models.assembled(["f0", "f1"]).transform(rows)
    scores = pruning.leaf_scores(whole.stages[-1], alphas)
    counts = pruning.leaf_counts(whole.stages[-1], vectors)
    assert counts.sum() == 400 and counts[:, 0].sum() == rows.where("label = 1").count()
    for k, alpha in enumerate(alphas):
        fitted = models.fit_classifier("DecisionTree", rows, ["f0", "f1"], max_depth=6, ccp_alpha=alpha)
        predicted = models.predict(fitted, rows)
        by_score = {round(r.score, 9): (r.pos, r.neg) for r in predicted.groupBy("score").agg(
            F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")).collect()}
        mine = {}
        for s, c in zip(scores[:, k], counts):
            mine[round(s, 9)] = tuple(np.add(mine.get(round(s, 9), (0, 0)), c))
        assert mine == by_score
        fitted.stages[-1].save(str(tmp_path / f"m{k}"))
        again = DecisionTreeClassificationModel.load(str(tmp_path / f"m{k}"))
        assert again.numNodes == fitted.stages[-1].numNodes
    assert again.numNodes == 1


def test_search_covers_the_grid(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    grid = {"max_depth": [2, None], "min_samples_leaf": [1, 20], "ccp_alpha": [0.0, 0.01, 0.5]}
    found = models.grid_search("DecisionTree", folded, ["f0", "f1"], grid)
    assert [o for o, _ in found.scores] == models.combinations(grid)
    # Without pruning, the search is that of the engine's cross validation.
    plain = models.grid_search("DecisionTree", folded, ["f0", "f1"], {k: v for k, v in grid.items() if k != "ccp_alpha"})
    unpruned = {tuple(sorted((k, v) for k, v in o.items() if k != "ccp_alpha")): s for o, s in found.scores if o["ccp_alpha"] == 0}
    for o, s in plain.scores:
        assert unpruned[tuple(sorted(o.items()))] == pytest.approx(s)
    # A root alone ranks nothing.
    assert all(s == 0.5 for o, s in found.scores if o["ccp_alpha"] == 0.5)
    assert found.best_score == max(s for _, s in found.scores)


def test_only_trees_are_pruned(rows):
    with pytest.raises(ValueError):
        models.fit_classifier("RandomForest", rows, ["f0", "f1"], ccp_alpha=0.1)


def test_one_class_and_no_split(spark, tmp_path):
    flat = spark.createDataFrame([(1.0, 1.0, 0)] * 5, "f0 double, f1 double, label int")
    fitted = models.fit_classifier("DecisionTree", flat, ["f0", "f1"]).stages[-1]
    assert pruning.weakest_links(nodes_of(fitted, tmp_path)) == []
    assert pruning.prune(fitted, 0.5).numNodes == 1
    assert [tuple(r) for r in pruning.pruning_path(fitted).collect()] == [(0, 0.0, 1, 0.0)]
