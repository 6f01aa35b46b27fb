"""Cost-complexity pruning of a fitted decision tree.

The engine saves a tree as a node table with class counts for inner nodes too, and reads such
a table back. A pruned tree is such a table with subtrees taken out, so it predicts, saves
and loads as any other model. Nodes are worked on where the engine keeps a tree, on the
driver; rows are only read to be counted by leaf.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablegauge.session import scratch_path

# Strengths this close count as equal: sums of impurities are rounded.
CLOSE = 1e-12


@dataclass
class Nodes:
    """A tree's nodes in preorder: children (-1 for a leaf), class weights, and the risk of a node as a leaf."""

    left: np.ndarray
    right: np.ndarray
    stats: np.ndarray
    risk: np.ndarray

    @property
    def parent(self) -> np.ndarray:
        up = np.full(len(self.left), -1)
        inner = np.flatnonzero(self.left >= 0)
        up[self.left[inner]] = inner
        up[self.right[inner]] = inner
        return up


def saved_nodes(model: DecisionTreeClassificationModel, path: str) -> list[Row]:
    """The rows of the node table of ``model``, saved below ``path``, in preorder."""
    model.write().overwrite().save(path)
    return _spark().read.parquet(f"{path}/data").orderBy("id").collect()


def _spark() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def nodes_of(rows: list[Row]) -> Nodes:
    stats = np.array([r["impurityStats"] for r in rows], dtype=float)
    weight = stats.sum(axis=1)
    impurity = np.array([r["impurity"] for r in rows], dtype=float)
    # The engine leaves it out, as -1, where it found no split to look at: that of the classes then.
    unset = impurity < 0
    impurity[unset] = 1 - ((stats[unset] / weight[unset, None]) ** 2).sum(axis=1)
    return Nodes(
        np.array([r["leftChild"] for r in rows]), np.array([r["rightChild"] for r in rows]), stats, impurity * weight / weight[0]
    )


def weakest_links(nodes: Nodes) -> list[tuple[float, int]]:
    """``(strength, node)`` in the order in which nodes become leaves.

    A node's strength is the risk that its subtree saves per leaf beyond the first. The
    weakest node is cut again and again; of equally weak ones the first in preorder.
    """
    n = len(nodes.left)
    up = nodes.parent
    leaves = np.ones(n, dtype=np.int64)
    below = nodes.risk.copy()
    # Children come behind their parent.
    for i in range(n - 1, -1, -1):
        if nodes.left[i] >= 0:
            pair = [nodes.left[i], nodes.right[i]]
            leaves[i], below[i] = leaves[pair].sum(), below[pair].sum()
    gone = nodes.left < 0

    def strength(i: int) -> float:
        return max(0.0, float(nodes.risk[i] - below[i]) / int(leaves[i] - 1))

    now = {int(i): strength(i) for i in np.flatnonzero(~gone)}
    queue = [(s, i) for i, s in now.items()]
    heapq.heapify(queue)
    links, reached = [], 0.0
    while queue:
        s, i = heapq.heappop(queue)
        if gone[i] or now[i] != s:
            continue
        reached = max(reached, s)
        links.append((reached, i))
        saved, dropped = nodes.risk[i] - below[i], leaves[i] - 1
        stack = [i]
        while stack:
            at = stack.pop()
            if nodes.left[at] >= 0 and not gone[at]:
                gone[at] = True
                stack += [int(nodes.left[at]), int(nodes.right[at])]
        at = i
        while at >= 0:
            below[at] += saved
            leaves[at] -= dropped
            if at != i:
                now[at] = strength(at)
                heapq.heappush(queue, (now[at], at))
            at = int(up[at])
    return links


def _cut(links: list[tuple[float, int]], alpha: float) -> set[int]:
    """The nodes that are leaves at ``alpha``; none at 0, which asks for no pruning."""
    return {i for s, i in links if s <= alpha * (1 + CLOSE)} if alpha > 0 else set()


def pruning_path(model: DecisionTreeClassificationModel) -> DataFrame:
    """``(step, alpha, n_leaves, risk)``: the sequence of subtrees, from the whole tree to its root alone.

    ``risk`` is the impurity of the leaves, weighted by their rows.
    """
    spark = _spark()
    nodes = nodes_of(saved_nodes(model, scratch_path(spark, "tree")))
    left = int((nodes.left < 0).sum())
    risk = float(nodes.risk[nodes.left < 0].sum())
    path = [(0, 0.0, left, risk)]
    standing = _standing(nodes, set())
    for step, (alpha, i) in enumerate(weakest_links(nodes), 1):
        inside = _leaves_below(nodes, standing, i)
        left -= len(inside) - 1
        risk += float(nodes.risk[i] - nodes.risk[inside].sum())
        standing[i] = True
        path.append((step, alpha, left, risk))
    return spark.createDataFrame(path, "step int, alpha double, n_leaves int, risk double")


def _standing(nodes: Nodes, cut: set[int]) -> np.ndarray:
    """Which nodes end a way down, looked at from the root."""
    ends = nodes.left < 0
    ends[list(cut)] = True
    return ends


def _leaves_below(nodes: Nodes, ends: np.ndarray, root: int) -> list[int]:
    found, stack = [], [root]
    while stack:
        at = stack.pop()
        if ends[at]:
            found.append(at)
        else:
            stack += [int(nodes.right[at]), int(nodes.left[at])]
    return found


def prune(model: DecisionTreeClassificationModel, alpha: float) -> DecisionTreeClassificationModel:
    """``model`` without the subtrees whose strength is at most ``alpha``."""
    if alpha <= 0:
        return model
    spark = _spark()
    source, target = scratch_path(spark, "tree"), scratch_path(spark, "tree")
    rows = saved_nodes(model, source)
    nodes = nodes_of(rows)
    ends = _standing(nodes, _cut(weakest_links(nodes), alpha))
    kept: list[dict] = []

    # Preorder numbers anew; a way down is as long as the tree is deep.
    def copy(at: int) -> int:
        number = len(kept)
        row = rows[at].asDict()
        kept.append(row | {"id": number})
        if ends[at]:
            kept[number] |= {"leftChild": -1, "rightChild": -1, "gain": -1.0, "split": (-1, [], -1)}
        else:
            kept[number] |= {"leftChild": copy(int(nodes.left[at])), "rightChild": copy(int(nodes.right[at]))}
        return number

    copy(0)
    schema = spark.read.parquet(f"{source}/data").schema
    spark.createDataFrame([tuple(r[f] for f in schema.names) for r in kept], schema).coalesce(1).write.parquet(f"{target}/data")
    spark.read.text(f"{source}/metadata").coalesce(1).write.text(f"{target}/metadata")
    return DecisionTreeClassificationModel.load(target)


def leaf_scores(model: DecisionTreeClassificationModel, alphas: list[float]) -> np.ndarray:
    """For every leaf of ``model`` in its numbering, the share of class 1 it gets at each of ``alphas``.

    One transform by leaf number then serves all strengths.
    """
    nodes = nodes_of(saved_nodes(model, scratch_path(_spark(), "tree")))
    links = weakest_links(nodes)
    share = nodes.stats[:, 1] / nodes.stats.sum(axis=1) if nodes.stats.shape[1] > 1 else np.zeros(len(nodes.left))
    leaves = np.flatnonzero(nodes.left < 0)
    out = np.empty((len(leaves), len(alphas)))
    for k, alpha in enumerate(alphas):
        cut = _cut(links, alpha)
        held = share.copy()
        shown = np.zeros(len(nodes.left), dtype=bool)
        # Parents first, so the uppermost cut decides.
        for i in range(len(nodes.left)):
            shown[i] |= i in cut
            if nodes.left[i] >= 0 and shown[i]:
                for child in (nodes.left[i], nodes.right[i]):
                    held[child], shown[child] = held[i], True
        out[:, k] = held[leaves]
    return out


def leaf_counts(model: DecisionTreeClassificationModel, df: DataFrame, label: str = "label") -> np.ndarray:
    """Rows of class 1 and of the others that fall into each leaf; ``df`` has ``features``."""
    numbered = model.copy()
    numbered.setLeafCol("_leaf")
    positive = F.col(label).cast("int") == 1
    counts = numbered.transform(df).groupBy("_leaf").agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    out = np.zeros(((model.numNodes + 1) // 2, 2), dtype=np.int64)
    for r in counts.collect():
        out[int(r["_leaf"])] = r["pos"], r["neg"]
    return out


def area_by_leaf(scores: np.ndarray, counts: np.ndarray) -> float:
    """ROC-AUC of scores that are constant within leaves; ties count half."""
    order = np.argsort(scores, kind="stable")
    _, same = np.unique(scores[order], return_inverse=True)
    pos = np.bincount(same, weights=counts[order, 0])
    neg = np.bincount(same, weights=counts[order, 1])
    if not pos.sum() or not neg.sum():
        return 0.0
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum()))
