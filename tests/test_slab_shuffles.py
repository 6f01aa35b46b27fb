"""What sums by slabs shuffle: read off the plans."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_clustering import brute_silhouette

from tablegauge.operators import clustering, slab_sums


def _frame(spark, n, clusters=3, parts=4):
    rng = np.random.default_rng(n)
    x, lab = rng.normal(0, 1, (n, 6)), rng.integers(0, clusters, n)
    rows = [(i, [float(c) for c in v], [int(k)]) for i, (v, k) in enumerate(zip(x, lab))]
    return spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>").repartition(parts), x, lab


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_are_packed_where_they_lie(spark, monkeypatch):
    frame, x, lab = _frame(spark, 150)
    frame = clustering.checkpoint(frame)
    written, inner = [], slab_sums.checkpoint
    monkeypatch.setattr(slab_sums, "checkpoint", lambda df: written.append(_plan(df)) or inner(df))
    slab_sums.cluster_sums(frame, [(0, c) for c in range(3)], 6, 32, clustering._distances)
    assert len(written) == 1 and "MapInPandas" in written[0] and "Exchange" not in written[0]


@pytest.mark.parametrize("slabs", [1, 2, 3, 4, 7])
def test_no_slab_travels_to_meet_itself(slabs):
    pairs = slab_sums._pairs(slabs)
    met = Counter(frozenset((i, j)) for i, j, _ in pairs if i != j)
    assert met == Counter(frozenset((i, j)) for i in range(slabs) for j in range(i))
    assert sorted(i for i, _, within in pairs if within) == list(range(slabs))
    if slabs > 2:
        assert all(i != j for i, j, _ in pairs)


@pytest.mark.parametrize("slab_bytes", [1 << 26, 1])
@pytest.mark.parametrize("rows", [5, 30, 50, 75, 149])
def test_scores_with_few_and_many_slabs(spark, monkeypatch, slab_bytes, rows):
    monkeypatch.setattr(slab_sums, "SLAB_BYTES", slab_bytes)
    frame, x, lab = _frame(spark, 150, parts=1)
    assert clustering.silhouettes(frame, rows).first()["silhouette"] == pytest.approx(brute_silhouette(x, lab), abs=1e-9)


def test_means_of_unique_ids_are_not_shuffled(spark, monkeypatch):
    frame, x, lab = _frame(spark, 150)
    used, inner = [], clustering.cluster_sums
    monkeypatch.setattr(clustering, "cluster_sums", lambda *a: used.append(inner(*a)) or used[-1])
    scores = clustering.silhouettes(frame, 40)
    assert used[0].columns == ["variant", "id", "mates", "a", "b"] and used[0].count() == 150
    # From the sums of the blocks on, only the mean of each labeling is put together.
    assert _plan(scores).count("Exchange") == _plan(used[0]).count("Exchange") + 1
    assert scores.first()["silhouette"] == pytest.approx(brute_silhouette(x, lab), abs=1e-9)


def _odd(kind):
    rng = np.random.default_rng(8)
    x, ids = rng.normal(0, 1, (150, 6)), np.arange(150)
    labels = [[int(c), None if c else 0] for c in rng.integers(0, 3, 150)]
    labels[9] = [7, 1]
    if kind == "twice":
        # Ids that come twice: rows alike, at other places, in other clusters.
        ids[100:130] = ids[:30]
        x[100:110], labels[100:110] = x[:10], labels[:10]
        labels[110:120] = labels[10:20]
    elif kind == "nan":
        x[5, 2] = np.nan
        labels[5] = [1, None]
    elif kind == "one cluster":
        labels = [[0, None] for _ in labels]
    elif kind == "no clusters":
        labels = [[None, None] for _ in labels]
    return [(int(i), [float(c) for c in v], lab) for i, v, lab in zip(ids, x, labels)]


def _score_of_lines(lines, sizes):
    """Per labeling the mean score, from the sums of each point by cluster; lines of one id are added up."""
    points = {}
    for r in lines:
        sums = points.setdefault((r["variant"], r["id"]), {})
        sums[r["own"], r["label"]] = sums.get((r["own"], r["label"]), 0.0) + r["distance"]
    scores = {}
    for (v, _), sums in points.items():
        own = [(sizes[v, c], t) for (o, c), t in sums.items() if o == c]
        others = [t / sizes[v, c] for (o, c), t in sums.items() if o != c]
        mine = scores.setdefault(v, [])
        if others and max(n for n, _ in own) == 1:
            mine.append(0.0)
        elif others:
            a = max(t / (n - 1) for n, t in own if n > 1)
            b = min((t for t in others if t == t), default=float("nan"))
            mine.append((b - a) / max(a, b) if a == a and b == b else float("nan"))
    return {v: np.mean(mine) if mine else None for v, mine in scores.items()}


@pytest.mark.parametrize("kind", ["plain", "twice", "nan", "one cluster", "no clusters"])
def test_scores_of_odd_rows_are_those_of_lines(spark, kind):
    rows = _odd(kind)
    # Blocks of one partition, so that rows of one id meet alike in both runs.
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>").coalesce(1)
    got = {r["variant"]: r["silhouette"] for r in clustering.silhouettes(frame, 149).collect()}
    sizes = Counter((v, c) for _, _, lab in rows for v, c in enumerate(lab) if c is not None)
    lines = slab_sums.cluster_sums(frame, sorted(sizes), 6, 149, clustering._distances).collect() if sizes else []
    want = _score_of_lines(lines, sizes)
    assert got.keys() == want.keys()
    for v in want:
        assert got[v] == (want[v] if want[v] is None else pytest.approx(want[v], abs=1e-9, nan_ok=True))


@pytest.mark.parametrize("kind", ["floats", "doubles", "mixed", "huge", "nan"])
def test_vectors_of_floats_travel_as_floats(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (90, 6))
    if kind != "doubles":
        x = x.astype(np.float32).astype(float)
    if kind == "mixed":
        x[70, 3] = 0.1
    elif kind == "huge":
        x[70, 3] = 1e300
    elif kind == "nan":
        x[70, 3] = np.nan
    rows = [(i, [float(c) for c in v], [i % 3]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>").coalesce(1)
    clusters = [(0, c) for c in range(3)]
    widths = {r["w"] for r in slab_sums._packed(frame, clusters, 30).select((F.octet_length("x") / F.col("n") / 6).alias("w")).collect()}
    assert widths == ({4.0} if kind == "floats" else {8.0} if kind == "doubles" else {4.0, 8.0})
    if kind == "huge":
        return
    # The sums are those of the values as they came.
    lines = slab_sums.cluster_sums(frame, clusters, 6, 30, clustering._distances).collect()
    far = clustering._distances(x, x)
    for r in lines:
        want = sum(far[r["id"], j] for j in range(90) if j % 3 == r["label"] and j != r["id"])
        assert r["distance"] == pytest.approx(want, rel=1e-9, nan_ok=True)


@pytest.mark.parametrize("symmetric", [True, False])
def test_a_block_meets_itself_once_sent(spark, symmetric):
    rows = spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("_own"))

    def kernel(a, b):
        return pd.DataFrame({"i": [int(a["_i"].iloc[0])], "j": [int(a["_j"].iloc[0])], "n": [len(a) * len(b)], "sent": [len(a) + (0 if b is a else len(b))]})

    met = {(r.i, r.j): (r.n, r.sent) for r in clustering._block_pairs(rows, 3, [], kernel, "i int, j int, n int, sent int", symmetric).collect()}
    pairs = [(i, j) for i in range(3) for j in range(3) if i <= j or not symmetric]
    assert met == {(i, j): (900, 30 if symmetric and i == j else 60) for i, j in pairs}


# Scores of ids that come twice depend on the blocks they fall in; these are the ones before blocks were sent once.
@pytest.mark.parametrize("again,want", [([], [-0.4924186133] * 2), (range(0, 700, 50), [-0.4919873561, -0.4919988105])])
def test_scores_of_many_clusters(spark, again, want):
    rng = np.random.default_rng(6)
    x, lab = rng.normal(0, 1, (700, 6)), rng.integers(0, 300, 700)
    rows = [(i, [float(c) for c in x[i]], [int(lab[i])]) for i in [*range(700), *again]]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>").repartition(3)
    scores = [clustering.silhouettes(frame, block).first()["silhouette"] for block in (100, 1000)]
    assert scores == pytest.approx(want, abs=1e-9)
