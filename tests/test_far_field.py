"""Silhouettes by cells against all pairs of points."""

import numpy as np
import pytest
from test_clustering import brute_silhouette

from tablegauge.operators import clustering, far_field


@pytest.mark.parametrize("dims", [1, 2])
def test_silhouettes_equal_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(clustering, "CELLS_ABOVE", 100)
    monkeypatch.setattr(far_field, "LEAF_ROWS", 16)
    monkeypatch.setattr(far_field, "GROUP_ROWS", 300)
    monkeypatch.setattr(clustering, "_block_pairs", None)
    rng = np.random.default_rng(dims)
    # A dense spot, a wide cloud, copies of one point and a far one.
    x = np.concatenate([rng.normal(0, 0.01, (300, dims)), rng.uniform(-2, 3, (700, dims))])
    x = np.concatenate([x, np.tile(x[:1], (90, 1)), np.full((1, dims), 40.0)])
    labels = [(x[:, 0] > 0.5).astype(int), rng.integers(0, 5, len(x)), np.zeros(len(x), dtype=int)]
    labels[1][0] = 9
    keep = rng.random(len(x)) < 0.7
    rows = [
        (i, [float(c) for c in x[i]], [int(labels[0][i]), int(labels[1][i]) if keep[i] else None, int(labels[2][i])])
        for i in range(len(x))
    ]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>")
    got = {r.variant: r.silhouette for r in clustering.silhouettes(frame).collect()}
    assert got[0] == pytest.approx(brute_silhouette(x, labels[0]), abs=1e-9)
    assert got[1] == pytest.approx(brute_silhouette(x[keep], labels[1][keep]), abs=1e-9)
    assert got[2] is None
