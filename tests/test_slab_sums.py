"""Sums of distances by slabs against all pairs of points."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clustering import brute_silhouette

from tablegauge.operators import clustering, slab_sums
from tablegauge.session import even_keys


@pytest.mark.parametrize("slab_bytes", [1 << 26, 1])
def test_sums_are_one_line_a_point_and_cluster(spark, monkeypatch, slab_bytes):
    # One slab of several blocks, or a slab per block.
    monkeypatch.setattr(slab_sums, "SLAB_BYTES", slab_bytes)
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (260, 9))
    x[40:60] = x[:20]
    labels = [[int(c), None if i % 5 == 0 else int(c) % 2 - 1] for i, c in enumerate(rng.integers(0, 4, len(x)))]
    # Large ids, one of them twice.
    ids = np.arange(len(x)) + (1 << 60)
    ids[7] = ids[3]
    rows = [(int(i), [float(c) for c in v], lab) for i, v, lab in zip(ids, x, labels)]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>").repartition(3)
    clusters = [(v, c) for v in (0, 1) for c in sorted({lab[v] for lab in labels if lab[v] is not None})]
    # Not a line per pair of blocks.
    lines = slab_sums.cluster_sums(frame, clusters, 9, 32, clustering._distances)
    assert lines.count() == sum(sum(lab[v] is not None for lab in labels) * len([c for c in clusters if c[0] == v]) for v in (0, 1))
    got = {}
    for r in lines.collect():
        got.setdefault((r["variant"], r["id"], r["label"]), []).append(r["distance"])
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    want = {}
    for i in range(len(x)):
        for v, c in clusters:
            if labels[i][v] is not None:
                want.setdefault((v, int(ids[i]), c), []).append(sum(far[i, j] for j in range(len(x)) if labels[j][v] == c and ids[i] != ids[j] or i == j))
    twice = int(ids[3])
    for key in got:
        if key[1] != twice:
            assert got[key] == pytest.approx(want[key], abs=1e-9)
    assert got.keys() == want.keys() and all(len(got[k]) == len(want[k]) for k in got)


def test_silhouettes_of_several_blocks_go_by_slabs(spark, monkeypatch):
    used = []
    inner = clustering.cluster_sums
    monkeypatch.setattr(clustering, "cluster_sums", lambda *a: used.append(1) or inner(*a))
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (150, 6))
    lab = rng.integers(0, 3, len(x))
    lab[9] = 7
    frame = spark.createDataFrame([(i, [float(c) for c in v], [int(lab[i])]) for i, v in enumerate(x)], "id bigint, x array<double>, labels array<int>")
    scores = [clustering.silhouettes(frame, rows).first()["silhouette"] for rows in (40, 10_000)]
    assert used == [1]
    assert scores == pytest.approx([brute_silhouette(x, lab)] * 2, abs=1e-9)


@pytest.mark.parametrize("n", [1, 7, 60])
def test_even_keys_fill_every_partition_once(spark, n):
    keys = even_keys(spark, n)
    dealt = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(n, "k").select(F.spark_partition_id().alias("p"))
    assert sorted(r["p"] for r in dealt.collect()) == list(range(n))
