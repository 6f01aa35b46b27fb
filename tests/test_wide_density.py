"""The metric index against all pairs of points."""

import math

import numpy as np
import pytest
from test_clustering import brute_dbscan, make_points

from tablegauge.operators import density, wide_density


def clumps(dims, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 4, (5, dims))
    x = np.concatenate([rng.normal(c, 0.4 + i / 5, (40, dims)) for i, c in enumerate(centers)] + [rng.normal(0, 4, (60, dims))])
    # Repeated points and points at exactly one distance.
    x = np.concatenate([x, x[:20], x[:1] + np.eye(dims)[:1] * 3.0])
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("dims,block_rows", [(2, 16), (16, 32), (64, 2048)])
def test_labels_equal_brute_force(spark, dims, block_rows):
    x = clumps(dims)
    settings = [(e * math.sqrt(dims), m) for e in (0.3, 0.8, 1.5) for m in (3, 8)] + [(3.0, 2)]
    got = wide_density.dbscan_by_pivots(make_points(spark, x), settings, 4, block_rows).toPandas()
    assert len(got) == len(x) * len(settings)
    for s, (eps, m) in enumerate(settings):
        labels = got[got.setting == s].sort_values("id").label.to_numpy()
        assert labels.tolist() == brute_dbscan(x, eps, m).tolist(), (eps, m)


def test_blocks_are_bounded_and_pairs_miss_nothing(spark):
    x = np.concatenate([clumps(8), np.zeros((100, 8))])
    placed, blocks = wide_density.metric_blocks(make_points(spark, x), 5, 16)
    rows = placed.collect()
    sizes = {}
    for r in rows:
        sizes[r.block] = sizes.get(r.block, 0) + 1
    assert sum(sizes.values()) == len(x) and max(sizes.values()) <= 48
    for radius in (0.5, 2.0):
        pairs = {(r.a, r.b) for r in wide_density.near_blocks(blocks, radius, 5).collect()}
        assert len(pairs) < len(sizes) * (len(sizes) + 1) / 2
        for r in rows:
            for q in rows:
                if math.dist(r.x, q.x) <= radius:
                    assert (min(r.block, q.block), max(r.block, q.block)) in pairs


def test_products_agree_with_differences():
    rng = np.random.default_rng(0)
    a = rng.normal(1e6, 1, (40, 30))
    b = np.concatenate([a[:20], rng.normal(1e6, 1, (20, 30))])
    plain = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    for radius in (0.0, 5.0, float(np.median(plain))):
        assert (wide_density.within(a, b, [radius])[0] == (((a[:, None] - b[None]) ** 2).sum(axis=2) <= radius**2)).all()


def test_wide_points_take_the_index(spark, monkeypatch):
    used = []
    inner = density.dbscan_by_pivots
    monkeypatch.setattr(density, "dbscan_by_pivots", lambda *a: used.append(1) or inner(*a))
    x = clumps(7)
    got = density.dbscan(make_points(spark, x), 2.0, 4).toPandas().sort_values("id").label
    assert used and got.tolist() == brute_dbscan(x, 2.0, 4).tolist()


def test_no_points(spark):
    empty = spark.createDataFrame([], "id bigint, x array<double>")
    assert wide_density.dbscan_by_pivots(empty, [(1.0, 3)]).count() == 0


def test_blocks_travel_in_slabs(spark, monkeypatch):
    monkeypatch.setattr(wide_density, "SLAB_BLOCKS", 8)
    x = clumps(12)
    placed, blocks = wide_density.metric_blocks(make_points(spark, x), 4, 8)
    pairs = wide_density.near_blocks(blocks, 3.0, 4)
    of, met = wide_density._in_slabs(pairs)
    slab = {r["block"]: r["slab"] for r in of.collect()}
    assert len(slab) == blocks.count() > 2 * len(set(slab.values()))
    listed = {(p["a"], p["b"]) for r in met.collect() for p in r["met"]}
    assert listed == {(r["a"], r["b"]) for r in pairs.collect()}
    assert all((slab[p["a"]], slab[p["b"]]) == (r["i"], r["j"]) for r in met.collect() for p in r["met"])
    got = wide_density.dbscan_by_pivots(make_points(spark, x), [(3.0, 4)], 4, 8).toPandas().sort_values("id").label
    assert got.tolist() == brute_dbscan(x, 3.0, 4).tolist()


def test_merged_links_keep_the_parts():
    u, v = np.array([5, 9, 9, 20, 31]), np.array([3, 5, 7, 21, 30])
    low, root = wide_density.merged(u, v)
    assert dict(zip(low.tolist(), root.tolist())) == {5: 3, 9: 3, 7: 3, 21: 20, 31: 30}


def test_close_pairs_are_those_within(monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.normal(1e5, 1, (60, 20))
    b = np.concatenate([a[:20], rng.normal(1e5, 1, (30, 20)), a[:10] + np.eye(20)[0] * 3.0])
    radii = [0.0, 3.0, 5.5, 6.5]
    i, j, first = wide_density.close_pairs(a, b, radii)
    for e, hit in enumerate(wide_density.within(a, b, radii)):
        got = np.zeros_like(hit)
        got[i[first <= e], j[first <= e]] = True
        assert (got == hit).all() and hit.any()


def test_forest_of_bits_joins_what_links_join():
    rng = np.random.default_rng(2)
    rows, columns = rng.permutation(300)[:70] + (1 << 60), rng.permutation(300)[:53] + (1 << 60)
    for n in (0, 20, 60, 400):
        i, j = rng.integers(0, 70, n), rng.integers(0, 53, n)
        of_rows, of_columns = rng.random(70) < 0.8, rng.random(53) < 0.8
        bits = wide_density.bits_of(i, j, 70, 53), wide_density.bits_of(j, i, 53, 70)
        u, v = wide_density.forest(*bits, of_rows, of_columns, rows, columns)
        joined = of_rows[i] & of_columns[j]
        low, root = wide_density.merged(rows[i[joined]], columns[j[joined]])
        # The same id may stand on both sides; a further merge settles that.
        again = wide_density.merged(u, v)
        assert dict(zip(low.tolist(), root.tolist())) == dict(zip(again[0].tolist(), again[1].tolist()))


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_sweep_has_a_task_per_pair_of_slabs(spark, monkeypatch, few):
    monkeypatch.setattr(wide_density, "SLAB_BLOCKS", 8)
    # No matrix of hits per radius: pairs found are looked at, by bits or as links.
    monkeypatch.setattr(wide_density, "within", None)
    monkeypatch.setattr(wide_density, "FEW_PAIRS", few)
    x = clumps(12)
    settings = [(e, m) for e in (2.0, 3.0, 4.5) for m in (2, 4, 9)]
    got = wide_density.dbscan_by_pivots(make_points(spark, x), settings, 4, 16).toPandas()
    for s, (eps, m) in enumerate(settings):
        labels = got[got.setting == s].sort_values("id").label.to_numpy()
        assert labels.tolist() == brute_dbscan(x, eps, m).tolist(), (eps, m)
    placed, blocks = wide_density.metric_blocks(make_points(spark, x), 4, 16)
    met = wide_density._in_slabs(wide_density.near_blocks(blocks, 3.0, 4))[1]
    dealt = met.select("pair").repartition(met.count(), "pair").groupBy(wide_density.F.spark_partition_id().alias("p")).count()
    assert [r["count"] for r in dealt.collect()] == [1] * met.count()
