import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablegauge.functions import arrays
from tablegauge.operators import explore, ranks
from tablegauge.operators.ranks import (
    Target,
    exact_quantiles,
    order_statistics,
    running_totals,
    shuffled_positions,
)


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(8)
    n = 300
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "age": rng.integers(0, 160, n).astype(float),
            "country": rng.choice(["RU", "FR", "DE"], n, p=[0.7, 0.2, 0.1]),
            "purchases": rng.integers(-1, 9, n),
            "revenue": np.where(rng.random(n) < 0.2, 0.0, rng.exponential(500, n).round(2)),
        }
    )
    frame.loc[rng.random(n) < 0.1, "age"] = np.nan
    return frame


@pytest.fixture(scope="module")
def people_df(spark, people):
    return spark.createDataFrame(people).repartition(3)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_filters(people, people_df):
    assert ids(explore.above(people_df, "age", 100)) == people[people.age > 100].id.tolist()
    assert ids(explore.below(people_df, "purchases", 0)) == people[people.purchases < 0].id.tolist()
    both = explore.contradiction(
        people_df, explore.compare(people_df, "purchases", ">", 0), explore.compare(people_df, "revenue", "==", 0)
    )
    assert ids(both) == people[(people.purchases > 0) & (people.revenue == 0)].id.tolist()
    assert ids(explore.equal_to(people_df, "country", "DE")) == people[people.country == "DE"].id.tolist()
    assert ids(explore.without_missing(people_df, "age")) == people[people.age.notna()].id.tolist()


def test_rule_check_gives_one_row_per_broken_rule(people, people_df):
    rules = {
        "old": explore.compare(people_df, "age", ">", 100),
        "negative": explore.compare(people_df, "purchases", "<", 0),
    }
    got = explore.rule_check(people_df, rules).groupBy("rule").count().collect()
    want = {"old": (people.age > 100).sum(), "negative": (people.purchases < 0).sum()}
    assert {r["rule"]: r["count"] for r in got} == want


@pytest.mark.parametrize("few", [0, 1000])
def test_duplicates_with_a_hot_group(spark, few):
    rows = [(i, "same" if i % 3 else f"v{i % 30}", None if i % 2 else 1.0) for i in range(400)]
    frame = pd.DataFrame(rows, columns=["id", "a", "b"])
    df = spark.createDataFrame(rows, "id bigint, a string, b double").repartition(5)
    got = {r.id: r.duplicated for r in explore.flag_duplicates(df, "id", few=few).collect()}
    want = frame.drop(columns="id").duplicated()
    assert [got[i] for i in range(400)] == want.tolist()


@pytest.mark.parametrize("few", [0, 1000])
def test_duplicates_treat_nan_and_null_alike(spark, few):
    df = spark.createDataFrame([(0, float("nan")), (1, None), (2, 0.0), (3, -0.0)], "id bigint, b double")
    got = {r.id: r.duplicated for r in explore.flag_duplicates(df, "id", few=few).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}


def test_counts_and_shares(people, people_df):
    got = explore.value_counts(people_df, "country").toPandas()
    want = people.country.value_counts()
    assert got.value.tolist() == want.index.tolist() and got["count"].tolist() == want.tolist()
    shares = explore.class_shares(people_df, "country").toPandas()
    assert np.allclose(shares.percent, people.country.value_counts(normalize=True) * 100)


def test_group_and_bin_tables(people, people_df):
    measures = {"avg_age": ("age", "mean"), "total": ("purchases", "sum"), "revenue": ("revenue", "sum")}
    got = explore.group_table(people_df, "country", measures).toPandas()
    want = people.groupby("country").agg(avg_age=("age", "mean"), total=("purchases", "sum"), revenue=("revenue", "sum"))
    assert got.country.tolist() == want.index.tolist()
    for c in want.columns:
        assert np.allclose(got[c], want[c].round(2))
    edges, labels = [0, 18, 30, 45, 60, 150], ["0-18", "19-30", "31-45", "46-60", "61+"]
    got = explore.binned_table(people_df, "age", edges, labels, {"users": ("id", "count")}, "age_group").toPandas()
    cut = pd.cut(people.age, bins=edges, labels=labels, right=False)
    want = people.groupby(cut, observed=True).agg(users=("id", "count"))
    assert got.age_group.tolist() == want.index.tolist() and got.users.tolist() == want.users.tolist()


def test_half_even_rounding(spark):
    df = spark.createDataFrame([("a", 2.125), ("b", 2.375)], "g string, v double")
    got = explore.group_table(df, "g", {"m": ("v", "mean")}).toPandas()
    assert got.m.tolist() == [2.12, 2.38]


@pytest.mark.parametrize("bins", [7, 10, 20])
def test_histograms(people, people_df, bins):
    got = explore.histograms(people_df, bins=bins).toPandas()
    for name in ("id", "age", "purchases", "revenue"):
        counts, edges = np.histogram(people[name].dropna(), bins=bins)
        part = got[got.column == name]
        assert part["count"].tolist() == counts.tolist(), name
        assert np.allclose(part.low, edges[:-1]) and np.allclose(part.high, edges[1:])


def test_histogram_of_tenths(spark):
    values = [i / 10 for i in range(0, 31)]
    got = explore.histograms(spark.createDataFrame([(v,) for v in values], "v double"), bins=30).toPandas()
    assert got["count"].tolist() == np.histogram(values, bins=30)[0].tolist()


def test_histogram_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "v double, w double")
    got = explore.histograms(df, bins=4).toPandas()
    assert set(got.column) == {"v"} and got["count"].tolist() == [0, 0, 2, 0]
    assert (got.low.min(), got.high.max()) == (2.5, 3.5)


@pytest.mark.parametrize("limit,bands", [(40, 7), (10_000, 7), (40, 299), (10_000, 300)])
def test_missing_matrix(people, people_df, limit, bands):
    got = explore.missing_matrix(people_df, F.col("id"), bands=bands, limit=limit).toPandas()
    part = got[got.column == "age"].sort_values("band")
    starts = [300 * k // bands for k in range(bands + 1)]
    assert part.band.tolist() == list(range(bands))
    for b in range(bands):
        rows = people.iloc[starts[b] : starts[b + 1]]
        assert part.n_rows.iloc[b] == len(rows)
        assert part.missing_share.iloc[b] == pytest.approx(rows.age.isna().mean())


@pytest.mark.parametrize("limit", [20, 10_000])
def test_box_stats(people, people_df, limit):
    got = explore.box_stats(people_df, "country", "revenue", limit).toPandas().set_index("country")
    out = explore.box_outliers(people_df, "country", "revenue", limit).toPandas()
    for c, s in people.groupby("country").revenue:
        q1, m, q3 = s.quantile([0.25, 0.5, 0.75])
        inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
        r = got.loc[c]
        assert np.allclose([r.q1, r["median"], r.q3], [q1, m, q3])
        assert (r.whisker_low, r.whisker_high) == (min(inside.min(), q1), max(inside.max(), q3))
        assert r.n_outliers == len(s) - len(inside) == (out.country == c).sum()


def test_order_statistics_by_narrowing(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([np.full(700, 5.0), rng.normal(size=900), [1e18, -1e18, np.inf, -np.inf]])
    df = spark.createDataFrame([(1, float(v)) for v in values] + [(2, None), (2, 7.0)], "g int, v double")
    ranks = [0, 1, 2, 400, 800, 1000, len(values) - 2, len(values) - 1]
    targets = [Target((1,), r, len(values)) for r in ranks] + [Target((2,), 0, 1)]
    order_statistics(df, ["g"], "v", targets, limit=10)
    assert [t.value for t in targets] == [*np.sort(values)[ranks], 7.0]


@pytest.mark.parametrize("error", [0.002, 0.05, 0.0])
def test_order_statistics_by_sketch(spark, monkeypatch, error):
    """Narrow and wide brackets; with no margin at all the sketch misses and narrowing finds the rank."""
    monkeypatch.setattr(ranks, "SKETCH_ITEMS", 64)
    monkeypatch.setattr(ranks, "SKETCH_ERROR", error)
    monkeypatch.setattr(ranks, "ASKED_TOGETHER", 3)
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(0, 4, 20_000), np.full(9_000, 2.5), [-np.inf, np.inf]])
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(values)], "g int, v double").repartition(6)
    parts = [np.sort(values[g::2]) for g in (0, 1)]
    targets = [Target((g,), r, len(parts[g])) for g in (0, 1) for r in (0, 1, 77, 5000, 9000, 14_499)]
    order_statistics(df, ["g"], "v", targets, limit=500)
    assert [t.value for t in targets] == [parts[t.key[0]][t.rank] for t in targets]


def test_sketch_settles_in_two_passes(spark, monkeypatch):
    """Values that equal-width bins would take many scans to part."""
    def no_narrowing(*_):
        raise AssertionError("narrowed")

    monkeypatch.setattr(ranks, "_narrow", no_narrowing)
    monkeypatch.setattr(ranks, "_bound", no_narrowing)
    calls = []
    located = ranks._located
    monkeypatch.setattr(ranks, "_located", lambda *a: calls.append(1) or located(*a))
    values = np.concatenate([np.exp(np.linspace(0, 600, 30_000)), -np.exp(np.linspace(0, 600, 30_000))])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    targets = [Target((), r, 60_000) for r in (0, 15_000, 30_000, 44_999, 59_999)]
    order_statistics(df, [], "v", targets, limit=1000)
    assert [t.value for t in targets] == np.sort(values)[[0, 15_000, 30_000, 44_999, 59_999]].tolist()
    assert len(calls) == 1


def test_order_statistics_of_wide_integers(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(-(2**63), 2**63 - 1, 3000)
    near = np.arange(2**62, 2**62 + 200)
    values = np.concatenate([values, near])
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint")
    targets = [Target((), r, len(values)) for r in (0, 17, 1500, 2300, 2400, 3199)]
    order_statistics(df, [], "v", targets, limit=5)
    assert [t.value for t in targets] == np.sort(values)[[0, 17, 1500, 2300, 2400, 3199]].tolist()


def test_quantiles_of_small_and_large_groups(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", None], 900, p=[0.8, 0.1, 0.1]), "v": rng.integers(0, 50, 900) / 4})
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "g string, v double")
    for limits in ({"limit": 100}, {"sketch_above": 30}):
        got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"p10": 0.1, "p90": 0.9}, **limits).collect()}
        for g, s in frame.groupby("g", dropna=False).v:
            r = got[None if pd.isna(g) else g]
            assert r.n == len(s) and np.allclose([r.p10, r.p90], s.quantile([0.1, 0.9]))


@pytest.mark.parametrize("limit", [30, 10_000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, limit, descending):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 500), "o": rng.permutation(500) / 7.0, "n": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(frame)
    got = running_totals(df, "o", ["n"], ["g"], descending, limit).toPandas()
    want = frame.sort_values("o", ascending=not descending)
    want["cum_n"] = want.groupby("g").n.cumsum()
    both = got.merge(want, on=["g", "o"])
    assert len(both) == 500 and (both.cum_n_x == both.cum_n_y).all()


def test_shuffled_positions_are_a_permutation(spark, monkeypatch):
    df = spark.range(1000).withColumnRenamed("id", "row")
    for pretend in (1000, 5_000_000):
        got = shuffled_positions(df, "row", 7, pretend).toPandas().sort_values("row").position
        assert sorted(got) == list(range(1000)) and got.tolist() != list(range(1000))


def test_array_functions(spark):
    a1, a2 = [1, 3, 5, 7, 9, 11, 13], [[1, 3, 5, 7], [2, 4, 6, 8]]
    row = spark.range(1).select(
        arrays.vector(a1).alias("a1"),
        arrays.matrix(a2).alias("a2"),
        arrays.zeros(5, 5).alias("zeros"),
        arrays.ones(2, 4).alias("ones"),
        arrays.value_range(2, 15, 2).alias("a5"),
        arrays.value_range(5, 1, -2).alias("down"),
        arrays.value_range(3, 3).alias("none"),
    )
    got = row.select(
        "*",
        arrays.shape(F.col("a2"), 2).alias("shape"),
        arrays.element(F.col("a2"), 1, 2).alias("element"),
        arrays.element(F.col("a1"), -1).alias("last"),
        arrays.section(F.col("a1"), 4, 6).alias("part"),
        arrays.section(F.col("a1"), -3, 100).alias("tail"),
        arrays.section(F.col("a1"), 9, 12).alias("beyond"),
        arrays.add(F.col("a1"), F.col("a5")).alias("sum"),
        arrays.multiply(F.col("a1"), F.col("a5")).alias("product"),
        arrays.matrix_mean(F.col("a2")).alias("mean"),
    ).first()
    n1, n5 = np.array(a1, float), np.arange(2, 15, 2)
    assert got["a5"] == n5.tolist() and got["down"] == [5, 3] and got["none"] == []
    assert np.array(got["zeros"]).shape == (5, 5) and np.array(got["ones"]).sum() == 8
    assert got["shape"] == [2, 4] and got["element"] == 6 and got["last"] == 13
    assert got["part"] == [9, 11] and got["tail"] == [9, 11, 13] and got["beyond"] == []
    assert got["sum"] == (n1 + n5).tolist() and got["product"] == (n1 * n5).tolist()
    assert got["mean"] == np.mean(a2)


def test_names_with_odd_characters(spark):
    from tablegauge.operators import categories, correlation, profile, quality

    df = spark.createDataFrame(
        [(i, "uv"[i % 2], i * 1.5, None) for i in range(6)], "`r.id` bigint, `c d` string, `x``y` double, `ä.1` double"
    )
    assert [r["name"] for r in profile.summarize(df).orderBy("ordinal").collect()] == df.columns
    assert quality.quality_flags(df).first()["constant_columns_list"] == ["ä.1"]
    assert {r.column for r in categories.top_categories(df).collect()} == {"c d"}
    assert correlation.correlation_matrix(df).count() == 9
    assert set(explore.histograms(df, bins=2).toPandas().column) == {"r.id", "x`y"}
    assert explore.group_table(df, "c d", {"m": ("x`y", "mean")}).count() == 2
    assert explore.box_stats(df, "c d", "x`y").columns[0] == "c d"
    assert explore.flag_duplicates(df, "r.id", ["c d"]).where("duplicated").count() == 4
    assert explore.flag_duplicates(df, "r.id", ["c d"], few=0).where("duplicated").count() == 4
    assert explore.above(df, "x`y", 3).count() == 3
    assert explore.rule_check(df, {"a": explore.compare(df, "r.id", ">", 2)}).count() == 3
    assert profile.describe(df).count() == 3
    assert profile.missing_table(df).first()["column"] == "ä.1"
