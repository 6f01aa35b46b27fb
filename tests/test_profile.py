import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablegauge.operators import categories, correlation, profile, quality
from tablegauge.operators import values as V


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(4)
    n = 500
    frame = pd.DataFrame(
        {
            "row": np.arange(n),
            "whole": rng.integers(0, 40, n),
            "gappy": rng.integers(0, 9, n).astype(float),
            "real": rng.normal(size=n).round(3),
            "city": rng.choice(["A", "B", "C", None], n),
            "long": rng.choice(["x" * 100, "y" * 200, "z"], n),
            "flag": rng.random(n) < 0.5,
            "day": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 30, n), unit="D"),
        }
    )
    frame.loc[rng.random(n) < 0.2, "gappy"] = np.nan
    frame.loc[rng.random(n) < 0.1, "real"] = np.nan
    return frame


@pytest.fixture(scope="module")
def mixed_df(spark, mixed):
    rows = mixed.astype(object).where(mixed.notna(), None).values.tolist()
    schema = "row bigint, whole int, gappy bigint, real double, city string, long string, flag boolean, day timestamp"
    rows = [[*r[:2], None if r[2] is None else int(r[2]), *r[3:7], r[7].to_pydatetime()] for r in rows]
    return spark.createDataFrame(rows, schema).repartition(4)


def test_profile_equals_data_frame_profile(mixed, mixed_df):
    got = {r["name"]: r for r in profile.summarize(mixed_df, F.col("row")).collect()}
    assert [r["name"] for r in sorted(got.values(), key=lambda r: r["ordinal"])] == list(mixed.columns)
    for name, s in mixed.items():
        r = got[name]
        assert r["dtype"] == str(s.dtype).replace("int32", "int64")
        assert (r["non_null"], r["missing"]) == (s.notna().sum(), s.isna().sum())
        assert r["missing_share"] == pytest.approx(s.isna().mean())
        assert r["unique"] == s.nunique()
        assert r["example_values"] == s.dropna().astype(str).unique()[:3].tolist()
        numeric = pd.api.types.is_numeric_dtype(s)
        assert r["is_numeric"] == numeric
        if numeric:
            assert r["min"] == s.min() and r["max"] == s.max()
            assert r["mean"] == pytest.approx(s.mean()) and r["std"] == pytest.approx(s.std())
        else:
            assert r["min"] is None and r["std"] is None


def test_quick_summary_only_estimates_distinct_counts(mixed, mixed_df):
    exact = {r["name"]: r for r in profile.summarize(mixed_df).collect()}
    for r in profile.quick_summary(mixed_df).collect():
        want = exact[r["name"]].asDict()
        assert abs(r["unique"] - want["unique"]) <= 0.15 * want["unique"] and r["example_values"] == []
        same = [c for c in want if c not in ("unique", "example_values")]
        assert [r[c] for c in same] == pytest.approx([want[c] for c in same])


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (math.inf,)], "x double")
    r = profile.summarize(df).first()
    assert (r["non_null"], r["missing"], r["unique"], r["max"]) == (2, 2, 2, math.inf)


def test_columns_without_values_are_numeric(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "t string, v int")
    r = {x["name"]: x for x in profile.summarize(df).collect()}
    assert (r["t"]["dtype"], r["t"]["is_numeric"], r["t"]["unique"]) == ("float64", True, 0)
    assert r["t"]["example_values"] == [] and r["t"]["mean"] is None


def test_boolean_with_gaps_is_text(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "b boolean")
    r = profile.summarize(df).first()
    assert (r["dtype"], r["is_numeric"], r["min"]) == ("object", False, None)


def test_single_value_has_no_deviation(spark):
    r = profile.summarize(spark.createDataFrame([(3,)], "v int")).first()
    assert r["std"] is None and r["mean"] == 3.0


def test_sizes_and_nested_record(mixed_df):
    r = profile.dataset_record(mixed_df, F.col("row")).first()
    assert (r["n_rows"], r["n_cols"], len(r["columns"])) == (500, 8, 8)
    assert profile.shape(mixed_df).first().asDict() == {"n_rows": 500, "n_cols": 8}
    view = profile.overview(mixed_df).toPandas()
    assert view.shape == (8, 13) and set(view.n_rows) == {500}


def test_missing_table_order(mixed, mixed_df):
    got = profile.missing_table(mixed_df).toPandas()
    assert got.missing_share.is_monotonic_decreasing
    assert dict(zip(got.column, got.missing_count)) == mixed.isna().sum().to_dict()
    assert profile.missing_table(mixed_df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [None, 50])
def test_describe(mixed, mixed_df, limit):
    got = profile.describe(mixed_df, limit=limit).toPandas().set_index("column")
    want = mixed[["row", "whole", "gappy", "real"]].describe().T
    for a, b in zip(["count", "mean", "std", "min", "q25", "q50", "q75", "max"], want.columns):
        assert np.allclose(got[a].astype(float), want[b].astype(float)), a


@pytest.mark.parametrize("few", [0, 100])
def test_correlation_is_pairwise_complete(mixed, mixed_df, few, monkeypatch):
    monkeypatch.setattr(correlation, "EXPRESSION_COLUMNS", few)
    names = ["row", "whole", "gappy", "real"]
    got = correlation.correlation_wide(mixed_df).toPandas().set_index("column")
    assert list(got.index) == names and list(got.columns) == names
    assert np.allclose(got, mixed[names].corr(), atol=1e-12)


@pytest.mark.parametrize("few", [0, 100])
def test_correlation_of_constants_is_null(spark, few, monkeypatch):
    monkeypatch.setattr(correlation, "EXPRESSION_COLUMNS", few)
    df = spark.createDataFrame([(1.0, 0.1, 5), (2.0, 0.1, 7), (4.0, 0.1, None)], "x double, k double, y int")
    got = {(r.column_a, r.column_b): r.corr for r in correlation.correlation_matrix(df).collect()}
    assert got["x", "x"] == 1.0 and got["x", "y"] == pytest.approx(1.0)
    assert got["x", "k"] is None and got["k", "k"] is None


def test_no_numeric_columns(spark):
    df = spark.createDataFrame([("a",)], "t string")
    assert correlation.correlation_matrix(df).count() == 0
    assert correlation.heatmap(spark.createDataFrame([(1,)], "v int")).count() == 0


def test_top_categories(mixed, mixed_df):
    got = categories.top_categories(mixed_df, top_k=2, order_by=F.col("row")).toPandas()
    assert list(got.column.unique()) == ["city", "long"]
    for name in ("city", "long"):
        counts = mixed[name].value_counts().head(2)
        part = got[got.column == name]
        assert part.value.tolist() == counts.index.tolist()
        assert part["count"].tolist() == counts.tolist()
        assert np.allclose(part.share, counts / counts.sum())


def test_empty_candidate_uses_up_a_slot(spark):
    df = spark.createDataFrame([(None, "p", 1), (None, "q", 2)], "a string, b string, row int")
    assert categories.top_categories(df, max_columns=1).count() == 0
    assert {r.column for r in categories.top_categories(df, max_columns=2).collect()} == {"b"}


def test_ties_follow_first_appearance(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("zbazbaq")], "row bigint, v string")
    got = categories.top_categories(df, top_k=3, order_by=F.col("row")).toPandas()
    assert got.value.tolist() == ["z", "b", "a"]


def test_long_text_is_restored_whole(spark):
    texts = ["a" * 70 + str(i % 3) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "row bigint, t string")
    for order in (F.col("row"), None):
        top = categories.top_categories(df, top_k=3, order_by=order).toPandas()
        assert sorted(top.value) == sorted(set(texts))
    assert profile.summarize(df, F.col("row")).collect()[1]["example_values"] == texts[:3]


def test_float_text_matches_repr(spark):
    from tablegauge.functions.scalars import float_text

    values = [0.0, 1.0, 10.5, 1e7, 12345678.9, 1e15, 1e16, 1.5e22, 1e-3, 1.5e-4, 1e-5, 2.25e-7, -3.5, -1e8, 0.1, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(float_text(F.col("v"))).collect()] == [repr(v) for v in values]


def test_distinct_in_order_and_first_rows(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (0, None)], "row bigint, v string")
    assert [r.v for r in profile.distinct_in_order(df, "v", F.col("row")).collect()] == [None, "c", "b"]
    assert [r.row for r in profile.first_rows(df, 2, "row").collect()] == [0, 1]


# Fixture frames with their expected flags and scores.


def flags(df):
    fast = quality.quality_flags(df).first().asDict()
    stats = profile.table_stats(df)
    slow = quality.flags_from_profile(profile.summarize(df, stats=stats), stats.n_rows, stats.n_cols).first().asDict()
    assert fast == slow
    return fast


def test_sample_frame(spark):
    df = spark.createDataFrame(
        [(10.0, 140, "A"), (20.0, 150, "B"), (30.0, 160, "A"), (None, 170, None)], "age double, height bigint, city string"
    )
    gaps = {r.column: r.missing_count for r in profile.missing_table(df).collect()}
    assert gaps == {"age": 1, "height": 0, "city": 1}
    got = flags(df)
    assert got["quality_score"] == pytest.approx(1 - 0.25 - 0.2)
    assert categories.top_categories(df, 5, 2).count() == 2


def test_constant_column(spark):
    got = flags(spark.createDataFrame([(10, i) for i in range(10)], "ConstantCol bigint, B bigint"))
    assert got["has_constant_columns"] and got["constant_columns_list"] == ["ConstantCol"]
    assert got["quality_score"] == pytest.approx(0.65)


def test_high_cardinality(spark):
    got = flags(spark.createDataFrame([(f"ID_{i}", "A") for i in range(1, 7)], "CardID string, Group string"))
    assert got["high_cardinality_list"] == ["CardID"] and got["constant_columns_list"] == ["Group"]
    assert got["quality_score"] == pytest.approx(0.60)


def test_five_values_are_not_many(spark):
    got = flags(spark.createDataFrame([(f"v{i % 5}", i) for i in range(200)], "t string, n int"))
    assert not got["has_high_cardinality_categoricals"] and got["quality_score"] == pytest.approx(1.0)
    got = flags(spark.createDataFrame([(f"v{i}", i) for i in range(200)], "t string, n int"))
    assert got["high_cardinality_list"] == ["t"]


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "a int, b string")
    got = flags(empty)
    assert got["quality_score"] == pytest.approx(0.65) and got["max_missing_share"] == 0.0
    for judge in (quality.assess, quality.flags_only):
        with pytest.raises(quality.EmptyDataset):
            judge(empty)


def test_assess(spark):
    row = quality.assess(spark.range(200).select("id", (F.col("id") % 3).alias("v"))).first()
    assert row["ok_for_model"] and row["message"] == quality.DATASET_READY
    assert set(row["flags"]) == set(quality.FLAG_NAMES) and not any(row["flags"].values())
    assert row["dataset_shape"] == {"n_rows": 200, "n_cols": 2}


def test_metadata_scores(spark):
    rows = [
        (1, 10000, 12, 0.15, 8, 4),
        (2, 999, 100, 0.0, 1, 1),
        (3, 1000, 101, 0.0, 1, 1),
        (4, 1000, 5, 0.5, 0, 3),
        (5, 1000, 5, 0.51, 3, 0),
        (6, 1000, 5, 0.3, 0, 0),
        (7, 10, 500, 1.0, 0, 1),
        (8, -1, 5, 0.0, 1, 1),
        (9, 10, 5, 1.5, 1, 1),
        (10, 10, None, 0.5, 1, 1),
    ]
    df = spark.createDataFrame(
        rows, "k int, n_rows bigint, n_cols int, max_missing_share double, numeric_cols int, categorical_cols int"
    )
    got = {r.k: r for r in quality.score_metadata(df).collect()}
    want = {1: 0.85, 2: 0.8, 3: 0.9, 4: 0.4, 5: 0.44, 6: 0.7, 7: 0.0}
    assert {k: round(r.quality_score, 9) for k, r in got.items()} == want
    assert got[1].ok_for_model and got[6].ok_for_model and not got[4].ok_for_model
    assert got[2].flags["too_few_rows"] and not got[3].flags["too_few_rows"]
    assert got[3].flags["too_many_columns"] and got[5].flags["too_many_missing"] and not got[4].flags["too_many_missing"]
    assert sorted(r.k for r in quality.rejected_metadata(df).collect()) == [8, 9, 10]


def test_value_counts_do_not_shuffle_long_text(spark):
    df = spark.createDataFrame([("t" * 5000,)] * 20, "t string")
    ((_, counts),) = V.value_counts(df, ["t"])
    row = counts.first()
    # The key holds the beginning of the text, which orders it, a mark and its digest.
    assert row["n"] == 20 and len(row["v"]) == V.ORDERED_CHARS + 65


def test_long_and_short_texts_tie_by_their_text(spark):
    df = spark.createDataFrame([(t,) for t in ("z" * 70, "y" * 80, "a", "b", "c")], "t string")
    row = categories.top_categories(df, top_k=2).collect()
    assert [r["value"] for r in row] == ["a", "b"]


def frequency_frame(spark, kind):
    rng = np.random.default_rng(len(kind))
    n = 6000
    tail = rng.integers(0, 3000, n)
    columns = {
        "skewed": [f"top{i}" for i in rng.zipf(1.7, n).clip(max=60)],
        "tailed": [f"v{t}" if i % 3 else "ab"[i % 2] for i, t in enumerate(tail)],
        "flat": [f"k{i}" for i in rng.permutation(n)],
        "even": [f"e{i % 40}" for i in range(n)],
        "long": ["x" * 70 + str(i % 7 if i % 5 else i) for i in range(n)],
        "gaps": [None if i % 2 else "g" * (i % 6) for i in range(n)],
    }
    rows = list(zip(range(n), *columns.values()))
    return columns, spark.createDataFrame(rows, "row long, " + ", ".join(f"{c} string" for c in columns)).repartition(5)


def brute_top(values, k):
    counts, first = {}, {}
    for i, v in enumerate(values):
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
            first.setdefault(v, i)
    ordered = sorted(counts, key=lambda v: (-counts[v], first[v]))[:k]
    return [(v, counts[v]) for v in ordered]


@pytest.mark.parametrize("tracked,buckets,k", [(4000, 1024, 5), (32, 16, 3), (40, 1, 2)])
def test_top_values_are_exact_at_any_counter_size(spark, monkeypatch, tracked, buckets, k):
    monkeypatch.setattr(V, "TRACKED_VALUES", tracked)
    monkeypatch.setattr(V, "BUCKETS", buckets)
    columns, df = frequency_frame(spark, "mixed")
    got = categories.top_categories(df, 10, k, F.col("row"), columns=list(columns)).collect()
    for name, values in columns.items():
        assert [(r.value, r["count"]) for r in got if r.column == name] == brute_top(values, k), name


def test_only_proven_candidates_travel(spark, monkeypatch):
    """Of a skewed column with many rare values no bucket is counted value by value."""
    heavy = []
    inner = V._heavy
    monkeypatch.setattr(V, "_heavy", lambda *a: heavy.append(inner(*a)) or heavy[-1])
    rows = [(i, f"v{i}" if i % 2 else f"top{i % 10}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "row long, a string").repartition(4)
    got = categories.top_categories(df, top_k=5, order_by=F.col("row")).collect()
    assert [(r.value, r["count"]) for r in got] == [(f"top{i}", 2000) for i in (0, 2, 4, 6, 8)]
    assert heavy and all(not h for h in heavy)


def test_first_values_by_rounds(spark):
    rows = [(3, 1.5, "b", None), (1, float("nan"), "a" * 300, None), (2, 2.5, "a" * 300 + "z", None), (4, 1.5, "b", None), (None, 0.5, "c", None)]
    df = spark.createDataFrame(rows, "row long, x double, t string, n int")
    got = V.first_values(df, ["x", "t", "n"], 3, F.col("row")).collect()
    assert [(r.d, r["rank"]) for r in got if r.c == 0] == [(2.5, 1), (1.5, 2), (0.5, 3)]
    assert [r.s for r in got if r.c == 1] == ["a" * 300, "a" * 300 + "z", "b"]
    assert not [r for r in got if r.c == 2]
    smallest = V.first_values(df, ["x", "t"], 2, None).collect()
    assert [r.d or r.s for r in smallest] == [0.5, 1.5, "a" * 300, "a" * 300 + "z"]
