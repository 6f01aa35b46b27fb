"""How often profiles read their input, and that few scans give the same values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablegauge.operators import profile
from tablegauge.operators import values as V
from tablegauge.operators.ranks import exact_quantiles


def watched(spark, data: pd.DataFrame, schema: str):
    """``data`` as a frame of two partitions, and a counter of the rows read from it."""
    read = spark.sparkContext.accumulator(0)

    def passed(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    base = spark.createDataFrame(data, schema).repartition(2).localCheckpoint()
    return base.mapInPandas(passed, schema), read


def _table(n=1000):
    rng = np.random.default_rng(n)
    data = {f"i{k}": rng.integers(0, 10 ** (k + 1), n) for k in range(4)}
    return pd.DataFrame(data | {f"d{k}": rng.normal(0, 1, n).round(k) for k in range(4)})


_SCHEMA = "i0 bigint, i1 bigint, i2 bigint, i3 bigint, d0 double, d1 double, d2 double, d3 double"
_SHOWN = {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}


def _check(got, data):
    want = data.describe().T
    got = got.toPandas().set_index("column")
    assert list(got.index) == list(want.index)
    for mine, theirs in _SHOWN.items():
        assert np.allclose(got[mine].astype(float), want[theirs].astype(float), equal_nan=True), mine


def test_describe_reads_large_columns_three_times(spark, monkeypatch):
    monkeypatch.setattr(profile, "SKETCHED_ROWS", 100)
    data = _table()
    df, read = watched(spark, data, _SCHEMA)
    _check(profile.describe(df), data)
    # Statistics, sketches, values near the quartiles: all columns each time.
    assert read.value == 3 * len(data)


@pytest.mark.parametrize("sketched", [50, 100, 50_000])
def test_describe_of_odd_columns(spark, monkeypatch, sketched):
    """Columns on both sides of the size, without values, with NaN, with rows that come twice."""
    monkeypatch.setattr(profile, "SKETCHED_ROWS", sketched)
    data = pd.concat([_table(150), _table(150)[:50]], ignore_index=True).astype(float)
    data.loc[:120, "d1"] = np.nan
    data.loc[:, "d2"] = np.nan
    data.loc[::3, "d3"] = np.nan
    rows = data.astype(object).where(data.notna(), None).values.tolist()
    df = spark.createDataFrame(rows, _SCHEMA.replace("bigint", "double"))
    df = df.withColumn("d3", F.coalesce("d3", F.lit(float("nan"))))
    _check(profile.describe(df), data)


def test_describe_of_texts_that_hold_numbers(spark, monkeypatch):
    monkeypatch.setattr(profile, "SKETCHED_ROWS", 3)
    df = spark.createDataFrame([("1",), ("2",), (None,), ("4",), ("9",)], "t string")
    row = profile.describe(df, ["t"]).first()
    assert (row["count"], row["q25"], row["q50"], row["q75"]) == (4, 1.75, 3.0, 5.25)


@pytest.mark.parametrize("limits", [{"limit": 10}, {"limit": 1000, "sketch_above": 10}, {}])
def test_quantiles_with_known_sizes(spark, limits):
    rows = [(g, float(i)) for g, n in ((None, 40), (1, 30), (2, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, v double")
    counted, known = (
        {r.g: r for r in exact_quantiles(df, ["g"], "v", {"p10": 0.1, "p75": 0.75}, **limits, **more).collect()}
        for more in ({}, {"group_sizes": {(None,): 40, (1,): 30, (2,): 5, (3,): 0}})
    )
    assert known == counted and len(known) == 3


def test_profile_looks_for_examples_in_one_scan(spark):
    data = _table()
    data["i0"] = data["i0"] % 2
    df, read = watched(spark, data.assign(row=np.arange(len(data))), _SCHEMA + ", row bigint")
    got = profile.summarize(df, F.col("row")).toPandas().set_index("name")
    for name in data:
        assert got.loc[name, "unique"] == data[name].nunique()
        assert [float(v) for v in got.loc[name, "example_values"]] == list(dict.fromkeys(data[name]))[:3]
    # Statistics, two passes for the whole numbers, two for the others, the first rows.
    assert read.value == 6 * len(data)


def _first_of(rows, k):
    """The first ``k`` distinct values of ``(order, value)`` pairs, ties by value."""
    first = {}
    for o, v in rows:
        if v is not None and v == v:
            o = 2**63 - 1 if o is None else o
            first[v] = min(o, first.get(v, o))
    return sorted(first, key=lambda v: (first[v], v))[:k]


@pytest.mark.parametrize("told", [False, True])
@pytest.mark.parametrize("looked_at", [1, 2, 5, 64])
def test_first_values_of_odd_rows(spark, monkeypatch, looked_at, told):
    """Positions that tie or are missing, NaN, late values, long texts, columns of few or no values."""
    monkeypatch.setattr(V, "FIRST_ROWS", looked_at)
    order = [3, 1, 1, 1, None, 2, 2, 7, None, 9, 9, 1]
    x = [1.5, float("nan"), 2.5, 0.5, 9.5, None, 2.5, 1.5, 8.5, 0.0, -0.5, 2.5]
    t = ["b", "é", "z", "a", "c", None, "a", "\U0001f600", "d", "", "z", "￮"]
    long = ["k" * 90 + str(i % 5) for i in range(12)]
    n = [4] * 6 + [None] * 5 + [5]
    rows = list(zip(order, x, t, long, n, [None] * 12)) * 2
    df = spark.createDataFrame(rows, "o long, x double, t string, long string, n int, e int").repartition(3)
    names = ["x", "t", "long", "n", "e"]
    wanted = [_first_of([(r[0], r[i]) for r in rows], 3) for i in range(1, 6)]
    known = []
    if told:
        seen = {r["c"]: r["unique"] for r in V.distinct_counts(V.distinct_values(df, names)).collect()}
        assert [seen.get(c, 0) for c in range(5)] == [7, 9, 5, 2, 0]
        known = [[seen.get(c, 0) for c in range(5)], [True, True, False, True, True]]
    got = {}
    for r in sorted(V.first_values(df, names, 3, F.col("o"), *known).collect(), key=lambda r: (r["c"], r["rank"])):
        got.setdefault(r["c"], []).append(next(r[s] for s in "lds" if r[s] is not None))
    assert [got.get(c, []) for c in range(5)] == wanted


def test_distinct_counts_of_all_passes_travel_once(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 1.5, "a")] * 3, "a int, b int, c int, d int, e double, f string")
    plan = V.distinct_counts(V.distinct_values(df, df.columns))._jdf.queryExecution().executedPlan().toString()
    # One shuffle of the values in each of four passes, one of their counts.
    assert plan.count("Exchange hashpartitioning") == 5
