"""Exact order statistics, quantiles, running totals and row numbering without one big sort.

A value at a given rank is found in two scans. The first builds a mergeable rank sketch of
every group, whose error bound gives each rank a narrow bracket of values. The second
counts what lies below the brackets and groups what lies inside, which settles the value
exactly. A bracket that still holds too many rows is sketched again. Should a sketch miss its bound, which the
counts show, the rank is found by narrowing: one scan counts equal-width bins, the bin
that holds the rank becomes the next bracket. Rows are never shuffled to be
ranked, so a group that holds most of a table costs scans, not a task that sorts it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tablegauge.functions.scalars import INTEGRAL
from tablegauge.session import checkpoint

# Rows one task may sort. Larger groups are narrowed first.
TASK_ROWS = 2_000_000
BINS = 1024

# Items a rank sketch keeps per level, and how far from the true rank its answers may be
# taken to be: three times the published error at 99 % confidence, as a share of the rows.
SKETCH_ITEMS = 4096
SKETCH_ERROR = 3 * 2.296 / SKETCH_ITEMS**0.9021

# Ranks read off the sketches in one job.
ASKED_TOGETHER = 500


@dataclass(eq=False)
class Target:
    """The value at 0-based ``rank`` among the ``size`` rows of group ``key``."""

    key: tuple
    rank: int
    size: int
    value: object = None
    done: bool = False
    low: object = None
    high: object = None
    below: int = 0
    _inside: int | None = field(default=None)

    @property
    def inside(self) -> int:
        return self.size if self._inside is None else self._inside


def order_statistics(
    df: DataFrame,
    groups: list[str],
    value: str,
    targets: list[Target],
    limit: int = TASK_ROWS,
    sketch_above: int | None = None,
) -> list[Target]:
    """Fill in ``value`` of every target. Nulls in ``value`` do not count as rows.

    Targets come from the driver: a few per class, column or oversized group. Those whose group has
    more than ``sketch_above`` rows (``limit`` if not given) are found by sketch.
    """
    above = limit if sketch_above is None else sketch_above
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    missed: list[Target] = []
    while wide := [t for t in targets if not t.done and t.inside > above and t not in missed]:
        missed += _sketched(rows, groups, wide, limit)
    while True:
        wide = [t for t in targets if not t.done and t.inside > limit]
        if not wide:
            break
        unbounded = [t for t in wide if t.low is None]
        if unbounded:
            _bound(rows, groups, unbounded)
        else:
            _narrow(rows, groups, wide)
    rest = [t for t in targets if not t.done]
    if rest:
        _settle(rows, groups, rest)
    return targets


def _bracketed(rows: DataFrame, groups: list[str], targets: list[Target]) -> tuple[DataFrame, DataFrame]:
    """Rows inside a bracket with its number ``_b``, and ``(_t, _b, _pos)`` of every target.

    Ranks that still share a bracket read its rows once. Both small frames hold a few
    numbers per target.
    """
    dtype = rows.schema["_v"].dataType
    numbers: dict[tuple, int] = {}
    places = []
    for i, t in enumerate(targets):
        b = numbers.setdefault((t.key, t.low, t.high), len(numbers))
        places.append((i, b, t.rank - t.below))
    schema = T.StructType(
        [T.StructField("_b", T.IntegerType())]
        + [T.StructField(f"_g_{g}", rows.schema[g].dataType) for g in groups]
        + [T.StructField("_lo", dtype), T.StructField("_hi", dtype)]
    )
    spark = rows.sparkSession
    brackets = spark.createDataFrame([(b, *key, lo, hi) for (key, lo, hi), b in numbers.items()], schema)
    match = F.col("_lo").isNull() | F.col("_v").between(F.col("_lo"), F.col("_hi"))
    for g in groups:
        match = match & rows[g].eqNullSafe(brackets[f"_g_{g}"])
    inside = rows.join(F.broadcast(brackets), match)
    return inside, spark.createDataFrame(places, "_t int, _b int, _pos bigint")


def _holding(counts: DataFrame, order: str, wanted: DataFrame) -> DataFrame:
    """The line of ``counts`` that holds the wanted position of each target, with ``before``."""
    upto = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    lines = counts.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    return lines.join(F.broadcast(wanted), "_b").where(
        (F.col("before") <= F.col("_pos")) & (F.col("_pos") < F.col("before") + F.col("n"))
    )


def _sketched(rows: DataFrame, groups: list[str], targets: list[Target], limit: int) -> list[Target]:
    """Settle or narrow targets by one sketching and one counting scan; the ones that neither helped are returned."""
    kind = "bigint" if isinstance(rows.schema["_v"].dataType, INTEGRAL) else "double"
    inside, wanted = _bracketed(rows, groups, targets)
    inside = inside.select("_b", F.col("_v").cast(kind).alias("_v"))
    proposals = _proposals(inside, wanted, targets, kind)
    # A value that fills its bracket is found by the counts, however many rows have it.
    exact = all(2 * SKETCH_ERROR * t.inside <= limit for t in targets)
    found = _located(inside, wanted, proposals, kind, exact)
    missed = []
    for i, t in enumerate(targets):
        if i not in found:
            missed.append(t)
        elif exact:
            t.value, t.done = found[i]["_v"], True
        else:
            r, before = found[i], (t.low, t.high)
            t.low, t.high, t._inside, t.below = r["lo"], r["hi"], r["n"], t.below + r["before"]
            _close(t)
            if (t.low, t.high) == before:
                missed.append(t)
    return missed


def _proposals(inside: DataFrame, wanted: DataFrame, targets: list[Target], kind: str) -> DataFrame:
    """``(_b, lows, highs)``: per bracket the disjoint smaller brackets that its ranks should lie in."""
    spark = inside.sparkSession
    sketches = inside.groupBy("_b").agg(F.expr(f"kll_sketch_agg_{kind}(_v, {SKETCH_ITEMS})").alias("sketch"))
    if len(targets) > ASKED_TOGETHER:
        sketches = checkpoint(sketches)
    numbers = {r["_t"]: r["_b"] for r in wanted.select("_t", "_b").collect()}
    ends: list[tuple[int, object, object]] = []
    for start in range(0, len(targets), ASKED_TOGETHER):
        asked = list(enumerate(targets))[start : start + ASKED_TOGETHER]
        places = {i: (t.rank - t.below + 0.5) / t.inside for i, t in asked}
        shares = [(max(0.0, x - SKETCH_ERROR), min(1.0, x + SKETCH_ERROR)) for x in places.values()]
        # The engine wants the shares as constants, so each sketch answers all of them.
        constants = ", ".join(f"{x!r}D" for pair in shares for x in pair)
        answers = sketches.where(F.col("_b").isin(sorted({numbers[i] for i, _ in asked})))
        answers = answers.selectExpr("_b", f"kll_sketch_get_quantile_{kind}(sketch, array({constants})) AS v").collect()
        by_bracket = {r["_b"]: r["v"] for r in answers}
        ends += [(b, v[2 * k], v[2 * k + 1]) for k, (i, _) in enumerate(asked) for b in [numbers[i]] for v in [by_bracket[b]]]
    merged: dict[int, list[list]] = {}
    for b, low, high in sorted(ends):
        spans = merged.setdefault(b, [])
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    lines = [(b, [s[0] for s in spans], [s[1] for s in spans]) for b, spans in merged.items()]
    return spark.createDataFrame(lines, f"_b int, lows array<{kind}>, highs array<{kind}>")


def _located(inside: DataFrame, wanted: DataFrame, proposals: DataFrame, kind: str, exact: bool) -> dict[int, dict]:
    """For every target whose rank lies in a proposed bracket: its value if ``exact``, else the bracket with its rows."""
    cut = inside.join(F.broadcast(proposals), "_b")
    span = F.size(F.filter("highs", lambda h: h < F.col("_v")))
    cut = cut.select("_b", "_v", span.alias("span"), "lows", "highs")
    held = (F.col("span") < F.size("highs")) & (F.col("_v") >= F.get("lows", F.col("span")))
    # What lies below a bracket counts under null, which sorts before its values.
    value = F.when(held, F.col("_v") if exact else F.get("lows", F.col("span")))
    counts = cut.select("_b", "span", value.alias("_v"), F.get("highs", F.col("span")).alias("hi"))
    counts = counts.groupBy("_b", "span", "_v", "hi").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_b").orderBy("span", F.col("_v").asc_nulls_first())
    lines = counts.withColumn("before", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    met = lines.join(F.broadcast(wanted), "_b").where(
        (F.col("before") <= F.col("_pos")) & (F.col("_pos") < F.col("before") + F.col("n")) & F.col("_v").isNotNull()
    )
    return {r["_t"]: {"_v": r["_v"], "lo": r["_v"], "hi": r["hi"], "n": r["n"], "before": r["before"]} for r in met.collect()}


def _bound(rows: DataFrame, groups: list[str], targets: list[Target]) -> None:
    inside, wanted = _bracketed(rows, groups, targets)
    found = inside.groupBy("_b").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    for r in found.join(F.broadcast(wanted), "_b").collect():
        t = targets[r["_t"]]
        t.low, t.high, t._inside = r["lo"], r["hi"], t.size
        _close(t)


def _close(t: Target) -> None:
    if t.low == t.high:
        t.value, t.done = t.low, True


def _narrow(rows: DataFrame, groups: list[str], targets: list[Target]) -> None:
    lo, hi, v = (F.col(c).cast("double") for c in ("_lo", "_hi", "_v"))
    # The two ends get bins of their own, so that every round moves at least one end.
    inner = F.floor(F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2) * (BINS - 2))
    inner = F.greatest(F.lit(0), F.least(F.coalesce(inner, F.lit(0)), F.lit(BINS - 2))) + 1
    cut = F.when(F.col("_v") == F.col("_lo"), 0).when(F.col("_v") == F.col("_hi"), BINS).otherwise(inner)
    inside, wanted = _bracketed(rows, groups, targets)
    bins = inside.groupBy("_b", cut.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    )
    for r in _holding(bins, "bin", wanted).collect():
        t = targets[r["_t"]]
        t.low, t.high, t._inside, t.below = r["lo"], r["hi"], r["n"], t.below + r["before"]
        _close(t)


def _settle(rows: DataFrame, groups: list[str], targets: list[Target]) -> None:
    inside, wanted = _bracketed(rows, groups, targets)
    counts = inside.groupBy("_b", "_v").agg(F.count(F.lit(1)).alias("n"))
    for r in _holding(counts, "_v", wanted).select("_t", "_v").collect():
        targets[r["_t"]].value = r["_v"]
        targets[r["_t"]].done = True


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    points: dict[str, float],
    limit: int = TASK_ROWS,
    largest_group: int | None = None,
    sketch_above: int | None = None,
    group_sizes: dict[tuple, int] | None = None,
) -> DataFrame:
    """Quantiles per group with linear interpolation, one column per entry of ``points``.

    Groups of up to ``limit`` rows are counted by value and cumulated in a window. Larger
    groups, of which there are at most rows / limit, go by ranks. ``largest_group`` is a
    known bound on the group size, ``group_sizes`` has the rows with a value of every group; without either one scan
    measures the groups. Where groups are known to be
    few, a lower ``sketch_above`` saves counting every value of the middle-sized ones.
    """
    above = limit if sketch_above is None else min(limit, sketch_above)
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    big: dict[tuple, int] = {}
    if group_sizes is not None:
        big = {key: n for key, n in group_sizes.items() if n > above}
    elif largest_group is None or largest_group > above:
        counted = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > above).collect()
        big = {tuple(r[g] for g in groups): r["n"] for r in counted}
    if big and group_sizes is not None and all(n == 0 or key in big for key, n in group_sizes.items()):
        return _by_ranks(rows, groups, points, big, limit, above)
    small = rows
    if big:
        schema = T.StructType([rows.schema[g] for g in groups])
        keys = rows.sparkSession.createDataFrame(list(big), schema)
        same = F.lit(True)
        for g in groups:
            same = same & rows[g].eqNullSafe(keys[g])
        small = rows.join(F.broadcast(keys), same, "left_anti")

    part = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    counts = small.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = counts.withColumns(
        {
            "_cum": F.sum("_n").over(part.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)),
            "_all": F.sum("_n").over(part),
        }
    )
    picks = [F.max("_all").alias("n")]
    for name, q in points.items():
        at = F.lit(q) * (F.col("_all") - 1)
        picks.append(F.min(F.when(F.col("_cum") > F.floor(at), F.col("_v"))).alias(f"_{name}_lo"))
        picks.append(F.min(F.when(F.col("_cum") > F.ceil(at), F.col("_v"))).alias(f"_{name}_hi"))
    ends = ranked.groupBy(*groups).agg(*picks)
    outs = []
    for name, q in points.items():
        at = F.lit(q) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outs.append((low + (high - low) * (at - F.floor(at))).alias(name))
    result = ends.select(*groups, "n", *outs)
    return result.unionByName(_by_ranks(rows, groups, points, big, limit, above)) if big else result


def _by_ranks(
    rows: DataFrame, groups: list[str], points: dict[str, float], sizes: dict[tuple, int], limit: int, above: int
) -> DataFrame:
    """Quantiles of the groups in ``sizes``, each from the two values around its rank."""
    targets, plan = [], []
    for key, n in sizes.items():
        for name, q in points.items():
            at = q * (n - 1)
            low = int(at)
            plan.append((key, n, name, at - low, len(targets)))
            targets += [Target(key, low, n), Target(key, min(low + 1, n - 1), n)]
    order_statistics(rows, groups, "_v", targets, limit, above)
    lines: dict[tuple, dict] = {}
    for key, n, name, part_way, at in plan:
        low, high = targets[at].value, targets[at + 1].value
        lines.setdefault(key, {"n": n})[name] = low + (high - low) * part_way
    data = [(*k, d["n"], *[float(d[p]) for p in points]) for k, d in lines.items()]
    schema = T.StructType(
        [rows.schema[g] for g in groups]
        + [T.StructField("n", T.LongType())]
        + [T.StructField(p, T.DoubleType()) for p in points]
    )
    return rows.sparkSession.createDataFrame(data, schema)


def running_totals(
    counts: DataFrame,
    order: str,
    measures: list[str],
    groups: list[str] | None = None,
    descending: bool = False,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """``counts`` with ``cum_<measure>``: totals up to and including each row.

    ``order`` must be numeric and unique within a group; null sorts first and NaN last
    (reversed when ``descending``), whatever the size. Up to ``limit`` rows go through
    one window per group. Beyond that the order axis is cut at sampled quantiles, every
    slice is cumulated on its own and shifted by the totals of the slices before it; the
    cuts are fixed numbers, so a task that is run again cuts alike.
    """
    groups = groups or []
    direction = F.desc if descending else F.asc
    # Written once, because the size, the cuts and the totals all read it.
    counts = checkpoint(counts)
    size = counts.count()
    if size <= limit:
        window = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(direction(order))
        window = window.rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumns({f"cum_{m}": F.sum(m).over(window) for m in measures})

    sliced = _sliced(counts, order, size, limit)
    inner = Window.partitionBy(*groups, "_slice").orderBy(direction(order))
    inner = inner.rowsBetween(Window.unboundedPreceding, 0)
    sliced = sliced.withColumns({f"cum_{m}": F.sum(m).over(inner) for m in measures})
    totals = sliced.groupBy(*groups, "_slice").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    outer = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(direction("_slice"))
    outer = outer.rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(f"_t_{m}").over(outer), F.lit(0)).alias(f"_b_{m}") for m in measures],
    )
    same = F.col("_slice") == F.col("_s")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = sliced.join(before, same)
    return joined.select(
        *counts.columns, *[(F.col(f"cum_{m}") + F.col(f"_b_{m}")).alias(f"cum_{m}") for m in measures]
    )


def _sliced(rows: DataFrame, order: str, size: int, limit: int) -> DataFrame:
    """``rows`` with ``_slice``, runs of the order axis cut at sampled quantiles, ascending."""
    slices = min(4096, size // limit + 2)
    cuts = sorted(set(rows.approxQuantile(order, [i / slices for i in range(1, slices)], 0.1 / slices)))
    edges = [float("-inf"), *cuts, float("inf")]
    # NaN goes behind the last slice and null before the first, where a window sorts them too.
    cutter = Bucketizer(splits=edges, inputCol="_axis", outputCol="_slice", handleInvalid="keep")
    axis = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    sliced = cutter.transform(rows.withColumn("_axis", axis)).drop("_axis")
    return sliced.withColumn("_slice", F.when(F.col(order).isNull(), F.lit(-1.0)).otherwise(F.col("_slice")))


def with_next(
    rows: DataFrame,
    order: str,
    columns: list[str],
    groups: list[str] | None = None,
    descending: bool = False,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """``rows`` with ``next``, a struct of ``columns`` of the row behind; null for the last of a group.

    ``order`` must be numeric and unique within a group. Beyond ``limit`` rows the axis is cut into slices, and
    the first row of each is handed to the last one of the slice before it.
    """
    groups = groups or []
    direction = F.desc if descending else F.asc
    rows = checkpoint(rows)
    size = rows.count()
    values = F.struct(*columns)
    if size <= limit:
        window = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(direction(order))
        return rows.withColumn("next", F.lead(values).over(window))
    inner = Window.partitionBy(*groups, "_slice").orderBy(direction(order))
    sliced = _sliced(rows, order, size, limit)
    sliced = checkpoint(sliced.withColumns({"next": F.lead(values).over(inner), "_place": F.row_number().over(inner)}))
    outer = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(direction("_slice"))
    heads = sliced.where("_place = 1").withColumn("_head", F.lead(values).over(outer))
    heads = heads.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_slice").alias("_s"), "_head")
    same = F.col("_slice") == F.col("_s")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return sliced.join(heads, same).select(*rows.columns, F.coalesce("next", "_head").alias("next"))


def seeded_hash(row_id: Column, seed: int, purpose: str = "split") -> Column:
    """A 64-bit hash of a bigint id under a seed; distinct ids keep distinct hashes.

    Hashes for different purposes are independent, so rows picked by one are not picked by another.
    """
    return F.xxhash64(F.lit(purpose), F.lit(seed).cast("bigint"), row_id.cast("bigint"))


def shuffled_positions(
    df: DataFrame, row_id: str, seed: int, n_rows: int, name: str = "position", purpose: str = "shuffle"
) -> DataFrame:
    """``df`` with every row's 0-based place in a random order of its ids.

    Rows fall evenly into hash slices; a row's place is the size of the slices before its
    own plus its rank inside, so no task sees more than one slice of the table.
    """
    slices = max(1, min(65_536, -(-n_rows // 200_000)))
    hashed = df.withColumn("_h", seeded_hash(F.col(row_id), seed, purpose))
    # The top 30 bits of the hash, spread over the slices.
    top = F.shiftrightunsigned("_h", 34)
    hashed = hashed.withColumn("_slice", F.shiftright(top * F.lit(slices).cast("bigint"), 30).cast("int"))
    sizes = hashed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_slice",
        F.coalesce(
            F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    inside = Window.partitionBy("_slice").orderBy("_h", row_id)
    return (
        hashed.join(F.broadcast(before), "_slice")
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_h", "_slice", "_before")
    )
