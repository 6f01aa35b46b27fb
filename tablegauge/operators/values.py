"""Typed value counts over many columns at once.

Columns of one storage class (whole numbers, reals, text) are turned into rows ``(c, v)``
of column ordinal and value. Grouping these counts every distinct value of all of them in
one shuffle with map-side combining, where one distinct count per column would expand each
row by the full width; each class reads only its own columns. Text above ``LONG_TEXT``
bytes is grouped by its beginning and its SHA-256, so documents are not shuffled to be
counted and still sort among the others; only long texts with one beginning go by digest.
``restore_text`` brings the few reported ones back.

The most frequent values of a column need no such shuffle: mergeable counters of bounded size
propose candidates, one scan counts these exactly and all other values by hash bucket, and
only buckets that could hold a more frequent value are counted value by value. The first
values of a column are looked for in the first rows, then by taking the minimum a few times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tablegauge.functions.scalars import INTEGRAL, column, float_text, present

LONG_TEXT = 64
# Characters of a long text that decide its order.
ORDERED_CHARS = 256
_DIGEST_MARK = "\u0000"

INT, BOOL, FLOAT, SINGLE, TIME, TEXT = "int", "bool", "float", "single", "time", "text"


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, INTEGRAL):
        return INT
    if isinstance(dtype, T.BooleanType):
        return BOOL
    if isinstance(dtype, T.FloatType):
        return SINGLE
    if isinstance(dtype, (T.DoubleType, T.DecimalType)):
        return FLOAT
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return TIME
    return TEXT


def micros(df: DataFrame, name: str) -> Column:
    """Timestamps as microseconds; printing reads them back in the same session zone."""
    return F.unix_micros(column(name).cast("timestamp"))


def text_slot(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = column(name)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(col.alias("v")))
    return col.cast("string")


def _digest(col: Column) -> Column:
    return F.concat(F.substring(col, 1, ORDERED_CHARS), F.lit(_DIGEST_MARK), F.sha2(col, 256))


def key_text(col: Column) -> Column:
    """Short text as it is, long text as its beginning and digest, which is longer than any short one."""
    return F.when(F.octet_length(col) > LONG_TEXT, _digest(col)).otherwise(col)


# Storage classes: the slot a kind of column is counted in, and its type.
_SLOTS = {INT: "l", BOOL: "l", TIME: "l", FLOAT: "d", SINGLE: "d", TEXT: "s"}
_LAST = 2**63 - 1
_SLOT_TYPES = {"l": "bigint", "d": "double", "s": "string"}
# Columns that share one pass, and the most passes over one table. With an order key, which
# every pass reads again, passes are wider.
_PASS_COLUMNS = 3
WIDE_PASS_COLUMNS = 16
_MOST_PASSES = 16
# Rows in which the first values are looked for before the whole table is.
FIRST_ROWS = 64


def runs(items: list, width: int = _PASS_COLUMNS) -> list[list]:
    """Items cut into passes. A pass reads its own columns only, and passes run side by side."""
    width = max(width, -(-len(items) // _MOST_PASSES))
    return [items[at : at + width] for at in range(0, len(items), width)]


def stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _slot_value(df: DataFrame, name: str, whole_text: bool) -> Column:
    kind = kind_of(df.schema[name].dataType)
    if kind in (INT, BOOL):
        return column(name).cast("bigint")
    if kind == TIME:
        return micros(df, name)
    if kind in (FLOAT, SINGLE):
        return present(df, name).cast("double")
    text = text_slot(df, name)
    return text if whole_text else key_text(text)


def _passes(df: DataFrame, names: list[str], order_by: Column | None, whole_text: bool = False, hashed: bool = False):
    """Per storage class and run of columns: its slot and rows ``(o, c, v)`` without gaps, with a hash ``h`` if wanted."""
    width = _PASS_COLUMNS if order_by is None else WIDE_PASS_COLUMNS
    order = F.lit(0) if order_by is None else order_by
    order = F.coalesce(order.cast("bigint"), F.lit(_LAST))
    for slot in _SLOT_TYPES:
        mine = [(i, n) for i, n in enumerate(names) if _SLOTS[kind_of(df.schema[n].dataType)] == slot]
        for run in runs(mine, width):
            more = [[F.xxhash64(_slot_value(df, n, True)).alias("h")] if hashed else [] for _, n in run]
            entries = [
                F.struct(F.lit(i).alias("c"), _slot_value(df, n, whole_text).alias("v"), *h) for (i, n), h in zip(run, more)
            ]
            yield slot, df.select(order.alias("o"), F.inline(F.array(*entries))).where(F.col("v").isNotNull())


def _as_slots(rows: DataFrame, slot: str, *others: str) -> DataFrame:
    values = [
        (F.col("v") if s == slot else F.lit(None).cast(t)).alias(s) for s, t in _SLOT_TYPES.items()
    ]
    return rows.select("c", *values, *others)


def value_counts(df: DataFrame, names: list[str], order_by: Column | None = None) -> list[tuple[str, DataFrame]]:
    """Per pass ``(slot, frame)`` with ``(c, v, n, o)``: count and first position of each value."""
    return [
        (slot, rows.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o")))
        for slot, rows in _passes(df, names, order_by)
    ]


def distinct_values(df: DataFrame, names: list[str]) -> list[tuple[str, DataFrame]]:
    """Per pass ``(slot, frame)`` with the distinct ``(c, v)`` only."""
    return [(slot, rows.groupBy("c", "v").agg(F.lit(0).alias("o"))) for slot, rows in _passes(df, names, None)]


def first_values(
    df: DataFrame,
    names: list[str],
    k: int,
    order_by: Column | None,
    distinct: list[int] | None = None,
    short: list[bool] | None = None,
) -> DataFrame:
    """``(c, l, d, s, rank)``: the first ``k`` distinct values per column under ``order_by``, else the smallest.

    The first rows under ``order_by`` hold them for most columns. For the others every round takes the first value not
    yet found, of all columns in one scan; a task passes on one row. ``distinct`` tells how many values a column has, which
    saves the round that finds no more, ``short`` which columns have no text above ``LONG_TEXT`` bytes; longer ones
    go by rounds only. Texts come whole. The result holds ``k`` values per column.
    """
    order = F.lit(0) if order_by is None else order_by
    order = F.coalesce(order.cast("bigint"), F.lit(_LAST))
    slots = [_SLOTS[kind_of(df.schema[n].dataType)] for n in names]
    found: list[list] = [[] for _ in names]
    wanted = [k if distinct is None else min(k, d) for d in distinct or [k] * len(names)]
    if order_by is not None:
        narrow = [i for i, s in enumerate(slots) if wanted[i] and (s != "s" or (short is not None and short[i]))]
        for i, values in _in_first_rows(df, [(i, names[i]) for i in narrow], order).items():
            found[i] = values[: wanted[i]]
    open_columns = [i for i, n in enumerate(wanted) if len(found[i]) < n]
    for _ in range(k):
        firsts = []
        for i in open_columns:
            value = _slot_value(df, names[i], whole_text=True)
            new = value.isNotNull() & ~value.isin(found[i]) if found[i] else value.isNotNull()
            firsts.append(F.min(F.when(new, F.struct(order.alias("o"), value.alias("v")))).alias(f"f{i}"))
        if not firsts:
            break
        row = df.agg(*firsts).first()
        for i in open_columns:
            if row[f"f{i}"] is not None:
                found[i].append(row[f"f{i}"]["v"])
        open_columns = [i for i in open_columns if row[f"f{i}"] is not None and len(found[i]) < wanted[i]]
    rows = [
        (i, *(v if s == slot else None for s in _SLOT_TYPES), rank)
        for i, (slot, values) in enumerate(zip(slots, found))
        for rank, v in enumerate(values, 1)
    ]
    types = ", ".join(f"{s} {t}" for s, t in _SLOT_TYPES.items())
    return df.sparkSession.createDataFrame(rows, f"c int, {types}, rank int")


def _in_first_rows(df: DataFrame, columns: list[tuple[int, str]], order: Column) -> dict[int, list]:
    """Per column its distinct values in the first rows under ``order``, by first position, then by value."""
    if not columns:
        return {}
    values = [_slot_value(df, n, whole_text=True).alias(f"v{i}") for i, n in columns]
    rows = df.select(order.alias("o"), *values).orderBy("o").limit(FIRST_ROWS).collect()
    if len(rows) == FIRST_ROWS:
        # Of the last position there may be more rows.
        rows = [r for r in rows if r["o"] < rows[-1]["o"]]
    found = {}
    for i, _ in columns:
        first: dict = {}
        for r in rows:
            if r[f"v{i}"] is not None:
                first.setdefault(r[f"v{i}"], r["o"])
        found[i] = sorted(first, key=lambda v: (first[v], v))
    return found


# Values per column that the counters hold, candidates taken from them for each reported
# value, and the buckets in which all others are counted.
TRACKED_VALUES = 4_000
CANDIDATES_PER_VALUE = 8
BUCKETS = 1024


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _proposed(df: DataFrame, names: list[str], k: int) -> tuple[list[list], list[bool]]:
    """Per column the hashes of the candidates that the counters propose, and whether buckets can prove them.

    Hashes keep long texts out of the counters; values that share one are all counted as candidates.
    """
    n = min(max(CANDIDATES_PER_VALUE * k, 32), TRACKED_VALUES)
    aggs = []
    for i, name in enumerate(names):
        value = _slot_value(df, name, whole_text=True)
        value = F.when(value.isNotNull(), F.xxhash64(value))
        top = F.call_function("approx_top_k", value, F.lit(n), F.lit(max(n, TRACKED_VALUES)))
        aggs += [top.alias(f"t{i}"), F.count(value).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    candidates, provable = [], []
    for i in range(len(names)):
        items = [(x["item"], x["count"]) for x in row[f"t{i}"] or [] if x["item"] is not None]
        candidates.append([v for v, _ in items])
        # Where even the k-th estimate is below a mean bucket, counting the buckets shows nothing.
        least = sorted((c for _, c in items), reverse=True)[:k]
        provable.append(len(items) < n or least[-1] * BUCKETS > row[f"n{i}"])
    return candidates, provable


def top_values(df: DataFrame, names: list[str], k: int, order_by: Column | None = None) -> DataFrame:
    """``(c, l, d, s, n, o, rank)``: the ``k`` most frequent values per column, exactly.

    Ties go to the value seen first, then to the smaller one. What is shuffled is bounded by candidates and
    buckets, unless a column is so even that values outside the candidates could be among the
    first; those in its heavy buckets are then counted too.
    """
    candidates, provable = _proposed(df, names, k)
    spark = df.sparkSession
    counted: list[tuple[str, DataFrame]] = []
    for slot, rows in _passes(df, names, order_by, hashed=True):
        kind = _SLOT_TYPES[slot]
        own = [i for i, n in enumerate(names) if _SLOTS[kind_of(df.schema[n].dataType)] == slot]
        known = spark.createDataFrame([(i, h, True) for i in own if provable[i] for h in candidates[i]], "c int, h long, known boolean")
        flat = [i for i in own if not provable[i]]
        # A bounded number of candidates per column.
        marked = (rows.where(~F.col("c").isin(flat)) if flat else rows).join(F.broadcast(known), ["c", "h"], "left")
        is_known = F.col("known").isNotNull()
        sums = marked.groupBy("c", F.when(is_known, F.col("v")).alias("v"), F.when(~is_known, _bucket(F.col("h"))).alias("b"))
        exact, others = [], []
        for r in sums.agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o")).collect():
            if r["b"] is None:
                exact.append((r["c"], r["v"], r["n"], r["o"]))
            else:
                others.append((r["c"], r["b"], r["n"]))
        heavy = _heavy(exact, others, k) + [(i, b) for i in flat for b in range(BUCKETS)]
        parts = [spark.createDataFrame(exact, f"c int, v {kind}, n bigint, o bigint")]
        if heavy:
            # At most columns x buckets rows.
            there = F.broadcast(spark.createDataFrame(heavy, "c int, b int"))
            rest = rows.withColumn("b", _bucket(F.col("h"))).join(there, ["c", "b"], "left_semi")
            rest = rest.join(F.broadcast(known), ["c", "h"], "left_anti")
            parts.append(rest.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o")))
        counted.append((slot, stack(parts)))
    return first_per_column(counted, k, F.desc("n"), F.col("o"))


def _heavy(exact: list[tuple], others: list[tuple], k: int) -> list[tuple[int, int]]:
    """The buckets that could hold one of the first ``k`` values of their column."""
    least = {}
    for c in {c for c, *_ in exact} | {c for c, *_ in others}:
        sizes = sorted((n for at, _, n, _ in exact if at == c), reverse=True)
        least[c] = sizes[k - 1] if len(sizes) >= k else 1
    return [(c, b) for c, b, n in others if n >= least[c]]


def distinct_counts(counts: list[tuple[str, DataFrame]]) -> DataFrame:
    """``(c, unique)`` from value counts.

    Counting the positions, which are never null, keeps this plan on the same shuffle as
    ``first_per_column``. All passes are counted together, so one row per column and task travels.
    """
    return stack([frame.select("c", "o") for _, frame in counts]).groupBy("c").agg(F.count("o").alias("unique"))


def first_per_column(counts: list[tuple[str, DataFrame]], k: int, *order: Column) -> DataFrame:
    """``(c, l, d, s, n, o, rank)``: the first ``k`` values per column; ties go by value.

    The engine keeps k rows per column in every task before it shuffles, so a wide or
    skewed column does not travel.
    """
    window = Window.partitionBy("c").orderBy(*order, F.col("v"))
    return stack(
        [
            _as_slots(
                frame.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k), slot, "n", "o", "rank"
            )
            for slot, frame in counts
        ]
    )


def restore_text(picked: DataFrame, df: DataFrame, names: list[str], order_by: Column | None) -> DataFrame:
    """Replace digests in ``picked`` by the text they stand for.

    ``picked`` holds at most k rows per column, which bounds the broadcast side.
    """
    texts = [rows for slot, rows in _passes(df, names, order_by, whole_text=True) if slot == "s"]
    if not texts:
        return picked
    full = stack(texts).where(F.octet_length("v") > LONG_TEXT)
    full = full.select("c", _digest(F.col("v")).alias("s"), F.col("v").alias("body"), "o")
    marked = picked.where(F.octet_length("s") > LONG_TEXT).select("c", "s", "o")
    bodies = full.join(F.broadcast(marked), ["c", "s", "o"]).groupBy("c", "s").agg(F.first("body").alias("body"))
    return (
        picked.join(F.broadcast(bodies), ["c", "s"], "left")
        .withColumn("s", F.coalesce("body", "s"))
        .drop("body")
    )


def printed(kind: Column, dtype: Column, midnight: Column) -> Column:
    """Text of a slot value as the column's type prints it."""
    stamp = F.timestamp_micros(F.col("l"))
    fraction = F.pmod(F.col("l"), F.lit(1_000_000)) != 0
    clock = F.when(fraction, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
    )
    return (
        F.when((kind == INT) & (dtype == "float64"), float_text(F.col("l").cast("double")))
        .when(kind == INT, F.col("l").cast("string"))
        .when(kind == BOOL, F.when(F.col("l") == 1, "True").otherwise("False"))
        .when(kind == FLOAT, float_text(F.col("d")))
        .when(kind == SINGLE, F.col("d").cast("float").cast("string"))
        .when(kind == TIME, F.when(midnight, F.date_format(stamp, "yyyy-MM-dd")).otherwise(clock))
        .otherwise(F.col("s"))
    )
