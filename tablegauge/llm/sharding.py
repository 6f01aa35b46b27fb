"""Shards of near equal bytes by sampled splitters, in DataFrame functions only.

Records are ordered by a hash of their text and then of their id, so copies lie together. A size-weighted
sample of that order gives the borders of many ranges; ranges that turn out overfull are cut
again by a sample of their own. Exact sums over the ranges then place every record.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import checkpoint, column

SHARDS = 16
RANGES = 1024
SAMPLE_PER_RANGE = 8
MAX_ROUNDS = 8
KEYS = ["k1", "k2", "k3"]

# Leading bits of the first key by which a record finds the borders near it.
PREFIX_BITS = 12

Border = tuple[int, int, int]


def _weighted_sample(records: DataFrame, n: int) -> list[Border]:
    """The keys of ``n`` records, drawn with chances by size, in order."""
    # The smallest of exponential waiting times with rates by size, from a hash of the key.
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *KEYS), 11).cast("double")
    wait = -F.log((bits + 1) / F.lit(float(1 << 53))) / F.col("size")
    rows = records.select(*KEYS, wait.alias("wait")).orderBy("wait", *KEYS).limit(n).select(*KEYS).collect()
    return sorted(tuple(r) for r in rows)


def _cuts(sample: list[Border], n: int) -> list[Border]:
    """Borders that cut the sample into ``n`` equal parts."""
    return sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []


def _with_range(records: DataFrame, borders: list[Border]) -> DataFrame:
    """Number each record's range: how many borders are at or below its key.

    The borders come as one small row for each prefix of the first key, at most
    ``2 ** PREFIX_BITS`` rows with all borders once.
    """
    spark = records.sparkSession
    shift = 64 - PREFIX_BITS
    firsts = [b[0] >> shift for b in borders]
    low, high = -(1 << (PREFIX_BITS - 1)), 1 << (PREFIX_BITS - 1)
    rows, at = [], 0
    for prefix in range(low, high):
        end = bisect_right(firsts, prefix)
        rows.append((prefix, at, [dict(zip(KEYS, b, strict=True)) for b in borders[at:end]]))
        at = end
    schema = "prefix long, below int, near array<struct<k1: long, k2: long, k3: long>>"
    table = F.broadcast(spark.createDataFrame(rows, schema))
    own = F.struct(*KEYS)
    place = F.col("below") + F.size(F.filter("near", lambda b: b <= own))
    prefixed = records.withColumn("prefix", F.shiftright("k1", shift))
    return prefixed.join(table, "prefix").select(*records.columns, place.alias("range"))


def assign(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``, one row per document.

    ``size`` is the UTF-8 bytes of the text plus one, a null text has none. Shards follow the order of the keys; each ends
    where the running size comes nearest to its share, so the sizes of two shards differ by about
    one document. ``slot`` numbers the records of a shard without a gap from 0. Copies of a text are
    neighbours and share a shard unless a border falls among them. Equal rows, null ids and
    null texts are placed like any other; with fewer documents than shards some stay empty.
    Reruns agree up to the exchange of fully equal rows.
    """
    body = F.coalesce(column(text), F.lit("")).cast("binary")
    known = column(text)
    records = checkpoint(
        docs.select(
            column(id).alias("id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(F.isnull(known), known).alias("k1"),
            F.xxhash64(F.isnull(column(id)), column(id)).alias("k2"),
            # Tells fully equal rows apart, so that many of them can still be cut.
            F.monotonically_increasing_id().alias("k3"),
        )
    )
    borders = _cuts(_weighted_sample(records, ranges * SAMPLE_PER_RANGE), ranges)
    for _ in range(MAX_ROUNDS):
        ranged = _with_range(records, borders)
        sums = ranged.groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        most = 4 * sum(r["size"] for r in sums) // ranges + 1
        overfull = [r["range"] for r in sums if r["size"] > most and r["n"] > 1]
        finer = []
        if overfull:
            crowd = ranged.where(F.col("range").isin(overfull))
            finer = _cuts(_weighted_sample(crowd, ranges * SAMPLE_PER_RANGE), ranges)
        more = sorted({*borders, *finer})
        if len(more) == len(borders):
            break
        borders = more

    # The ranges are bounded by the number of borders; each tells what lies before it.
    size_before: dict[int, int] = {}
    rows_before: dict[int, int] = {}
    size, rows = 0, 0
    for r in sorted(sums, key=lambda r: r["range"]):
        size_before[r["range"]], rows_before[r["range"]] = size, rows
        size, rows = size + r["size"], rows + r["n"]
    spark = docs.sparkSession
    before = F.broadcast(
        spark.createDataFrame(
            [(r, size_before[r], rows_before[r]) for r in size_before], "range int, size_before long, rows_before long"
        )
    )
    inside = Window.partitionBy("range").orderBy(*KEYS)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select(
        "id", "size", "text_crc32", "range",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size_inside"),
        (F.row_number().over(inside) - 1).alias("rows_inside"),
    ).join(before, "range")
    # The middle of a record decides its shard.
    middle = 2 * (F.col("size_before") + F.col("size_inside")) + F.col("size")
    shard: Column = F.least(F.floor(middle * shards / F.lit(2.0 * max(size, 1))), F.lit(shards - 1)).cast("int")
    placed = checkpoint(
        placed.select(
            "id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("rows_inside")).alias("row")
        )
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id), "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )
