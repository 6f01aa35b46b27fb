"""Records of delimited text with line breaks in quotes, cut in parallel.

Whether a line begins inside quotes depends on all lines before it. Every task follows its
byte range from both possible states and reports where each leads; a running composition
over the ranges, one small row each, fixes the state at their starts. A second pass cuts
records in every range at once; only a record that crosses into the next range is put
together from its fragments. Lines are decoded one by one, so any encoding will do that
keeps the byte of the line feed for itself.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegauge.session import checkpoint, if_small

# A record's place among those of its range; ranges are numbered above these bits.
PLACE_BITS = 33


class QuoteStates:
    """Follows the state "inside quotes" over lines.

    A quote opens only at the start of a field and is doubled to stand for itself; elsewhere it is a plain character.
    """

    def __init__(self, sep: str, quote: str = '"'):
        s, q = re.escape(sep), re.escape(quote)
        inner = f"(?:[^{q}]++|{q}{q})*+"
        field = f"(?:{q}{inner}{q}(?:(?!{s}).)*+|(?!{q})(?:(?!{s}).)*+)"
        self.quote = quote
        self.closed = re.compile(f"{field}(?:{s}{field})*+", re.DOTALL)
        self.left = re.compile(f"{inner}{q}(?:(?!{s}).)*+(?:{s}{field})*+", re.DOTALL)

    def after(self, line: str, inside: bool) -> bool:
        if self.quote not in line:
            return inside
        return (self.left if inside else self.closed).fullmatch(line) is None


def _decoded(raw: bytes, encoding: str, first: bool) -> str:
    text = raw.decode(encoding, "strict")
    # A mark at the start of a file is no part of its text.
    return text[1:] if first and text[:1] == "﻿" else text


def _codec(encoding: str) -> str:
    """The codec for single lines: the byte order mark is taken off by ``_decoded``."""
    name = codecs.lookup(encoding).name
    name = "utf-8" if name == "utf-8-sig" else name
    # Encodings with shifts between lines, or with line feeds inside other characters, can't be cut at lines.
    if name.startswith(("utf-16", "utf-32", "iso2022", "hz", "utf-7")) or "\n".encode(name) != b"\n":
        raise ValueError(f"encoding '{encoding}' can't be read line by line")
    return name


def _lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("value string").option("lineSep", "\n").text(path)
    return raw.select("_metadata.file_path", "_metadata.file_block_start", "value")


def _walk(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[tuple[str, int, str, bool]]:
    """File, range, line, and whether the line is the first of its range."""
    now = None
    for batch in batches:
        places = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for here, value in zip(places, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            first = here != now
            now = here
            yield *here, _decoded(value, encoding, first and here[1] == 0), first


def _leads(spark: SparkSession, path: str, states: QuoteStates, encoding: str) -> DataFrame:
    """``(file, block, from_outside, from_inside)``: the state behind each range for both states before it."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for file, block, line, first in _walk(batches, encoding):
            if first:
                rows.append([file, block, False, True])
            if states.quote in line:
                rows[-1][2] = states.after(line, rows[-1][2])
                rows[-1][3] = states.after(line, rows[-1][3])
        if rows:
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "from_outside", "from_inside"])

    schema = "file string, block long, from_outside boolean, from_inside boolean"
    return _lines(spark, path).mapInArrow(follow, schema)


def _starts(leads: DataFrame) -> DataFrame:
    """``(file, block, number, inside)``: ranges in order, and the state each begins in.

    A range that leads to one state from both fixes it; after it, ranges that swap the
    states count by their parity. One row per range is ordered per file.
    """
    swap = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    leads = leads.withColumns({"fixed": F.col("from_outside") == F.col("from_inside"), "swap": swap})
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = leads.withColumn("swaps", F.sum("swap").over(upto))
    known = F.when(F.col("fixed"), F.struct("block", F.col("from_outside").alias("state"), "swaps"))
    last = summed.withColumns({"last": F.max(known).over(before), "so_far": F.coalesce(F.sum("swap").over(before), F.lit(0))})
    odd = (F.col("so_far") - F.coalesce("last.swaps", F.lit(0))) % 2 == 1
    inside = F.coalesce("last.state", F.lit(False)) != odd
    # Ranges are few: one for so many bytes.
    number = F.row_number().over(Window.orderBy("file", "block")) - 1
    return last.select("file", "block", number.cast("bigint").alias("number"), inside.alias("inside"))


def _cut(states: QuoteStates, encoding: str):
    """Records of each range: (file, number, place, kind, text), kind 0 for a whole record, 1 for an open end, 2 for what
    continues an earlier one, with ``closes`` telling whether it ends there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: list[str] = []
        file, number, place, inside, continues = None, -1, 0, False, False

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            columns = [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["file", "number", "place", "kind", "closes", "text"])

        def close() -> None:
            nonlocal held, continues
            if held:
                rows.append((file, number, place, 2 if continues else 1, False, "\n".join(held)))
            held, continues = [], False

        for part in batches:
            columns = [part.column(i).to_pylist() for i in range(4)]
            for f, n, at, starts_inside, raw in zip(*columns, part.column(4).cast(pa.binary()).to_pylist(), strict=True):
                first = n != number
                if first:
                    close()
                    file, number, place, inside, continues = f, n, 0, starts_inside, starts_inside
                line = _decoded(raw, encoding, first and at == 0)
                held.append(line)
                inside = states.after(line, inside)
                if not inside:
                    rows.append((f, n, place, 2 if continues else 0, True, "\n".join(held)))
                    held, continues, place = [], False, place + 1
            if len(rows) >= 4096:
                yield batch()
                rows = []
        close()
        if rows:
            yield batch()

    return run


def _stitched(rows: pa.Table) -> pa.Table:
    """One record from its fragments."""
    rows = rows.sort_by("number")
    text = "\n".join(rows.column("text").to_pylist())
    first = rows.slice(0, 1)
    return pa.table({"file": first.column("file"), "number": first.column("number"), "place": first.column("place"), "text": pa.array([text])})


def records(spark: SparkSession, path: str, sep: str, encoding: str) -> DataFrame:
    """``(row, header, text)``: the records of all files in order, numbered by ``row``; ``header`` marks the first of a file.

    The text keeps its line breaks, without the one that ends the record. Blank records are left out.
    """
    name = _codec(encoding)
    states = QuoteStates(sep)
    starts = checkpoint(_starts(_leads(spark, path, states, name)))
    lines = _lines(spark, path).withColumnsRenamed({"file_path": "file", "file_block_start": "block"})
    lines = lines.withColumn("line", F.monotonically_increasing_id())
    known = if_small(starts)
    placed = lines.join(known, ["file", "block"]).select("file", "number", "block", "inside", "value", "line")
    # A broadcast leaves the lines in their order; after a shuffle they are put back.
    if known is starts:
        placed = placed.repartition("number").sortWithinPartitions("number", "line")
    schema = "file string, number long, place long, kind int, closes boolean, text string"
    cut = checkpoint(placed.drop("line").mapInArrow(_cut(states, name), schema))

    # A fragment belongs to the last range that left a record open.
    opens = F.when(F.col("kind") == 1, F.struct("number", "place"))
    upto = Window.partitionBy("file").orderBy("number", "place").rowsBetween(Window.unboundedPreceding, 0)
    parts = cut.where("kind > 0").select("file", "number", "place", "kind")
    owned = parts.withColumn("owner", F.max(opens).over(upto)).select("file", "number", "place", "owner")
    fragments = cut.where("kind > 0").join(checkpoint(owned), ["file", "number", "place"])
    joined = fragments.select(F.col("owner").alias("of"), "file", "number", "place", "text").groupBy("file", "of")
    whole = joined.applyInArrow(lambda rows: _stitched(rows), "file string, number long, place long, text string")
    every = cut.where("kind = 0").select("file", "number", "place", "text").union(whole)
    every = every.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
    firsts = starts.where("block = 0").select("number", F.lit(True).alias("begins"))
    row = F.shiftleft(F.col("number"), PLACE_BITS) + F.col("place")
    marked = every.join(if_small(firsts), "number", "left").select(
        row.alias("row"), (F.coalesce("begins", F.lit(False)) & (F.col("place") == 0)).alias("header"), "text"
    )
    return marked.where(F.col("header") | (F.col("text") != ""))
