"""Helpers shared by the corpus operators.

Every operator reads the columns it names and no others, so further columns of any name
pass by. A null text counts as an empty one unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.functions.scalars import column
from tablegauge.session import checkpoint

# A broadcast table holds so many bytes at most.
BROADCAST_BYTES = 16 << 20

# Bytes of text handled together inside a task.
SLICE_BYTES = 1 << 20

SPACE = rb" " + bytes(range(0x09, 0x0E))
CONTINUATION = bytes(range(0x80, 0xC0))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` as an array; null gives an empty one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def content_key(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns, nulls told apart from empty values."""
    parts = [p for c in columns for p in (F.isnull(c), c)]
    return [F.xxhash64(F.lit(salt), *parts) for salt in ("first", "second")]


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, lengthened until no column of ``taken`` has it in any case."""
    used = {t.lower() for t in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def hashable(df: DataFrame) -> list[Column]:
    """All columns of ``df`` in a form that can be hashed."""
    kinds = dict(df.dtypes)
    return [F.to_json(F.struct(column(c))) if "map<" in kinds[c] or "variant" in kinds[c] else column(c) for c in df.columns]


def small_side(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast if counting proves it within ``limit`` bytes, and whether it is.

    Meant for written tables of fixed-width columns; a larger one is left to a shuffled join.
    """
    rows = limit // bytes_per_row
    is_small = df.limit(rows + 1).count() <= rows
    return (F.broadcast(df) if is_small else df), is_small


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Runs of whole texts with about ``limit`` bytes each; a longer text is a run of its own."""
    run: list[bytes] = []
    held = 0
    for text in texts:
        text = text or b""
        if run and held + len(text) > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def map_texts(
    df: DataFrame,
    text: str,
    measure: Callable[[list[bytes | None]], dict[str, pa.Array]],
    fields: Sequence[T.StructField],
    keep: Sequence[str],
) -> DataFrame:
    """The ``keep`` columns of ``df`` with the columns ``measure`` derives from the texts.

    ``measure`` gets the texts of one Arrow batch as UTF-8 bytes, None for null.
    """
    own = [df.schema[c] for c in keep]
    schema = T.StructType([*own, *fields])
    names = schema.names
    n_kept = len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            made = measure(texts)
            kept = [batch.column(i) for i in range(n_kept)]
            yield pa.RecordBatch.from_arrays([*kept, *(made[f.name] for f in fields)], names=names)

    body = free_name("text", keep)
    return df.select(*[column(c) for c in keep], column(text).alias(body)).mapInArrow(run, schema)


__all__ = [
    "checkpoint", "column", "content_key", "free_name", "hashable", "let", "lower_ascii", "map_texts", "slices",
    "small_side", "words_of",
]
