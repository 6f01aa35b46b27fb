"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.llm.common import checkpoint, column, content_key, free_name, hashable, map_texts
from tablegauge.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42

# A block with more fingerprints is cut by further bits instead of being compared.
BLOCK_LIMIT = 4096


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text as a signed number; zero without a word."""
    # Lower and split of bytes know ASCII letters and the six ASCII blanks only.
    found = (text or b"").lower().split()
    if not found:
        return 0
    spans = zip(*(found[i:] for i in range(words))) if len(found) >= words else [found]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(s), HASH_SEED) for s in spans), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """The ``keep`` columns of every document with its ``fp``."""

    def measure(texts: list[bytes | None]) -> dict[str, pa.Array]:
        return {"fp": pa.array([fingerprint(t, words) for t in texts], type=pa.int64())}

    return map_texts(docs, text, measure, [T.StructField("fp", T.LongType())], keep)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def block_masks(mask: int, max_bits: int) -> list[int]:
    """Masks that extend ``mask`` so that a close pair equal under it is equal under one of them.

    The bits outside ``mask`` are cut into twice ``max_bits`` blocks. ``max_bits`` differing
    bits touch that many blocks at most, so the pair agrees in as many others.
    """
    rest = [b for b in range(64) if not mask >> b & 1]
    n = 2 * max_bits
    blocks = [sum(1 << b for b in rest[len(rest) * i // n : len(rest) * (i + 1) // n]) for i in range(n)]
    return [mask | sum(chosen) for chosen in combinations(blocks, max_bits)]


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect whatever is close within a block: one fewer than nodes at most."""
    start: list[int] = []
    end: list[int] = []
    left = fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            # Of signed numbers the function would count the bits of the absolute value.
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                start += [int(at)] * len(found)
                end += found.tolist()
                queue += list(found)
    return start, end


def _link_blocks(max_bits: int, limit: int):
    """Reads (mask, fp) rows sorted by block; gives links, and the rows of overfull blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_mask = np.empty(0, dtype=np.int64)
        tail_fp = np.empty(0, dtype=np.int64)
        overfull: tuple[int, int] | None = None

        def table(a, b, mask) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64()), pa.array(mask, type=pa.int64())],
                names=["a", "b", "mask"],
            )

        def put_off(mask: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            return table(fp, [None] * len(fp), mask)

        def link(runs: list[np.ndarray]) -> pa.RecordBatch | None:
            a: list[int] = []
            b: list[int] = []
            for fps in runs:
                x, y = _forest(fps, max_bits)
                a += x
                b += y
            return table(a, b, [None] * len(a)) if a else None

        for batch in batches:
            mask = np.concatenate([tail_mask, batch.column(0).to_numpy()])
            fp = np.concatenate([tail_fp, batch.column(1).to_numpy()])
            if not len(fp):
                continue
            key = fp & mask
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = np.concatenate([[0], cuts, [len(fp)]])
            done = []
            for i in np.flatnonzero(np.diff(bounds) > 1 if overfull is None else np.diff(bounds) > 0):
                lo, hi = bounds[i], bounds[i + 1]
                last = hi == len(fp)
                if overfull == (int(mask[lo]), int(key[lo])) or hi - lo > limit:
                    overfull = (int(mask[lo]), int(key[lo])) if last else overfull
                    yield put_off(mask[lo:hi], fp[lo:hi])
                elif not last:
                    done.append(fp[lo:hi])
            if (made := link(done)) is not None:
                yield made
            lo = bounds[-2]
            if overfull == (int(mask[lo]), int(key[lo])):
                tail_mask, tail_fp = mask[:0], fp[:0]
            else:
                overfull = None
                tail_mask, tail_fp = mask[lo:], fp[lo:]
        if len(tail_fp) > 1 and (made := link([tail_fp])) is not None:
            yield made

    return run


def close_links(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = BLOCK_LIMIT) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints ``fp`` whose graph has the components of
    "at most ``max_bits`` bits differ"; not every close pair is named.

    Rows are sorted by block and compared within it. The rows of a block above ``limit`` go
    once more through blocks of the bits still open, until the open bits allow too few
    values to exceed the limit; nothing is left out. A block is never held whole beyond the limit.
    """
    spark = fps.sparkSession
    if limit < 256:
        raise ValueError("limit must allow the 256 values of the last eight bits")
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    known = {0: block_masks(0, max_bits)}
    rows = fps.where(F.col("fp").isNotNull()).select(
        F.explode(F.array(*[F.lit(_signed(m)) for m in known[0]])).alias("mask"), "fp"
    )
    links = None
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask"))
        dealt = rows.repartition("mask", key).sortWithinPartitions("mask", key, "fp")
        made = checkpoint(dealt.mapInArrow(_link_blocks(max_bits, limit), "a long, b long, mask long"))
        found = made.where(F.col("b").isNotNull()).select("a", "b")
        links = found if links is None else links.union(found)
        open_masks = [r[0] for r in made.where(F.col("b").isNull()).select("mask").distinct().collect()]
        if not open_masks:
            return links
        # At most 20 times as many masks as before, so a small table.
        finer = [(m, _signed(f)) for m in open_masks for f in block_masks(m & (1 << 64) - 1, max_bits)]
        finer_table = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        rows = made.where(F.col("b").isNull()).join(finer_table, "mask").select(F.col("finer").alias("mask"), F.col("a").alias("fp"))


def _with_group(prints: DataFrame, first: Column, max_bits: int) -> DataFrame:
    """Per fingerprint of the written table ``prints``: the smallest ``first`` of its component."""
    own = checkpoint(prints.groupBy("fp").agg(F.min(first).alias("own")))
    roots = checkpoint(components(close_links(own.select("fp"), max_bits)))
    linked = own.join(roots, own["fp"] == roots["node"]).select("fp", "root", "own")
    lowest = linked.groupBy("root").agg(F.min("own").alias("lowest"))
    moved = linked.join(lowest, "root").select("fp", "lowest")
    # Written, so that a join by a fingerprint many documents share can be split.
    return checkpoint(own.join(moved, "fp", "left").select("fp", F.coalesce("lowest", "own").alias("first")))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per document.

    The fingerprint is written as 16 hexadecimal digits. ``component_id`` is the smallest id
    reachable over links of at most ``max_bits`` differing bits. Null and empty texts have
    the fingerprint zero and are linked like any other. Repeated rows stay repeated. A row
    without an id takes part with its text; its component is the smallest id there, or null.
    An empty table gives an empty result.
    """
    keyed = docs.select(column(id).alias("id"), column(text).alias("text"))
    prints = checkpoint(fingerprints(keyed, ["id"], words=words))
    groups = _with_group(prints, F.col("id"), max_bits)
    return prints.join(groups, "fp").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents with one of each component: that of the smallest id.

    Ties of the id are settled by the content; of fully equal rows one stays. Rows without
    an id come last. All columns stay as they are.
    """
    marks = ["k1", "k2"]
    content = [k.alias(n) for k, n in zip(content_key(*hashable(docs)), marks, strict=True)]
    keyed = docs.select(F.isnull(column(id)).alias("unknown"), column(id).alias("id"), *content, column(text).alias("text"))
    place = ["unknown", "id", *marks]
    prints = checkpoint(fingerprints(keyed, place, words=words))
    chosen = checkpoint(_with_group(prints, F.struct(*place), max_bits).select("first.*").distinct())
    n_chosen, n_rows = chosen.count(), prints.join(chosen.select(*marks), marks, "left_semi").count()
    row = content_key(*hashable(docs))
    wanted = chosen.select(F.struct(*marks).alias("mark"))
    kept = docs.join(wanted, F.struct(row[0].alias("k1"), row[1].alias("k2")) == wanted["mark"], "left_semi")
    if n_rows == n_chosen:
        return kept
    # Rows of any type are told apart by the hashes of their content.
    names = [free_name("first", docs.columns), free_name("second", docs.columns)]
    marked = kept.withColumns(dict(zip(names, row, strict=True)))
    return marked.dropDuplicates(names).drop(*names)
