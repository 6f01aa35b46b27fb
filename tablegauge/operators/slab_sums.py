"""Sums of distances from every point to every cluster, for points of many coordinates and few clusters.

Every two points are compared, as the definition asks. Points travel as packed blocks in slabs: a task
holds one slab with its sums, the blocks of the other pass by, and each block gives one matrix of sums per
pair of slabs. So what is written grows with the points times the slabs, and no line per block pair,
point and cluster is made.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.session import checkpoint, even_keys

# Points of a packed block at most.
PACK_ROWS = 4_096
# Bytes of the points of a slab and of their sums, which a task holds.
SLAB_BYTES = 128 << 20
# Points whose distances to a block are worked out together.
CHUNK = 256

LINES = "variant int, id bigint, own int, label int, distance double"
MEANS = "variant int, id bigint, mates bigint, a double, b double"


def _narrowed(x: np.ndarray) -> np.ndarray:
    """``x`` as 32-bit floats if these hold every value exactly, as they do for vectors stored so."""
    with np.errstate(over="ignore"):
        narrow = x.astype(np.float32)
    return narrow if np.array_equal(narrow, x) else x


def _packed(labelled: DataFrame, clusters: list[tuple[int, int]], rows: int) -> DataFrame:
    """``(n, ids, x, at, block)``: the bytes of up to ``rows`` points, ``at`` with the number of each point's cluster or -1.

    ``x`` has 4 or 8 bytes a coordinate.
    """
    variants = 1 + max(v for v, _ in clusters)
    numbers = {c: i for i, c in enumerate(clusters)}

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), rows):
                part = frame.iloc[start : start + rows]
                x = _narrowed(np.stack(part["x"].to_numpy()).astype(float))
                labels = np.array(part["labels"].tolist(), dtype=float).reshape(len(part), -1)[:, :variants]
                at = np.full(labels.shape, -1, dtype=np.int16)
                for (v, c), i in numbers.items():
                    at[labels[:, v] == c, v] = i
                ids = part["id"].to_numpy().astype(np.int64)
                yield pd.DataFrame({"n": [len(part)], "ids": [ids.tobytes()], "x": [x.tobytes()], "at": [at.tobytes()]})

    # Points are packed where they lie; fewer tasks only keep many small partitions from making small blocks.
    tasks = max(1, labelled.sparkSession.sparkContext.defaultParallelism)
    made = labelled.select("id", "x", "labels").coalesce(tasks).mapInPandas(pack, "n int, ids binary, x binary, at binary")
    return checkpoint(made.withColumn("block", F.monotonically_increasing_id()))


def _pairs(slabs: int) -> list[tuple[int, int, bool]]:
    """``(held, passing, within)``: every two slabs meet once, ``within`` tells that the held one also meets itself.

    Every slab does that where it meets the next one in a ring, so none is sent for it alone.
    """
    if slabs < 3:
        return [(i, j, i == j) for i in range(slabs) for j in range(i, slabs)]
    ring = [(i, (i + 1) % slabs, True) for i in range(slabs)]
    return ring + [(i, j, False) for i in range(slabs) for j in range(i + 2, slabs) if j - i < slabs - 1]


def cluster_sums(
    labelled: DataFrame,
    clusters: list[tuple[int, int]],
    d: int,
    block_rows: int,
    distances: Callable[[np.ndarray, np.ndarray], np.ndarray],
    sizes: list[int] | None = None,
) -> DataFrame:
    """``(variant, id, own, label, distance)``: from every point of a labeling to each of its clusters.

    ``clusters`` has all (variant, label); ``labelled`` holds ``(id, x, labels)``. With the ``sizes`` of the clusters,
    ``(variant, id, mates, a, b)``: a line per point and labeling with its cluster's size, its mean distance to its
    own cluster and that to the nearest other one, which is whole only where no id comes twice.
    """
    spark = labelled.sparkSession
    n_clusters, variants = len(clusters), 1 + max(v for v, _ in clusters)
    packed = _packed(labelled, clusters, min(PACK_ROWS, block_rows))
    # Blocks are few, one per some thousand points.
    numbers = sorted((r["block"], r["n"]) for r in packed.select("block", "n").collect())
    total = sum(n for _, n in numbers)
    held = max(1, SLAB_BYTES // (8 * (d + 2 * n_clusters + 1)))
    slabs = min(len(numbers), max(-(-total // held), 2 * int(spark.sparkContext.defaultParallelism**0.5) + 1))
    # Blocks differ in size, so slabs are cut by points.
    before = [0, *itertools.accumulate(n for _, n in numbers)]
    of = spark.createDataFrame([(block, at * slabs // total) for at, (block, _) in zip(before, numbers)], "block bigint, slab int")
    # Every pair of slabs is a task of its own.
    pairs = _pairs(slabs)
    tasks = len(pairs)
    # A task's held slab is side 0, the one that passes by is side 1.
    sent_to = [
        (slab, key, within, side)
        for (held, passing, within), key in zip(pairs, even_keys(spark, tasks))
        for slab, side in ((held, 0), (passing, 1))
        if side == 0 or held != passing
    ]
    sent_to = F.broadcast(spark.createDataFrame(sent_to, "slab int, pair bigint, within boolean, side int"))
    met = packed.join(F.broadcast(of), "block").join(sent_to, "slab").select("pair", "within", "side", "block", "ids", "x", "at")
    met = met.repartition(tasks, "pair").sortWithinPartitions("pair", "side", "block")

    def block_of(batch: pa.RecordBatch, k: int) -> tuple:
        ids, at = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t) for c, t in (("ids", np.int64), ("at", np.int16)))
        x = batch.column("x")[k].as_buffer()
        x = np.frombuffer(x, dtype=np.float32 if x.size == 4 * len(ids) * d else float)
        member = np.zeros((len(ids), n_clusters))
        at = at.reshape(len(ids), variants)
        rows, columns = np.nonzero(at >= 0)
        member[rows, at[rows, columns]] = 1.0
        return batch.column("block")[k].as_py(), ids.copy(), x.reshape(len(ids), d).astype(float), member, np.zeros(member.shape)

    def meet(a: tuple, b: tuple) -> None:
        """Adds the distances between two blocks, or of one to itself, to the sums of both."""
        for start in range(0, len(a[1]), CHUNK):
            piece = slice(start, start + CHUNK)
            found = distances(a[2][piece], b[2])
            if a is b:
                found[a[1][piece][:, None] == b[1][None, :]] = 0.0
            else:
                b[4][:] += found.T @ a[3][piece]
            a[4][piece] += found @ b[3]

    def sent(blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        for block, *_, sums in blocks:
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sums.tobytes()], type=pa.binary())], names=["block", "sums"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, here = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                pair, within, side = (batch.column(c)[k].as_py() for c in ("pair", "within", "side"))
                if pair != now:
                    yield from sent(here)
                    now, here = pair, []
                one = block_of(batch, k)
                if within or side:
                    for other in here:
                        meet(other, one)
                if within and not side:
                    meet(one, one)
                if side:
                    yield from sent([one])
                else:
                    here.append(one)
        yield from sent(here)

    def lines_of(v: int, ids: np.ndarray, own: np.ndarray, columns: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
        label = np.array([c for _, c in clusters], dtype=np.int32)
        n, k = part.shape
        arrays = [
            np.full(n * k, v, dtype=np.int32), np.repeat(ids, k), np.repeat(label[own], k), np.tile(label[columns], n), part.reshape(-1),
        ]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[c.split()[0] for c in LINES.split(", ")])

    def means_of(v: int, ids: np.ndarray, own: np.ndarray, columns: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
        size = np.array(sizes, dtype=np.int64)
        mine = own[:, None] == columns[None, :]
        mates = size[own]
        a = part[mine] / np.maximum(mates - 1, 1)
        # Like the engine's minimum, this takes NaN only if there is nothing else.
        b = np.fmin.reduce(np.where(mine, np.nan, part / size[columns]), axis=1)
        alone = np.full(len(ids), len(columns) == 1)
        arrays = [
            pa.array(np.full(len(ids), v, dtype=np.int32)), pa.array(ids), pa.array(mates), pa.array(a, mask=mates == 1), pa.array(b, mask=alone),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in MEANS.split(", ")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, points = None, None, None

        def lines() -> Iterator[pa.RecordBatch]:
            if points is None:
                return
            ids, at = points
            for v in range(variants):
                columns = np.array([i for i, c in enumerate(clusters) if c[0] == v])
                inside = at[:, v] >= 0
                if not inside.any() or not len(columns):
                    continue
                shown = lines_of if sizes is None else means_of
                yield shown(v, ids[inside], at[inside, v], columns, sums[np.ix_(inside, columns)])

        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column("block")[k].as_py()
                if block != now:
                    yield from lines()
                    now, sums, points = block, 0.0, None
                part = batch.column("sums")[k]
                if part.is_valid:
                    sums = sums + np.frombuffer(part.as_buffer()).reshape(-1, n_clusters)
                else:
                    ids = np.frombuffer(batch.column("ids")[k].as_buffer(), dtype=np.int64).copy()
                    points = ids, np.frombuffer(batch.column("at")[k].as_buffer(), dtype=np.int16).reshape(len(ids), variants).copy()
        yield from lines()

    parts = met.mapInArrow(compare, "block bigint, sums binary")
    rows = parts.unionByName(packed.select("block", "ids", "at"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(add, LINES if sizes is None else MEANS)
