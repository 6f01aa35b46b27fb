"""Session helpers: shared scratch folder, checkpointing, size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may hold to be sent to every executor.
BROADCAST_ROWS = 200_000
# Rows above which a table is dealt to all cores, and rows that a task gets at most then.
SPREAD_ROWS = 50_000
TASK_ROWS = 1_000_000


_local_roots: dict[str, str] = {}


def _shared_root(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; a local session may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="tablegauge-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written between two steps.

    All paths of an application share one folder, which can be dropped when it has ended.
    """
    root = _shared_root(spark).rstrip("/")
    return f"{root}/tablegauge-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and go on from there.

    Unlike a cut lineage alone, the table brings its true size to the planner.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_counting(df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
    """``checkpoint`` that also tells how many of the written rows meet ``condition``."""
    written = checkpoint(df)
    return written, written.where(condition).count()


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count shows it to be small, else left to the engine."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the cores, unless it is small: a table of one file is read by one task."""
    rows = df.count()
    if rows <= SPREAD_ROWS:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` whole numbers that ``repartition(n, key)`` deals to ``n`` different partitions."""
    found: dict[int, int] = {}
    start, step = 0, 16 * n
    while len(found) < n:
        tried = spark.range(start, start + step, 1, 1).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part"))
        for part, key in tried.groupBy("part").agg(F.min("id")).collect():
            found.setdefault(part, key)
        start += step
    return [found[part] for part in range(n)]
