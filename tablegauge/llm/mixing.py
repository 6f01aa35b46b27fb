"""Mix sources to target weights: whole copies, exact length counts, seeded choice."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import checkpoint, column, free_name, hashable

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MAX_COPIES = 2
SEED = 7

# Words left to the exact fit after the proportional part.
FIT_WORDS = 4096

# Slices of the choice within one source and length.
CHOICE_BITS = 12


def fill_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, fit_words: int = FIT_WORDS) -> np.ndarray:
    """How many documents of each size to take so that their sizes add up to ``budget``.

    Every size first gives its proportional share, rounded down. Large sizes fill up what that
    leaves until about ``fit_words`` remain, and a bounded knapsack over the sizes still available fills
    the rest: exactly if any choice does, else with the nearest sum below.
    """
    order = np.argsort(sizes)
    size = [int(v) for v in sizes[order]]
    have = [int(v) for v in counts[order]]
    total = sum(s * n for s, n in zip(size, have, strict=True))
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), dtype=np.int64)
    take = [n * min(budget, total) // total if s else 0 for s, n in zip(size, have, strict=True)]
    left = min(budget, total) - sum(s * n for s, n in zip(size, take, strict=True))
    for i in range(len(size) - 1, -1, -1):
        if size[i] and left > fit_words:
            more = min(have[i] - take[i], (left - fit_words) // size[i])
            take[i] += more
            left -= more * size[i]
    # first[v]: the piece that first reaches the sum v; pieces are 1, 2, 4, ... documents of a size.
    first = np.full(left + 1, -1, dtype=np.int64)
    reached = np.zeros(left + 1, dtype=bool)
    reached[0] = True
    pieces: list[tuple[int, int]] = []
    for i, s in enumerate(size):
        spare = min(have[i] - take[i], left // s) if s else 0
        part = 1
        while spare > 0 and not reached[left]:
            n = min(part, spare)
            spare -= n
            part *= 2
            weight = n * s
            new = reached[: left + 1 - weight] & ~reached[weight:]
            first[weight:][new] = len(pieces)
            pieces.append((i, n))
            reached[weight:] |= new
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = pieces[first[at]]
        take[i] += n
        at -= n * size[i]
    out = np.zeros(len(sizes), dtype=np.int64)
    out[order] = take
    return out


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = BUDGET_SHARE, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``(source, source_size, target)`` from the size of every source.

    Sources in code point order, null last, weigh ``weights`` in turn. ``share`` times all
    sizes is dealt by weight; what exceeds ``max_copies`` times a source is dealt anew among the
    others until none exceeds it. Only the table of sources is ordered as a whole.
    """
    # UTF-8 bytes sort like code points.
    rank = F.row_number().over(Window.orderBy(F.isnull("source"), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_copies).cast("double")
    table = sources.select("source", "source_size", weight.alias("weight"), cap.alias("cap"))
    # A source is full up to the level cap / weight. The first sources by that level are full,
    # and the rest share what they leave.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.isnull("source"), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    levels = table.select(
        "*",
        (F.sum("source_size").over(everywhere) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("rest"),
        (F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    )
    level = F.col("rest") / F.col("open")
    fits = F.when(level * F.col("weight") <= F.col("cap"), level)
    # The first source in that order that is not full fixes the level for itself and all after it.
    first = F.min(F.when(fits.isNotNull(), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.isnull("source"), "source", fits.alias("level"))))
    leveled = levels.withColumn("low", first.over(everywhere))
    open_share = F.coalesce(F.col("low.level") * F.col("weight"), F.col("cap"))
    return leveled.select("source", "source_size", F.least("cap", open_share).alias("target"))


def _source_key(source: Column) -> Column:
    """The source as text, with a first letter that tells a null from any value."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source.cast("string")))


def _plan(max_copies: int):
    """Per source: copies every document gets, and how many of each size get one more."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        total = int(rows["source_size"].iloc[0])
        target = float(rows["target"].iloc[0])
        whole = min(int(target // total), max_copies) if total else 0
        budget = int(round(target - whole * total))
        more = fill_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), budget if whole < max_copies else 0)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "whole": whole, "more": more})

    return run


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: list[str] | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = BUDGET_SHARE,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``(*carry, size, source_size, target, copies)``, one row per document.

    ``size`` counts the words ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none and is
    taken zero times or more at no size. ``copies`` says how often the mix takes the document, up to
    ``max_copies`` times, so that the sizes of each source add up to its target rounded to whole words
    where any choice does. Documents of one source and length are chosen by a seeded hash
    of their id and text: reruns agree, and equal rows are told apart only by number.
    A null source is a source of its own. Each length is cut into slices of the hash, so a
    length with most rows is ranked in many tasks. ``carry`` names the columns to keep.
    """
    carry = docs.columns if carry is None else carry
    made = {}
    for name in ("size", "source_size", "target", "copies"):
        made[name] = free_name(name, carry)
    own = [column(c).alias(f"c{i}") for i, c in enumerate(carry)]
    body = F.coalesce(column(text), F.lit(""))
    # The pieces between blanks, less the empty ones at either end.
    blank = r"[\x20\x09-\x0D]+"
    size = F.size(F.array_remove(F.split(body, blank), "")).cast("long")
    # All other columns settle ties, so only fully equal rows are interchangeable.
    mark = F.xxhash64(F.lit(seed), *[p for c in hashable(docs) for p in (F.isnull(c), c)])
    sized = docs.select(*own, column(source).alias("source"), size.alias("size"), mark.alias("mark"))
    sized = sized.withColumn("slice", F.shiftrightunsigned("mark", 64 - CHOICE_BITS).cast("int"))

    slices = checkpoint(sized.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")))
    lengths = slices.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = checkpoint(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    targets = checkpoint(source_targets(totals, weights, share, max_copies))
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    known = lengths.join(targets, same_source(lengths, targets)).select(lengths["source"], "size", "n", "source_size", "target")
    # One row per length: a group holds as many rows as documents have different lengths.
    # A key of the source stands for it there, as a source may be of any type.
    numbered = known.withColumn("source", _source_key(known["source"]))
    plan = numbered.groupBy("source").applyInPandas(_plan(max_copies), "source string, size long, whole long, more long")
    plan = checkpoint(plan)

    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    p, c = plan.alias("p"), cut.alias("c")
    quota = c.join(p, (_source_key(F.col("c.source")) == F.col("p.source")) & (F.col("c.size") == F.col("p.size"))).select(
        "c.source", "c.size", "c.slice", "p.whole", F.least(F.greatest(F.col("p.more") - F.col("c.before"), F.lit(0)), F.col("c.n")).alias("quota")
    )
    quota = quota.join(targets, quota["source"].eqNullSafe(targets["source"])).select(
        quota["source"], "size", "slice", "whole", "quota", "source_size", "target"
    )
    q = quota.alias("q")
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("mark"))
    ranked = sized.withColumn("rank", rank).alias("s")
    joined = ranked.join(
        q,
        F.col("s.source").eqNullSafe(F.col("q.source")) & (F.col("s.size") == F.col("q.size")) & (F.col("s.slice") == F.col("q.slice")),
    )
    copies: Column = F.col("whole") + F.when(F.col("rank") <= F.col("quota"), 1).otherwise(0)
    return joined.select(
        *[F.col(f"s.c{i}").alias(c) for i, c in enumerate(carry)],
        F.col("s.size").alias(made["size"]),
        F.col("source_size").alias(made["source_size"]),
        F.col("target").alias(made["target"]),
        copies.cast("int").alias(made["copies"]),
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns as they are."""
    rows = mix(docs, **settings)
    copies = column(rows.columns[-1])
    again = F.explode(F.array_repeat(F.lit(0), copies)).alias(free_name("again", rows.columns))
    return rows.select("*", again).select(*[column(c) for c in docs.columns])
