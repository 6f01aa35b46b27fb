"""Language-model scores by context-tree weighting over bytes.

A text is coded as its lower-cased words with single blanks and one end byte, bit by bit.
Every bit has a context tree over the bytes before it: a node counts zeros and ones behind its
context and estimates by Krichevsky and Trofimov; a node's weighted probability is half its
own and half the product of its children's. The counts of the training texts fix the
weights, and a text's probability mixes the estimates of all depths by them.

Every counted byte run takes part. Counts and weights stay in Spark tables: runs whose last
``HEAD + 1`` context bytes agree are weighted in one task, only the nodes of ``HEAD`` context bytes or
fewer come to the driver, whose number the alphabet bounds. Each different run of the texts gets its log
probability there; the scoring tasks hold the ``CACHED_RUNS`` most frequent ones, all others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import checkpoint, column, slices

DEPTH = 5
# Contexts up to so many bytes are weighted on the driver: 2**16 of them at most.
HEAD = 2
CACHED_RUNS = 1 << 20
MAX_WORDS = 1 << 18
END = b"\n"

# What a counting task holds before it hands counts on.
HELD_WORDS = 1 << 19
HELD_GRAMS = 1 << 21
# Byte runs a task weighs together, if no group of them is larger.
WEIGHED_RUNS = 1 << 18

FOLDS = 5
HELD_FOLD = 1

WORD, GRAM = 0, 1


def is_held_out(id: Column) -> Column:
    """Every fifth id by the checksum of its text; a null id is learned from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def word_key(word: bytes) -> int:
    """A signed 64-bit hash; two words of one corpus share it with negligible chance."""
    return xxhash.xxh64_intdigest(word) - (1 << 63)


# Byte runs


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def grams(streams: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte the run of it and the ``depth`` bytes before, and its stream's number.

    Before a stream there are zero bytes."""
    lead = bytes(depth)
    data = np.frombuffer(lead + lead.join(streams), dtype=np.uint8).astype(np.int64)
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    key = np.zeros(len(data) - depth, dtype=np.int64)
    for i in range(depth + 1):
        key = key << 8 | data[i : len(data) - depth + i]
    owner = np.repeat(np.arange(len(streams)), sizes)
    # The byte of a run lies ``depth`` places further for each stream that begins before it.
    place = np.arange(int(sizes.sum())) + owner * depth
    return key[place], owner


# Counting


def _count_texts(depth: int):
    """(kind, key, n, n_train) rows of words and byte runs, combined within a task.

    Inside, the lowest bit of a run tells whether a training text has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[bytes] = Counter()
        train: Counter[bytes] = Counter()
        runs: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def table(kind: int, key, n, n_train) -> pa.RecordBatch:
            kinds = pa.array(np.full(len(key), kind, dtype=np.int32))
            return pa.RecordBatch.from_arrays(
                [kinds, pa.array(key, type=pa.int64()), pa.array(n, type=pa.int64()), pa.array(n_train, type=pa.int64())],
                names=["kind", "key", "n", "n_train"],
            )

        def words_out() -> pa.RecordBatch:
            made = table(WORD, [word_key(w) for w in every], list(every.values()), [train[w] for w in every])
            every.clear()
            train.clear()
            return made

        def runs_out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return table(GRAM, keys >> 1, n, n * (keys & 1))

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in runs])).astype(np.int64)

        for batch in batches:
            bodies = batch.column(0).cast(pa.binary()).to_pylist()
            apart = batch.column(1).to_pylist()
            at = 0
            for part in slices(bodies):
                streams = []
                learned = ~np.array(apart[at : at + len(part)], dtype=bool)
                for body, is_learned in zip(part, learned, strict=True):
                    words = body.lower().split()
                    every.update(words)
                    every[END] += 1
                    if is_learned:
                        train.update(words)
                        train[END] += 1
                    streams.append(stream(words))
                at += len(part)
                if len(every) > HELD_WORDS:
                    yield words_out()
                keys, owner = grams(streams, depth)
                runs.append(np.unique(keys << 1 | learned[owner], return_counts=True))
                held += len(runs[-1][0])
                if held > HELD_GRAMS:
                    runs = [merged()]
                    held = len(runs[0][0])
                    if held > HELD_GRAMS // 2:
                        yield runs_out(*runs[0])
                        runs, held = [], 0
        if every:
            yield words_out()
        if runs:
            yield runs_out(*merged())

    return run


def count_corpus(docs: DataFrame, id: str, text: str, depth: int = DEPTH) -> DataFrame:
    """``(kind, key, n, n_train)``: words and byte runs with their counts in all and in training texts."""
    read = docs.select(column(text).alias("text"), is_held_out(column(id)).alias("held_out"))
    rows = read.mapInArrow(_count_texts(depth), "kind int, key long, n long, n_train long")
    return checkpoint(rows.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")))


def gathered(table: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns without nulls on the driver, without an object for each value."""
    found = table.select(*columns).toArrow()
    return [found.column(c).to_numpy() for c in columns]


def least_count(table: DataFrame, limit: int) -> int:
    """The smallest ``n`` such that rows of the table with it or more weigh ``limit`` at most."""
    tops = 1 << 16
    sizes = table.groupBy(F.least("n", F.lit(tops)).alias("n")).agg(F.sum("rows").alias("rows")).orderBy(F.desc("n")).collect()
    total, least = 0, tops + 1
    for r in sizes:
        total += r["rows"]
        if total > limit:
            return least
        least = r["n"]
    return 0


# The tree


def _log_gamma_steps(size: int) -> tuple[np.ndarray, np.ndarray]:
    """log of (1/2)(3/2)...(n-1/2) and of n! for n below ``size``."""
    n = np.arange(1, size)
    return np.concatenate([[0.0], np.cumsum(np.log(n - 0.5))]), np.concatenate([[0.0], np.cumsum(np.log(n))])


_STEPS = 1 << 14


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log probability that Krichevsky and Trofimov give a sequence with these counts."""
    half, whole = _log_gamma_steps(_STEPS)

    def log_gamma(x: np.ndarray) -> np.ndarray:
        return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)

    def rising_half(n: np.ndarray) -> np.ndarray:
        far = log_gamma(np.maximum(n, _STEPS) + 0.5) - 0.5 * math.log(math.pi)
        return np.where(n < _STEPS, half[np.minimum(n, _STEPS - 1)], far)

    total = zeros + ones
    factorial = np.where(total < _STEPS, whole[np.minimum(total, _STEPS - 1)], log_gamma(np.maximum(total, _STEPS) + 1.0))
    return rising_half(zeros) + rising_half(ones) - factorial


def _bit_nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes ``context << 8 | 1 and the bits so far`` with their zeros and ones, from byte runs."""
    context, byte = keys >> 8, keys & 255
    found, zeros, ones = [], [], []
    for j in range(8):
        node, at = np.unique(context << 8 | 1 << j | byte >> (8 - j), return_inverse=True)
        bit = byte >> (7 - j) & 1
        found.append(node)
        ones.append(np.bincount(at, counts * bit, len(node)))
        zeros.append(np.bincount(at, counts * (1 - bit), len(node)))
    nodes = np.concatenate(found)
    order = np.argsort(nodes)
    whole = lambda parts: np.concatenate(parts)[order].astype(np.int64)
    return nodes[order], whole(zeros), whole(ones)


def _shorter(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The nodes of contexts one byte shorter than ``depth``: the oldest byte goes."""
    return (nodes >> 8 & ((1 << 8 * (depth - 1)) - 1)) << 8 | nodes & 255


def shorter_levels(keys: np.ndarray, counts: np.ndarray, first: int, last: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth from ``first`` to ``last`` the byte runs, in order, and their counts."""
    levels = []
    for d in range(first, last + 1):
        short, at = np.unique(keys & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        levels.append((short, np.bincount(at, counts, len(short)).astype(np.int64)))
    return levels


def weigh(
    levels: list[tuple[np.ndarray, np.ndarray]], first: int, beyond: Sequence[np.ndarray] | None = None
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Nodes and chances of each level, the weighted logs of the first level's nodes, and for each
    level how much of a node's weight rests on its own estimate. ``levels`` begin at depth ``first``."""
    nodes, chance, own_log, below = [], [], [], []
    for keys, counts in levels:
        found, zeros, ones = _bit_nodes(keys, counts)
        nodes.append(found)
        chance.append((ones + 0.5) / (zeros + ones + 1.0))
        own_log.append(log_kt(zeros, ones))
    weighted = np.zeros(0)
    # From the deepest up.
    for i in range(len(levels) - 1, -1, -1):
        parent, logs = np.zeros(0, dtype=np.int64), np.zeros(0)
        if i + 1 < len(levels):
            parent, logs = np.searchsorted(nodes[i], _shorter(nodes[i + 1], first + i + 1)), weighted
        elif beyond is not None:
            parent, logs = np.searchsorted(nodes[i], beyond[0]), beyond[1]
        children = np.bincount(parent, logs, len(nodes[i]))
        has_child = np.bincount(parent, minlength=len(nodes[i])) > 0
        both = np.logaddexp(own_log[i], children) - math.log(2)
        weighted = np.where(has_child, both, own_log[i])
        below.append(np.where(has_child, np.exp(own_log[i] - math.log(2) - weighted), 1.0))
    return nodes, chance, weighted, below[::-1]


class ContextTree:
    """For each depth the nodes in order and the chance of a one when the node is the deepest
    known of a context."""

    def __init__(
        self,
        levels: list[tuple[np.ndarray, np.ndarray]],
        head: ContextTree | None = None,
        beyond: Sequence[np.ndarray] | None = None,
    ):
        """``levels``: for each depth the byte runs, in order, and their counts; each run's shorter
        one is on the level before. They begin at depth 0 or where ``head`` ends. ``beyond`` has
        the deepest nodes with children that are not given, and the sum of those children's weighted logs."""
        first = 0 if head is None else len(head.nodes)
        nodes, chance, weighted, below = weigh(levels, first, beyond)
        self.depth = first + len(levels) - 1
        # Down again: the mixture along the path when it ends at a node.
        self.nodes, self.ones = ([], []) if head is None else ([*head.nodes], [*head.ones])
        self.passed = None if head is None else head.passed
        for d, (found, one, own) in enumerate(zip(nodes, chance, below, strict=True), first):
            if self.passed is None:
                mixed, rest = np.zeros(len(found)), np.ones(len(found))
            else:
                parent = np.searchsorted(self.nodes[d - 1], _shorter(found, d))
                mixed, rest = (x[parent] for x in self.passed)
            self.nodes.append(found)
            self.ones.append(mixed + rest * one)
            self.passed = mixed + rest * own * one, rest * (1 - own)

    def _log_by_bits(self, keys: np.ndarray, top: int) -> np.ndarray:
        """log10 probability of the last byte of each run, bit by bit from the deepest known node
        of ``top`` bytes at most."""
        context, byte = keys >> 8, keys & 255
        total = np.zeros(len(keys))
        for j in range(8):
            node, bit = 1 << j | byte >> (8 - j), byte >> (7 - j) & 1
            one = np.full(len(keys), 0.5)
            open_ = np.arange(len(keys))
            for d in range(top, -1, -1):
                if not len(open_) or not len(self.nodes[d]):
                    continue
                wanted = (context[open_] & ((1 << 8 * d) - 1)) << 8 | node[open_]
                at = np.minimum(np.searchsorted(self.nodes[d], wanted), len(self.nodes[d]) - 1)
                known = self.nodes[d][at] == wanted
                one[open_[known]] = self.ones[d][at[known]]
                open_ = open_[~known]
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return total

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each run given the bytes before it."""
        different, back = np.unique(keys, return_inverse=True)
        return self._log_by_bits(different, self.depth)[back]


def _groups(batches: Iterator[pa.RecordBatch], mask: int) -> Iterator[list[np.ndarray]]:
    """The columns of rows sorted by the ``mask`` of the first one's context, cut between groups only."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size > WEIGHED_RUNS:
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            group = whole[0] >> 8 & mask
            end = int(np.searchsorted(group, group[-1]))
            if end:
                yield [c[:end] for c in whole]
            held, size = [[c[end:] for c in whole]], len(group) - end
    if size:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _weigh_deep(depth: int, first: int, mask: int):
    """(node, weighted): of the nodes of one byte less than ``first``, what their children add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _groups(batches, mask):
            nodes, _, weighted, _ = weigh(shorter_levels(keys, n, first, depth), first)
            above, at = np.unique(_shorter(nodes[0], first), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(above), pa.array(np.bincount(at, weighted))], names=["node", "weighted"])

    return run


def _run_logs(head, depth: int, first: int, mask: int):
    """(key, n, log): the log10 probability of each run's last byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, n_train in _groups(batches, mask):
            known = n_train > 0
            tree = ContextTree(shorter_levels(keys[known], n_train[known], first, depth), head.value)
            logs = tree._log_by_bits(keys, depth)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), pa.array(logs)], names=["key", "n", "log"])

    return run


def run_logs(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(key, n, log)``: every counted byte run, how often it occurs and the log10 probability
    of its last byte behind the others, by the tree of all training counts."""
    full = counts.where(F.col("kind") == GRAM)
    learned = full.where(F.col("n_train") > 0)
    top = min(HEAD, depth)
    first, mask = top + 1, (1 << 8 * min(top + 1, depth)) - 1
    short = F.col("key").bitwiseAND(F.lit((1 << 8 * first) - 1))
    rows = learned.groupBy(short.alias("key")).agg(F.sum("n_train").alias("n"))
    levels = shorter_levels(*gathered(rows, "key", "n"), 0, top)

    # A group's rows are bounded by the bytes around its context: 2**24 for depth 5, far fewer in text.
    group = F.shiftright("key", 8).bitwiseAND(F.lit(mask))

    def dealt(table: DataFrame, *columns: str) -> DataFrame:
        return table.select(*columns, group.alias("g")).repartition("g").sortWithinPartitions("g").select(*columns)

    beyond = None
    if depth > top:
        deep = dealt(learned, "key", "n_train").mapInArrow(_weigh_deep(depth, first, mask), "node long, weighted double")
        beyond = gathered(deep.groupBy("node").agg(F.sum("weighted").alias("weighted")), "node", "weighted")
    head = counts.sparkSession.sparkContext.broadcast(ContextTree(levels, beyond=beyond))
    logs = dealt(full, "key", "n", "n_train").mapInArrow(_run_logs(head, depth, first, mask), "key long, n long, log double")
    return checkpoint(logs)


class RunTable:
    """Looks up the logs of byte runs: most by one slot each, the others by search."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        """``keys`` from rare to frequent: of those with one slot the last has it."""
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], logs[order]
        self.shift = np.uint64(64 - max(4, (2 * len(keys)).bit_length()))
        slots = self._slots(keys)
        self.slot_keys = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int64)
        self.slot_logs = np.zeros(len(self.slot_keys))
        self.slot_keys[slots] = keys
        own = self.slot_keys[slots] == keys
        self.slot_logs[slots[own]] = logs[own]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logs, 0 for unknown runs, and where those are."""
        slots = self._slots(keys)
        logs = self.slot_logs[slots]
        rest = np.flatnonzero(self.slot_keys[slots] != keys)
        logs[rest] = 0.0
        if len(self.keys):
            wanted = keys[rest]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            logs[rest[hit]] = self.logs[at[hit]]
            rest = rest[~hit]
        return logs, rest


# Scores


def _score_texts(frequent, words, train_tokens: int, train_words: int, depth: int):
    schema_names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare", "rare_runs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RunTable(*frequent.value)
        keys, known_counts = words.value
        under = math.log10(train_tokens + 0.5 * (train_words + 1))
        logs = np.log10(known_counts + 0.5) - under
        for batch in batches:
            bodies = batch.column(0).cast(pa.binary()).to_pylist()
            at = 0
            for part in slices(bodies):
                found = [body.lower().split() for body in part]
                owner = np.repeat(np.arange(len(part)), [len(w) + 1 for w in found])
                hashes = np.array([h for w in found for h in (*map(word_key, w), word_key(END))], dtype=np.int64)
                if len(keys):
                    place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                    hit = keys[place] == hashes
                    value, is_known = np.where(hit, logs[place], 0.0), hit & (known_counts[place] > 0)
                else:
                    hit = is_known = np.zeros(len(hashes), dtype=bool)
                    value = np.zeros(len(hashes))
                streams = [stream(w) for w in found]
                runs, source = grams(streams, depth)
                run_log, missing = table.find(runs)
                score = np.bincount(source, run_log, len(part))
                run_cuts = np.searchsorted(source[missing], np.arange(len(part) + 1)).astype(np.int32)
                cuts = np.searchsorted(owner[~hit], np.arange(len(part) + 1)).astype(np.int32)
                made = [
                    batch.column(1).slice(at, len(part)),
                    batch.column(2).slice(at, len(part)),
                    pa.array(np.bincount(owner, minlength=len(part)).astype(np.int64)),
                    pa.array(np.bincount(owner, is_known, len(part)).astype(np.int64)),
                    pa.array(np.bincount(owner, value, len(part))),
                    pa.array(score),
                    pa.array(np.array([len(s) for s in streams], dtype=np.int64)),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes[~hit])),
                    pa.ListArray.from_arrays(pa.array(run_cuts), pa.array(runs[missing])),
                ]
                at += len(part)
                yield pa.RecordBatch.from_arrays(made, names=schema_names)

    return run


def score(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    cached_runs: int = CACHED_RUNS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``.

    Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z and one end are the tokens of a text.
    ``base_score`` adds up log10 of smoothed token shares in the training texts, ``score`` is
    the tree's log10 probability of the token stream, ``bits_per_byte`` its code length. Null
    and empty texts have the end only. Repeated rows are scored alike, a null id is learned
    from. Without training texts every bit has the chance one half. The ``max_words`` most
    frequent words and ``cached_runs`` byte runs are looked up in the tasks, all others by a join.
    """
    spark = docs.sparkSession
    counts = count_corpus(docs, id, text, depth)
    logs = run_logs(counts, depth)
    words = counts.where(F.col("kind") == WORD).select("key", "n", "n_train")
    totals = words.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    train_tokens, train_words = int(totals[0]), int(totals[1])
    least = least_count(words.withColumn("rows", F.lit(1)), max_words)
    keys, n_train = gathered(words.where(F.col("n") >= least), "key", "n_train")
    order = np.argsort(keys)
    lookup = spark.sparkContext.broadcast((keys[order], n_train[order].astype(np.float64)))
    least_run = least_count(logs.withColumn("rows", F.lit(1)), cached_runs)
    keys, n, log = gathered(logs.where(F.col("n") >= least_run), "key", "n", "log")
    order = np.argsort(n, kind="stable")
    frequent = spark.sparkContext.broadcast((keys[order], log[order]))
    del keys, n_train, n, log, order

    kind = docs.schema[id].dataType.simpleString()
    schema = (
        f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
        "rare array<long>, rare_runs array<long>"
    )
    read = docs.select(column(text).alias("text"), column(id).alias("id"), is_held_out(column(id)).alias("held_out"))
    scored = read.mapInArrow(_score_texts(frequent, lookup, train_tokens, train_words, depth), schema)
    scored = checkpoint(scored.withColumn("row", F.monotonically_increasing_id()))

    under = train_tokens + 0.5 * (train_words + 1)
    rare = scored.select("row", F.explode("rare").alias("key")).join(words.where(F.col("n") < least), "key")
    more = rare.groupBy("row").agg(
        F.sum(F.log10((F.col("n_train") + 0.5) / F.lit(under))).alias("more_score"),
        F.count(F.when(F.col("n_train") > 0, 1)).alias("more_known"),
    )
    rare_runs = scored.select("row", F.explode("rare_runs").alias("key")).join(logs.where(F.col("n") < least_run), "key")
    more_runs = rare_runs.groupBy("row").agg(F.sum("log").alias("more_log"))
    whole = scored.drop("rare", "rare_runs").join(more, "row", "left").join(more_runs, "row", "left")
    log = F.col("score") + F.coalesce("more_log", F.lit(0.0))
    return whole.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_score", F.lit(0.0))).alias("base_score"),
        log.alias("score"),
        (-log * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
