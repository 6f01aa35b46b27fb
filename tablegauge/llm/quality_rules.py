"""Quality rules: text statistics and a decision list learned from labelled ones.

Sequential covering grows a conjunction of thresholds on one part of the labelled rows,
prunes it on the other, sets aside what it covers and goes on while rules stay precise.
The list is handed out as conditional expressions over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.llm.common import CONTINUATION, SPACE, column, free_name, map_texts

SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
CAPITALS = bytes(range(0x41, 0x5B))
MARKS = b"!?"
WINDOW = 8

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Labelled rows the list is learned from.
SAMPLE_ROWS = 20_000

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_adjacent",
    "n_top", "n_capitals", "n_digits", "n_marks",
)

# Statistics the rules may use: counts per word, line or character.
FEATURES = {
    "n_words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_line_share": ("n_dup_lines", "n_lines"),
    "repeated_window_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct", "n_words"),
    "adjacent_repeat_share": ("n_adjacent", "n_words"),
    "top_word_share": ("n_top", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def _repeated_window_words(ids: np.ndarray) -> int:
    """Words inside runs of ``WINDOW`` words that occur twice or more, the first one included."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    # Equal runs of 2, 4 and 8 words get equal numbers, so the comparison is exact.
    rank = ids
    for step in (1, 2, 4):
        pair = rank[:-step].astype(np.int64) * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def _count(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def measure_text(text: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text in UTF-8; null counts as empty."""
    text = text or b""
    words = text.split()
    n = len(words)
    n_dup, n_lines = 0, 0
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    n_distinct = len(numbers)
    return (
        n,
        len(text.translate(None, CONTINUATION + SPACE)),
        _count(text, SYMBOLS),
        n_dup,
        _repeated_window_words(ids) if n_distinct < n else 0,
        n_lines,
        n_distinct,
        int((ids[1:] == ids[:-1]).sum()),
        int(np.bincount(ids).max()) if n else 0,
        _count(text, CAPITALS),
        _count(text, DIGITS),
        _count(text, MARKS),
    )


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The ``keep`` columns of every document with the counts of ``COUNTS`` as longs."""

    def measure(texts: list[bytes | None]) -> dict[str, pa.Array]:
        rows = np.array([measure_text(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        return {prefix + name: pa.array(rows[:, i]) for i, name in enumerate(COUNTS)}

    return map_texts(docs, text, measure, [T.StructField(prefix + n, T.LongType()) for n in COUNTS], keep)


def feature(name: str, prefix: str = "") -> Column:
    """A statistic of ``FEATURES`` from the counts; a share of nothing is zero."""
    over, under = FEATURES[name]
    value = column(prefix + over).cast("double")
    if under is None:
        return value
    return F.when(column(prefix + under) > 0, value / column(prefix + under)).otherwise(F.lit(0.0))


def base_failed(prefix: str = "") -> Column:
    """Too few words, or too many of them in repeated windows."""
    words, repeated = column(prefix + "n_words"), column(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


@dataclass(frozen=True)
class Rule:
    """A conjunction of thresholds that rejects; each is (statistic, at most?, value)."""

    conditions: tuple[tuple[str, bool, float], ...]
    caught: int
    wrong: int

    def condition(self, prefix: str = "") -> Column:
        met = F.lit(True)
        for name, at_most, value in self.conditions:
            met = met & (feature(name, prefix) <= value if at_most else feature(name, prefix) > value)
        return met

    def __str__(self) -> str:
        told = " and ".join(f"{n} {'<=' if low else '>'} {v:.6g}" for n, low, v in self.conditions)
        return f"reject if {told} ({self.caught} right, {self.wrong} wrong)"


def _meets(x: np.ndarray, names: list[str], conditions) -> np.ndarray:
    met = np.ones(len(x), dtype=bool)
    for name, at_most, value in conditions:
        values = x[:, names.index(name)]
        met &= values <= value if at_most else values > value
    return met


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], n_thresholds: int, max_conditions: int) -> list:
    """Add the threshold that gains most information on rejected rows, while one does."""
    conditions: list = []
    inside = np.ones(len(x), dtype=bool)
    while len(conditions) < max_conditions:
        p, n = int(y[inside].sum()), int((~y[inside]).sum())
        if not p or not n:
            break
        best = (1e-9, None)
        for j, name in enumerate(names):
            values = x[inside, j]
            order = np.argsort(values, kind="stable")
            values, labels = values[order], y[inside][order]
            cuts = np.unique(values[np.linspace(0, len(values) - 1, n_thresholds + 1).astype(int)])[:-1]
            if not len(cuts):
                continue
            # Thresholds lie midway to the next value that occurs.
            above = np.searchsorted(values, cuts, side="right")
            points = (cuts + values[above]) / 2
            hits = np.concatenate([[0], np.cumsum(labels)])[above]
            for at_most, pos, total in ((True, hits, above), (False, p - hits, len(values) - above)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / total) - np.log2(p / (p + n))), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, at_most, float(points[k])))
        if best[1] is None:
            break
        conditions.append(best[1])
        inside &= _meets(x, names, [best[1]])
    return conditions


def learn_rules(
    x: np.ndarray,
    rejected: np.ndarray,
    names: list[str],
    min_precision: float = 0.95,
    min_caught: int = 3,
    n_thresholds: int = 64,
    max_conditions: int = 4,
    max_rules: int = 32,
) -> list[Rule]:
    """An ordered list of rules from statistics and labels; rows should come in a mixed order.

    Every third row prunes, the others grow. A rule counts if on the pruning rows it rejects
    ``min_caught`` bad rows and is right in ``min_precision`` of cases. Without both kinds of rows there is no rule.
    """
    rejected = rejected.astype(bool)
    prune = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), dtype=bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow_rows, prune_rows = left & ~prune, left & prune
        conditions = _grow(x[grow_rows], rejected[grow_rows], names, n_thresholds, max_conditions)
        best = None
        for size in range(1, len(conditions) + 1):
            met = _meets(x[prune_rows], names, conditions[:size])
            p, n = int(rejected[prune_rows][met].sum()), int((~rejected[prune_rows])[met].sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if best is None or worth > best[0]:
                best = (worth, size, p, n)
        if best is None or best[2] < min_caught or best[2] < min_precision * (best[2] + best[3]):
            return rules
        _, size, p, n = best
        rule = Rule(tuple(conditions[:size]), p, n)
        left &= ~_meets(x, names, rule.conditions)
        rules.append(rule)
    return rules


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """Learn rules that reject documents labelled 0.

    At most ``max_rows`` labelled ids are used, the first in the order of a hash of the id;
    the statistics come from their whole texts. Rows without id or label are not used, of
    several labels the smallest counts. Documents the base rules reject are not learned from.
    """
    known = labels.where(column(id).isNotNull() & column(label).isNotNull()).select(
        column(id).alias("id"), column(label).alias("label")
    )
    one = known.groupBy("id").agg(F.min("label").alias("label"))
    sample = one.orderBy(F.xxhash64(F.lit("labels"), "id"), "id").limit(max_rows)
    named = docs.select(column(id).alias("id"), column(text).alias("text"))
    # The sample holds max_rows rows at most.
    chosen = named.join(F.broadcast(sample), "id")
    stats = text_statistics(chosen, ["id", "label"]).where(~base_failed())
    names = list(FEATURES)
    rows = (
        stats.select("id", "label", *[feature(n).alias(n) for n in names])
        .orderBy(F.xxhash64(F.lit("rows"), "id"), "id", *names)
        .limit(max_rows)
        .toPandas()
    )
    if rows.empty:
        return []
    return learn_rules(rows[names].to_numpy(dtype=float), (rows["label"] == 0).to_numpy(), names)


def rejected_by(rules: list[Rule], prefix: str = "") -> Column:
    """The list as one conditional expression: the first rule that applies rejects."""
    if not rules:
        return F.lit(False)
    chain = F.when(rules[0].condition(prefix), F.lit(True))
    for rule in rules[1:]:
        chain = chain.when(rule.condition(prefix), F.lit(True))
    return chain.otherwise(F.lit(False))


def judge(docs: DataFrame, rules: list[Rule], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document, one row each.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged
    alike, a null id is kept as it is, an empty table gives none.
    """
    named = docs.select(column(id).alias("id"), column(text).alias("text"))
    stats = text_statistics(named, ["id"]).withColumn("base_failed", base_failed())
    return stats.withColumn("kept", ~F.col("base_failed") & ~rejected_by(rules)).withColumnRenamed("id", id)


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents neither the base rules nor the list reject, with their columns as they are."""
    prefix = free_name("stat_", [c[:5] for c in docs.columns])
    stats = text_statistics(docs, docs.columns, text, prefix)
    return stats.where(~base_failed(prefix) & ~rejected_by(rules, prefix)).select(*[column(c) for c in docs.columns])
