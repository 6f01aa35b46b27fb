"""Secret scans by one deterministic automaton for all rules.

The rules are compiled together: position sets of their expressions give a nondeterministic
automaton, subset construction makes it deterministic, minimisation merges what can't be
told apart. The result is a table of transitions over classes of bytes. One pass over the
bytes of a text tells where any rule can end; only where one does, its spans are settled by
a pass backwards (where can a match start?) and forwards (how far does it reach?).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablegauge.llm.common import column, map_texts

# Expressions over bytes: a set of bytes, ("cat", ...), ("alt", ...), ("many", x) for one or more, ("opt", x).
DIGIT = frozenset(b"0123456789")
UPPER = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = frozenset(b"abcdefghijklmnopqrstuvwxyz")


def one_of(text: bytes) -> frozenset[int]:
    return frozenset(text)


def exactly(text: bytes) -> tuple:
    return ("cat", *(frozenset([b]) for b in text))


def either_case(text: bytes) -> tuple:
    return ("cat", *(frozenset(bytes([b]).lower() + bytes([b]).upper()) for b in text))


def at_least(n: int, what) -> tuple:
    return ("cat", *([what] * (n - 1)), ("many", what))


def some(what) -> tuple:
    """Any number, none included."""
    return ("opt", ("many", what))


@dataclass(frozen=True)
class Rule:
    """An expression whose matches count if what follows its ``head`` has ``min_rest`` bytes.

    Shorter matches are found, take their place and are dropped. Without a head the whole
    match is measured.
    """

    kind: str
    head: tuple
    rest: tuple
    min_rest: int = 1

    @property
    def pattern(self) -> tuple:
        return ("cat", self.head, self.rest)


# The three base rules.
_VALUE = DIGIT | UPPER | LOWER | one_of(b"+/_.=-")
_NAMES = (
    "alt",
    either_case(b"password"),
    either_case(b"passwd"),
    either_case(b"secret"),
    either_case(b"token"),
    ("cat", either_case(b"api"), ("opt", one_of(b"_")), either_case(b"key")),
)
_QUOTE = ("opt", one_of(b"\"'"))
_BLANKS = some(one_of(b" "))
_NOTHING = ("cat",)
BASE_RULES = (
    Rule("assign", ("cat", _NAMES, _QUOTE, _BLANKS, one_of(b":="), _BLANKS, _QUOTE), ("many", _VALUE), 12),
    Rule("access", exactly(b"AKIA"), ("many", UPPER | DIGIT), 14),
    # Shorter runs hold no longer one, so the length can be part of the expression.
    Rule("hex", _NOTHING, at_least(16, DIGIT | one_of(b"abcdef")), 16),
)
MORE_RULES = (
    Rule("private_key", exactly(b"-----BEGIN "), ("cat", some(UPPER | one_of(b" ")), exactly(b"PRIVATE KEY-----"))),
    Rule("github", ("cat", exactly(b"gh"), one_of(b"pousr"), exactly(b"_")), ("many", DIGIT | UPPER | LOWER), 20),
    Rule("slack", ("cat", exactly(b"xox"), one_of(b"abprs"), exactly(b"-")), ("many", DIGIT | UPPER | LOWER | one_of(b"-")), 10),
)
RULES = BASE_RULES + MORE_RULES


# Construction


class _Positions:
    """Which byte sets an expression has, which come first, last and after each other."""

    def __init__(self, pattern: tuple):
        self.sets: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.empty, self.first, self.last = self._walk(pattern)

    def _walk(self, node) -> tuple[bool, set[int], set[int]]:
        if isinstance(node, frozenset):
            self.sets.append(node)
            self.follow.append(set())
            at = {len(self.sets) - 1}
            return False, at, set(at)
        name, *parts = node
        if name == "alt":
            made = [self._walk(p) for p in parts]
            return any(m[0] for m in made), set().union(*(m[1] for m in made)), set().union(*(m[2] for m in made))
        if name == "opt":
            _, first, last = self._walk(parts[0])
            return True, first, last
        if name == "many":
            empty, first, last = self._walk(parts[0])
            for p in last:
                self.follow[p] |= first
            return empty, first, last
        empty, first, last = True, set(), set()
        for part in parts:
            e, f, z = self._walk(part)
            for p in last:
                self.follow[p] |= f
            first = first | f if empty else first
            last = last | z if e else z
            empty = empty and e
        return empty, first, last


@dataclass(frozen=True)
class Automaton:
    """``moves[state][class]`` is the next state; ``accepts[state]`` has a bit for each rule."""

    classes: bytes
    moves: list[list[int]]
    accepts: list[int]
    start: int = 0


def _byte_classes(sets: Iterable[frozenset[int]]) -> tuple[bytes, list[int]]:
    """Bytes no set tells apart share a class; one byte stands for each."""
    told = list(dict.fromkeys(sets))
    classes: dict[tuple, int] = {}
    table = bytes(classes.setdefault(tuple(b in s for s in told), len(classes)) for b in range(256))
    return table, [table.index(c) for c in range(len(classes))]


def determinize(nfas: list[tuple[list[frozenset[int]], list[set[int]], set[int], set[int]]], anywhere: bool) -> Automaton:
    """Subset construction over all rules at once: (sets, follow, first, last) of each.

    With ``anywhere`` a match may begin at every byte, else only at the first one.
    """
    sets, follow, first, ends = [], [], set(), {}
    for rule, (own_sets, own_follow, own_first, own_last) in enumerate(nfas):
        base = len(sets)
        sets += own_sets
        follow += [{base + q for q in f} for f in own_follow]
        first |= {base + p for p in own_first}
        ends |= {base + p: 1 << rule for p in own_last}
    classes, heads = _byte_classes(sets)
    allows = [{p for p, s in enumerate(sets) if b in s} for b in heads]
    # A state is the set of positions just read; the start has read none.
    numbers = {(frozenset(), True): 0}
    moves: list[list[int]] = []
    accepts: list[int] = []
    queue = deque(numbers)
    while queue:
        read, fresh = queue.popleft()
        mask = 0
        following = set(first) if anywhere or fresh else set()
        for p in read:
            mask |= ends.get(p, 0)
            following |= follow[p]
        accepts.append(mask)
        row = []
        for allowed in allows:
            to = (frozenset(following & allowed), False)
            if anywhere and not to[0]:
                to = (to[0], True)
            if to not in numbers:
                numbers[to] = len(numbers)
                queue.append(to)
            row.append(numbers[to])
        moves.append(row)
    return minimize(Automaton(classes, moves, accepts))


def minimize(dfa: Automaton) -> Automaton:
    """Merge states no continuation tells apart, by refining classes until they are stable."""
    groups = {m: i for i, m in enumerate(dict.fromkeys(dfa.accepts))}
    group = [groups[m] for m in dfa.accepts]
    n = len(groups)
    while True:
        seen: dict[tuple, int] = {}
        finer = [seen.setdefault((group[s], *(group[t] for t in row)), len(seen)) for s, row in enumerate(dfa.moves)]
        if len(seen) == n:
            break
        group, n = finer, len(seen)
    heads: dict[int, int] = {}
    for state, g in enumerate(group):
        heads.setdefault(g, state)
    order = sorted(heads, key=lambda g: g != group[dfa.start])
    number = {g: i for i, g in enumerate(order)}
    moves = [[number[group[t]] for t in dfa.moves[heads[g]]] for g in order]
    return Automaton(dfa.classes, moves, [dfa.accepts[heads[g]] for g in order])


def _reversed(positions: _Positions) -> tuple[list[frozenset[int]], list[set[int]], set[int], set[int]]:
    back: list[set[int]] = [set() for _ in positions.sets]
    for p, following in enumerate(positions.follow):
        for q in following:
            back[q].add(p)
    return positions.sets, back, positions.last, positions.first


@dataclass(frozen=True)
class Tables:
    """The automata of a list of rules; plain data that can be sent to tasks."""

    rules: tuple[Rule, ...]
    all: Automaton
    forward: list[Automaton]
    heads: list[Automaton]
    backward: list[Automaton]


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Tables:
    parts = [_Positions(r.pattern) for r in rules]
    if any(p.empty for p in parts):
        raise ValueError("a rule must not match the empty text")
    ahead = [(p.sets, p.follow, p.first, p.last) for p in parts]
    heads = [_Positions(r.head) for r in rules]
    return Tables(
        rules,
        determinize(ahead, anywhere=True),
        [determinize([a], anywhere=False) for a in ahead],
        [determinize([(p.sets, p.follow, p.first, p.last)], anywhere=False) for p in heads],
        [determinize([_reversed(p)], anywhere=True) for p in parts],
    )


class Scanner:
    """All rules in one table, with backward and forward tables for each rule's spans."""

    def __init__(self, tables: Tables):
        self.rules = tables.rules
        self.rows = self._rows(tables.all)
        self.forward = [self._rows(a) for a in tables.forward]
        self.heads = [self._rows(a) for a in tables.heads]
        self.backward = [self._rows(a) for a in tables.backward]

    @staticmethod
    def _rows(automaton: Automaton) -> list:
        """Each state as a list of the rows its bytes lead to, its accept mask at 256."""
        rows: list[list] = [[] for _ in automaton.moves]
        for row, moves, mask in zip(rows, automaton.moves, automaton.accepts, strict=True):
            row += [rows[moves[c]] for c in automaton.classes]
            row.append(mask)
        return rows[automaton.start]

    @staticmethod
    def _reach(row: list, text: bytes, start: int, end: int) -> int:
        """Where the longest match from ``start`` ends; ``start`` if there is none."""
        reached = start
        for i in range(start, end):
            row = row[text[i]]
            if row[256]:
                reached = i + 1
            elif row is row[0] and all(r is row for r in row[:256]):
                break  # nothing can follow
        return reached

    def found(self, text: bytes) -> int:
        """One pass: a bit for each rule that matches somewhere."""
        row, mask = self.rows, 0
        for b in text:
            row = row[b]
            if row[256]:
                mask |= row[256]
        return mask

    def rule_spans(self, k: int, text: bytes) -> list[tuple[int, int]]:
        """Leftmost, longest, non-overlapping byte spans of rule ``k``, short ones dropped."""
        starts = []
        row = self.backward[k]
        for i in range(len(text) - 1, -1, -1):
            row = row[text[i]]
            if row[256]:
                starts.append(i)
        spans = []
        at = 0
        for start in reversed(starts):
            if start < at:
                continue
            at = self._reach(self.forward[k], text, start, len(text))
            if at - self._reach(self.heads[k], text, start, at) >= self.rules[k].min_rest:
                spans.append((start, at))
        return spans

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start and then rule."""
        mask = self.found(text)
        return sorted(
            (start, k, end) for k in range(len(self.rules)) if mask >> k & 1 for start, end in self.rule_spans(k, text)
        )


def _code_points(text: bytes, places: list[int]) -> dict[int, int]:
    """The number of code points before each byte place."""
    found, at, count = {}, 0, 0
    for place in sorted(set(places)):
        count += sum(1 for b in text[at:place] if b & 0xC0 != 0x80)
        found[place] = count
        at = place
    return found


FIELDS = [
    T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("base_spans", T.StringType()),
    T.StructField("spans", T.StringType()),
]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and spans of secrets per document.

    ``spans`` joins ``kind:start:end`` of all rules by start and then in the order of the
    rules; places count code points, the end is exclusive. ``base_spans`` has the first three rules only. A
    null text counts as empty and has none; repeated rows are scanned alike, ids stay as they are.
    """
    kinds = [r.kind for r in rules]
    n_base = len(BASE_RULES)
    tables = compile_rules(rules)
    made_once: list[Scanner] = []

    def measure(texts: list[bytes | None]) -> dict[str, pa.Array]:
        if not made_once:
            made_once.append(Scanner(tables))
        scanner = made_once[0]
        counts: list[list[int]] = [[] for _ in range(n_base)]
        base, every = [], []
        for body in texts:
            body = body or b""
            found = scanner.spans(body)
            place = _code_points(body, [p for s, _, e in found for p in (s, e)])
            told = [(k, f"{kinds[k]}:{place[s]}:{place[e]}") for s, k, e in found]
            for k in range(n_base):
                counts[k].append(sum(1 for kind, _ in told if kind == k))
            base.append(",".join(t for k, t in told if k < n_base))
            every.append(",".join(t for _, t in told))
        made = {f.name: pa.array(c, type=pa.int64()) for f, c in zip(FIELDS, counts, strict=False)}
        return made | {"base_spans": pa.array(base, type=pa.string()), "spans": pa.array(every, type=pa.string())}

    named = docs.select(column(id).alias("id"), column(text).alias("text"))
    return map_texts(named, "text", measure, FIELDS, ["id"]).withColumnRenamed("id", id)
