"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A multiset of letters is a binary vector with one place for the i-th copy of a letter. One
inserted, deleted or replaced letter changes at most two places. The places are dealt to
parts; two vectors that differ in two places at most agree on all parts but some two, so a
signature for every choice of two parts to leave out brings them together. Vectors that meet
are compared exactly; their difference names the letters of the edit, and words are looked
up as what that edit makes of another.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import checkpoint, column

MIN_LETTERS = 6
MIN_COUNT = 5

# A form must be this many times as frequent as the word it stands for.
FORM_RATIO = 5

# One run in so many has lost a letter, which code point by its hash.
DELETE_ONE_IN = 199

MAX_PLACES = 2

# Parts of the vectors' places; every pair of parts is left out once.
PARTS = 8

# A signature shared by more vectors is cut by twice as many parts instead of being compared.
BUCKET_LIMIT = 1024

# With so many parts any signature is compared: few vectors agree in all parts but two of them.
MOST_PARTS = 64

# Distinct words a task holds before it passes on their counts.
HELD_WORDS = 300_000

MASK = (1 << 64) - 1


# Words and their counts


def _runs(least: int) -> re.Pattern:
    return re.compile("[a-zÀ-ÿ]{%d,}" % least)


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    delete_one_in: int | None = DELETE_ONE_IN,
) -> DataFrame:
    """How often each word of ``min_letters`` code points or more occurs: ``(word, n)``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. If
    ``delete_one_in`` divides the CRC-32 of ``<doc_id>:<run>``, the run loses the code point at
    that hash modulo its length. A null text has no words, a null id is written as nothing. Tasks sum up before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A run that a deletion would make too short is of no use, so neither is a shorter one.
        find = _runs(min_letters).findall
        held: Counter[str] = Counter()
        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not body:
                    continue
                # Lower case of bytes knows A to Z only.
                for run, n in Counter(find(body.lower().decode())).items():
                    if delete_one_in is not None:
                        h = zlib.crc32(f"{key}:{run}".encode())
                        if h % delete_one_in == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_letters:
                                continue
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)

    rows = docs.select(F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("key"), column(text).alias("body"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), type=pa.string()), pa.array(list(held.values()), type=pa.int64())], names=["word", "n"]
    )


# Signatures of multisets


def places(letters: str) -> list[str]:
    """The places set in the vector of a multiset, given as a string: each letter with the number of its copy."""
    seen: Counter[str] = Counter()
    found = []
    for c in letters:
        seen[c] += 1
        found.append(f"{c}{seen[c]}")
    return found


def place_hash(place: str) -> int:
    """A fixed 64-bit hash of a place."""
    digest = place.encode()
    return zlib.crc32(digest) << 32 | zlib.crc32(digest, 0x9E3779B9)


def part_of(place: str, parts: int) -> int:
    return zlib.crc32(place.encode(), 0x85EBCA6B) * 0x9E3779B1 % (1 << 32) * parts >> 32


def _vectors(sets: list[str], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each multiset the sum of hashes in each part, and 64 bits that change with every place."""
    sums = np.zeros((len(sets), parts), dtype=np.uint64)
    bits = np.zeros(len(sets), dtype=np.uint64)
    known: dict[str, tuple[int, int, int]] = {}
    for i, letters in enumerate(sets):
        own: dict[int, int] = {}
        parity = 0
        for place in places(letters):
            if place not in known:
                h = place_hash(place)
                known[place] = (part_of(place, parts), h, 1 << (h * 0xD6E8FEB86659FD93 >> 40 & 63))
            part, h, bit = known[place]
            own[part] = own.get(part, 0) + h
            parity ^= bit
        for part, h in own.items():
            sums[i, part] = h & MASK
        bits[i] = parity
    return sums, bits


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def signatures(sets: DataFrame, parts: int) -> DataFrame:
    """``(sig, bits, letters)``: every multiset of ``letters`` under each choice of two parts left out."""
    left_out = np.array(list(combinations(range(parts), MAX_PLACES)))
    salts = _mixed(np.arange(1, len(left_out) + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                column_of = batch.column(0).slice(start, 4096)
                sums, bits = _vectors(column_of.to_pylist(), parts)
                rest = sums.sum(axis=1)[:, None] - sums[:, left_out].sum(axis=2)
                sig = _mixed(rest ^ salts).view(np.int64)
                repeat = np.repeat(np.arange(len(bits)), len(left_out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.ravel()), pa.array(bits.view(np.int64)[repeat]), column_of.take(pa.array(repeat))],
                    names=["sig", "bits", "letters"],
                )

    return sets.select("letters").mapInArrow(sign, "sig long, bits long, letters string")


def difference(a: str, b: str) -> tuple[str, str]:
    """The letters that the multiset ``a`` has beyond ``b``, and those that ``b`` has beyond ``a``."""
    left, right = Counter(a), Counter(b)
    return "".join(sorted((left - right).elements())), "".join(sorted((right - left).elements()))


def _first_choice(a: str, b: str, parts: int) -> tuple[int, int]:
    """The first two parts that can be left out to make two close vectors equal."""
    differ = sorted({part_of(p, parts) for p in set(places(a)) ^ set(places(b))})
    if len(differ) == 2:
        return differ[0], differ[1]
    return (differ[0], differ[0] + 1) if differ[0] == 0 else (0, differ[0])


def _compare(parts: int, limit: int):
    """Reads (sig, bits, letters) sorted by sig; gives close pairs once each, and the vectors of overfull signatures."""
    choices = {c: i for i, c in enumerate(combinations(range(parts), MAX_PLACES))}
    salts = _mixed(np.arange(1, len(choices) + 1, dtype=np.uint64))

    def is_first(a: str, b: str, sig: int) -> bool:
        sums, _ = _vectors([a], parts)
        i, j = _first_choice(a, b, parts)
        rest = sums.sum(axis=1) - sums[:, i] - sums[:, j]
        return int(_mixed(rest ^ salts[choices[i, j]]).view(np.int64)[0]) == sig

    def close(sig: np.ndarray, bits: np.ndarray, letters: pa.Array, sizes: np.ndarray) -> Iterator[tuple]:
        # Rows of one signature lie together; compare each with the one 1, 2, ... places on.
        at = np.flatnonzero(sizes > 1)
        step = 1
        while len(at):
            at = at[at + step < len(sig)]
            at = at[sig[at] == sig[at + step]]
            near = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= MAX_PLACES]
            for i in near.tolist():
                a, b = letters[i].as_py(), letters[i + step].as_py()
                if abs(len(a) - len(b)) > 1 or a == b:
                    continue
                lost, gained = difference(a, b)
                if max(len(lost), len(gained)) == 1 and is_first(a, b, int(sig[i])):
                    # A longer one loses a letter; of equal lengths the smaller one is changed.
                    if len(b) > len(a) or (len(a) == len(b) and b < a):
                        a, b, lost, gained = b, a, gained, lost
                    yield a, b, lost, gained
            step += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in columns], names=["a", "b", "lost", "gained"])

        def put_off(letters: pa.Array) -> pa.RecordBatch:
            none = pa.nulls(len(letters), pa.string())
            return pa.RecordBatch.from_arrays([letters.cast(pa.string()), none, none, none], names=["a", "b", "lost", "gained"])

        tail: pa.RecordBatch | None = None
        overfull: int | None = None
        for batch in batches:
            if tail is not None and tail.num_rows:
                batch = pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
            sig = batch.column(0).to_numpy()
            if not len(sig):
                continue
            bits = batch.column(1).to_numpy().view(np.uint64)
            letters = batch.column(2)
            cuts = np.flatnonzero(sig[1:] != sig[:-1]) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(sig)]])
            sizes = ends - starts
            large = sizes > limit
            if overfull is not None:
                large |= sig[starts] == overfull
            for i in np.flatnonzero(large):
                yield put_off(letters.slice(starts[i], sizes[i]))
            # The last signature may go on in the next batch.
            overfull = int(sig[-1]) if large[-1] else None
            done = len(sig) if large[-1] else starts[-1]
            tail = batch.slice(done)
            here = np.where(large, 0, sizes)
            here[-1] = 0
            if found := list(close(sig[:done], bits[:done], letters, np.repeat(here, sizes)[:done])):
                yield rows(found)
        if tail is not None and tail.num_rows > 1:
            sig, bits = tail.column(0).to_numpy(), tail.column(1).to_numpy().view(np.uint64)
            if found := list(close(sig, bits, tail.column(2), np.full(len(sig), len(sig)))):
                yield rows(found)

    return run


def close_multisets(sets: DataFrame, parts: int = PARTS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """The pairs of multisets that one edit may lead between: ``(a, b, lost, gained)``, each pair once.

    ``sets`` has distinct strings of sorted ``letters``. Taking ``lost`` from ``a`` and adding ``gained`` (a letter or
    nothing) gives ``b``. A signature of more than ``limit`` multisets is not compared;
    they are signed anew by twice as many parts, up to ``MOST_PARTS``, so every pair is found at some level.
    """
    found: DataFrame | None = None
    left = sets.select("letters")
    while True:
        signed = signatures(left, parts).repartition("sig").sortWithinPartitions("sig")
        most = limit if parts < MOST_PARTS else 1 << 62
        met = checkpoint(signed.mapInArrow(_compare(parts, most), "a string, b string, lost string, gained string"))
        pairs = met.where("b IS NOT NULL")
        found = pairs if found is None else found.union(pairs)
        left = checkpoint(met.where("b IS NULL").select(F.col("a").alias("letters")).distinct())
        if left.isEmpty():
            # A pair may be close at several levels.
            return found.distinct()
        parts = min(2 * parts, MOST_PARTS)


# Words


def near_words(words: DataFrame, parts: int = PARTS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """All ordered pairs of words that differ by one inserted, deleted or replaced code point.

    ``words`` has distinct strings ``word`` with ``n``; gives ``(word, other, other_n)``. The edit that leads from
    one multiset to a close one is made at every place it fits, and the outcome looked up
    among the words, so words that only share letters never meet.
    """
    sorted_letters = F.array_join(F.array_sort(F.split("word", "")), "")
    known = checkpoint(words.select("word", "n", sorted_letters.alias("letters")))
    pairs = close_multisets(known.select("letters").distinct(), parts, limit)
    edited = known.join(pairs.select(F.col("a").alias("letters"), "lost", "gained"), "letters")
    fits = F.filter(F.sequence(F.lit(1), F.length("word")), lambda i: F.col("word").substr(i, F.lit(1)) == F.col("lost"))
    made = F.transform(
        fits,
        lambda i: F.concat(
            F.col("word").substr(F.lit(1), i - 1), F.col("gained"), F.col("word").substr(i + 1, F.length("word"))
        ),
    )
    edited = edited.select("word", "n", F.explode(F.array_distinct(made)).alias("other"))
    met = checkpoint(edited.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other"))
    return met.select("word", "other", "other_n").union(
        met.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """The last form that each word's forms lead to: ``(word, root)``.

    ``forms`` has one ``(word, form)`` for each word that has a form. Forms grow in frequency, so there is no circle; steps double, so
    rounds grow with the logarithm of the longest way.
    """
    now = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = now.join(onward, "root", "left")
        now = checkpoint(
            ahead.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    form_ratio: int = FORM_RATIO,
    delete_one_in: int | None = DELETE_ONE_IN,
) -> DataFrame:
    """Every frequent word with its form and root: ``(word, form, root, n, n_near, form_n)``.

    Words are those of ``word_counts`` with ``min_count`` occurrences or more. The form is the near word of largest n,
    ties going to the smallest in code-point order, if it has ``form_ratio`` times the word's n; else null. The
    root is where forms lead in the end, the word itself without a form. Null and empty texts have no words, an
    empty table gives no row; repeated rows count again.
    """
    counts = word_counts(docs, doc_id, text, min_letters, delete_one_in)
    words = checkpoint(counts.where(F.col("n") >= min_count))
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")
    is_form = -F.col("best.less") >= form_ratio * F.col("n")
    judged = checkpoint(
        judged.select(
            "word", "n", "n_near", F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
        )
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
