"""Phrase mining by prefix-free parsing: n-grams are counted in a dictionary of chunks.

Every piece of text is cut wherever a window of its words hashes to a trigger, so equal text
is cut alike wherever it stands. Neighbouring chunks overlap by one window. The distinct chunks with their
frequencies form the dictionary; an n-gram counts in a chunk, as often as that chunk occurs, if its last
word lies behind the overlap with the chunk before, so each occurrence counts once. Words
are counted first, and an n-gram only if all shorter ones in it are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import SLICE_BYTES, checkpoint, column

LONGEST = 4
LEAST_COUNT = 30
PER_LANG = 2000

# Words in a trigger window, which neighbouring chunks share: one fewer than the longest phrase.
OVERLAP = LONGEST - 1

# One window in so many ends a chunk.
TRIGGER_ONE_IN = 16

SCALE = 2_000_000

# A phrase goes if a longer one holds it and occurs this often, in percent of the phrase.
ABSORBED_PERCENT = 80

UNKNOWN_LANG = "und"

# Bits of the filter that tells n-grams that may be frequent; its size does not depend on the data.
FILTER_BITS = 1 << 26

# Rows of one language that may be ranked in one task.
RANKED_TOGETHER = 200_000

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
SPACE, BREAK = 0x20, 0x0A

# 1: a blank, 2: a break between pieces, 0: part of a word.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[list(BLANKS)] = 1
KINDS[list(BREAKS)] = 2

# An odd base has an inverse modulo 2**64, which takes the place out of a hash.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


# Hashes of slices


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1 modulo 2**64."""
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Hashes:
    """Hashes of slices of one buffer of bytes that depend on the bytes of the slice only."""

    def __init__(self, data: np.ndarray):
        weighted = (data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        self.back = _powers(BASE_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def slices_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``data`` as strings."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    take = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[take])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and the bounds of its values in them."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# The dictionary of chunks


class Words:
    """The words of some texts, joined by one blank each, with the pieces and texts they are from."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        # A to Z in lower case; other bytes are part of other characters.
        data = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)
        kinds = KINDS[data]
        in_word = kinds == 0
        begins = in_word.copy()
        begins[1:] &= ~in_word[:-1]
        # A text begins a word and a piece of its own.
        inner = bounds[:-1][(bounds[:-1] > 0) & (bounds[:-1] < len(data))]
        begins[inner] |= in_word[inner]
        breaks = kinds == 2
        first = np.flatnonzero(begins)
        ends = np.empty(len(first), dtype=np.int64)
        closed = in_word.copy()
        closed[:-1] &= ~in_word[1:] | begins[1:]
        ends[:] = np.flatnonzero(closed) + 1
        pieces = np.cumsum(breaks)[first] if len(first) else first
        self.text = np.searchsorted(bounds, first, side="right") - 1
        new = np.ones(len(first), dtype=bool)
        new[1:] = (pieces[1:] != pieces[:-1]) | (self.text[1:] != self.text[:-1])
        self.new_piece = new
        # Word bytes and one blank behind each word.
        sizes = ends - first + 1
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(first) else first
        self.ends = self.starts + sizes - 1
        self.data = np.full(int(sizes.sum()), SPACE, dtype=np.uint8)
        kept = np.ones(len(self.data), dtype=bool)
        kept[self.ends] = False
        self.data[kept] = data[in_word]


def cut_chunks(words: Words, overlap: int = OVERLAP, one_in: int = TRIGGER_ONE_IN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every chunk, and whether it begins a piece.

    A chunk ends with its piece, or with a window of ``overlap`` words whose hash triggers; the next one begins with
    that window. A window that reaches back beyond the piece's start does not trigger.
    """
    n = len(words.starts)
    if not n:
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=bool),)
    at = np.arange(n)
    since = at - np.maximum.accumulate(np.where(words.new_piece, at, 0))
    last_in_piece = np.append(words.new_piece[1:], True)
    hashed = Hashes(words.data)
    window = _mixed(hashed.of(words.starts[np.maximum(at - overlap + 1, 0)], words.ends))
    triggers = (since >= overlap) & (window % np.uint64(one_in) == 0)
    last = np.flatnonzero(triggers | last_in_piece)
    # After a trigger the next chunk starts with its window, after a piece with the next word.
    ended = last_in_piece[last]
    first = np.empty(len(last), dtype=np.int64)
    first[0] = 0
    first[1:] = np.where(ended[:-1], last[:-1] + 1, last[:-1] - overlap + 1)
    opens = np.append(True, ended[:-1])
    return first, last, opens


def _summed(parts: list[pa.Table], by: list[str], value: str) -> pa.Table:
    table = pa.concat_tables(parts).group_by(by).aggregate([(value, "sum")])
    return table.rename_columns([*by, value])


# Distinct rows a task may gather before it passes them on.
HELD_ROWS = 400_000


def _gather(made: Iterator[pa.Table], by: list[str], value: str) -> Iterator[pa.RecordBatch]:
    """Sums of ``value`` per ``by`` over what the task makes; several for a key if there is much."""
    held: pa.Table | None = None
    waiting: list[pa.Table] = []
    for table in made:
        waiting.append(table)
        if sum(t.num_rows for t in waiting) > HELD_ROWS:
            held = _summed(waiting + ([held] if held is not None else []), by, value)
            waiting = []
            if held.num_rows > HELD_ROWS:
                yield from held.to_batches(max_chunksize=1 << 16)
                held = None
    if waiting or held is not None:
        yield from _summed(waiting + ([held] if held is not None else []), by, value).to_batches(max_chunksize=1 << 16)


def parse(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, one_in: int = TRIGGER_ONE_IN) -> DataFrame:
    """The dictionary: ``(lang, opens, chunk, n)``, each distinct chunk of a language with its frequency.

    ``opens`` tells chunks that begin a piece, whose first words are in no chunk before. Texts
    are lower-cased (A-Z), pieces end at ``.,;:!?`` and line breaks, words at blanks and tabs. A null
    text is empty, a null language ``und``.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            data, bounds = _bytes_of(batch.column(1))
            langs = batch.column(0)
            start = 0
            while start < len(bounds) - 1:
                # Whole texts of about one slice; a longer text is a slice of its own.
                end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + SLICE_BYTES, side="right")) - 1)
                words = Words(data[bounds[start] : bounds[end]], bounds[start : end + 1] - bounds[start])
                first, last, opens = cut_chunks(words, longest - 1, one_in)
                if len(first):
                    yield pa.table({
                        "lang": langs.take(pa.array(start + words.text[first])).cast(pa.large_string()),
                        "opens": pa.array(opens),
                        "chunk": slices_of(words.data, words.starts[first], words.ends[last]),
                        "n": pa.array(np.ones(len(first), dtype=np.int64)),
                    })
                start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _plain(_gather(chunks(batches), ["lang", "opens", "chunk"], "n"))

    rows = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.coalesce(column(text), F.lit("")).alias("body")
    )
    made = rows.mapInArrow(run, "lang string, opens boolean, chunk string, n long")
    return made.groupBy("lang", "opens", "chunk").agg(F.sum("n").alias("n"))


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings with small offsets, as the engine reads them."""
    for batch in batches:
        columns = [c.cast(pa.string()) if c.type == pa.large_string() else c for c in batch.columns]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


# Counting


def _filter_places(langs: pa.Array, hashes: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bit for each (language, n-gram)."""
    coded = langs.dictionary_encode()
    of_lang = np.array([_lang_salt(v) for v in coded.dictionary.to_pylist()], dtype=np.uint64)
    return _mixed(hashes ^ of_lang[coded.indices.to_numpy()]) & np.uint64(bits - 1)


def _lang_salt(lang: str) -> int:
    data = np.frombuffer(lang.encode(), dtype=np.uint8)
    return int(_mixed(Hashes(data).of(np.array([0]), np.array([len(data)])))[0])


def frequent_filter(frequent: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit map that has the bit of every ``(lang, phrase)`` set; of ``bits`` bits, whatever the rows.

    The driver gets one long per 64 bits at most.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch.column(1))
            place = _filter_places(batch.column(0), Hashes(data).of(bounds[:-1], bounds[1:]), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))],
                names=["word", "mask"],
            )

    masks = frequent.select("lang", "phrase").mapInArrow(hashed, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    table = masks.toArrow()
    found = np.zeros(bits >> 6, dtype=np.uint64)
    found[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return found


def count_ngrams(dictionary: DataFrame, length: int, shorter: np.ndarray | None, longest: int = LONGEST) -> DataFrame:
    """``(lang, phrase, n)`` for the n-grams of ``length`` words in the dictionary.

    ``shorter`` is the filter of the frequent n-grams of one word fewer: an n-gram both of whose
    parts may be in it counts, all others are left out. The sums are whole for all that are given.
    """
    sent = None if shorter is None else dictionary.sparkSession.sparkContext.broadcast(shorter)
    bits = 0 if shorter is None else len(shorter) << 6

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        known = None if sent is None else sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1 << 14):
                batch = whole.slice(start, 1 << 14)
                made = _grams(batch, length, known, bits, longest - 1)
                if made is not None:
                    yield made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _plain(_gather(grams(batches), ["lang", "phrase"], "n"))

    made = dictionary.select("lang", "opens", "chunk", "n").mapInArrow(run, "lang string, phrase string, n long")
    return made.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _grams(batch: pa.RecordBatch, length: int, known: np.ndarray | None, bits: int, overlap: int) -> pa.Table | None:
    """The n-grams of some chunks that end behind the overlap, each with its chunk's frequency."""
    data, bounds = _bytes_of(batch.column(2))
    if not len(data):
        return None
    # Chunks have single blanks and no breaks, so a word begins at a chunk's start or behind a blank.
    is_start = np.zeros(len(data) + 1, dtype=bool)
    is_start[1:] = data == SPACE
    is_start[bounds[:-1]] = True
    starts = np.flatnonzero(is_start[: len(data)])
    chunk = np.searchsorted(bounds, starts, side="right") - 1
    ends = np.append(starts[1:] - 1, len(data))
    ends[np.append(chunk[1:] != chunk[:-1], True)] += 1
    ends[-1] = len(data)
    at = np.arange(len(starts))
    within = at - np.searchsorted(starts, bounds[:-1])[chunk]
    opens = batch.column(1).to_numpy(zero_copy_only=False)[chunk]
    counted = within + 1 >= length
    counted &= opens | (within >= overlap)
    if known is not None:
        # The n-gram that ends at a word has its parts from the word before and from itself.
        whole = within + 1 >= length - 1
        hit = np.zeros(len(starts), dtype=bool)
        last = at[whole]
        hashes = Hashes(data).of(starts[last - length + 2], ends[last])
        place = _filter_places(batch.column(0).take(pa.array(chunk[last])), hashes, bits)
        hit[last] = known[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
        counted &= hit
        counted[1:] &= hit[:-1]
    last = at[counted]
    if not len(last):
        return None
    of_chunk = pa.array(chunk[last])
    table = pa.table({
        "lang": batch.column(0).take(of_chunk).cast(pa.large_string()),
        "phrase": slices_of(data, starts[last - length + 1], ends[last]),
        "n": batch.column(3).take(of_chunk),
    })
    return _summed([table], ["lang", "phrase"], "n")


def frequent_ngrams(dictionary: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """All n-grams of up to ``longest`` words that occur ``least`` times: ``(lang, phrase, words, n)``; and words per language.

    Counted length by length; an n-gram can only be frequent if the shorter ones in it are.
    """
    levels: list[DataFrame] = []
    known: np.ndarray | None = None
    totals: DataFrame | None = None
    for length in range(1, longest + 1):
        counts = count_ngrams(dictionary, length, known, longest)
        if length == 1:
            counts = checkpoint(counts)
            totals = checkpoint(counts.groupBy("lang").agg(F.sum("n").alias("total")))
        frequent = checkpoint(counts.where(F.col("n") >= least).select("lang", "phrase", F.lit(length).alias("words"), "n"))
        levels.append(frequent)
        if length < longest:
            known = frequent_filter(frequent, bits)
    return reduce(DataFrame.union, levels), totals


# Scores


def _first_words(phrase: str, k: int) -> F.Column:
    return F.substring_index(F.col(phrase), " ", k)


def scored(frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` for phrases of two words or more, at their lowest-scoring cut.

    ``score`` is floor(2000000 * a / (l + r)) in decimal arithmetic; equal scores go to the cut after fewer words.
    """
    parts = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    whole = frequent.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    left = F.expr("substring_index(phrase, ' ', k)")
    right = F.expr("substring_index(phrase, ' ', k - words)")
    cuts = cuts.select("lang", "phrase", "words", "a", "k", left.alias("left"), right.alias("right"))
    cuts = cuts.join(parts.withColumnsRenamed({"part": "left", "part_n": "l"}), ["lang", "left"])
    cuts = cuts.join(parts.withColumnsRenamed({"part": "right", "part_n": "r"}), ["lang", "right"])
    score = F.expr(f"CAST(CAST(a AS DECIMAL(19, 0)) * {SCALE} AS DECIMAL(27, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "best.score"
    )


def absorbed(frequent: DataFrame, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """The phrases ``(lang, phrase)`` that a longer one holds with ``percent`` of their occurrences or more."""
    longer = frequent.where("words >= 3").select("lang", F.split("phrase", " ").alias("ws"), "words", F.col("n").alias("f"))
    sizes = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    spans = sizes.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = spans.select("lang", F.expr("array_join(slice(ws, start, size), ' ')").alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    held = frequent.where("words >= 2").join(most, ["lang", "phrase"])
    # Decimals hold the products of counts of any size.
    wide = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(4,0)")
    return held.where(wide("f", 100) >= wide("n", percent)).select("lang", "phrase")


def top_per_lang(rows: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The first ``per_lang`` rows of each language with their ``rank``.

    Rows are thinned in slices of a language until what is left can be ranked in one task;
    the first of a language are among the first of their slices.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = checkpoint(rows)
    while True:
        largest = rows.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
        if largest <= max(RANKED_TOGETHER, 4 * per_lang):
            break
        # Slices hold several times what is kept of them, so every round leaves less.
        slices = -(-largest // (16 * per_lang))
        slot = F.pmod(F.xxhash64("phrase"), F.lit(slices))
        within = Window.partitionBy("lang", slot).orderBy(*order)
        rows = checkpoint(rows.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= per_lang).drop("rank"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= per_lang)


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST_COUNT,
    per_lang: int = PER_LANG,
    one_in: int = TRIGGER_ONE_IN,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """The best collocations of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    Candidates are phrases of 2 to 4 words with ``least`` occurrences or more within pieces; ``a``, ``l`` and ``r`` count
    the phrase and the two parts of its lowest-scoring cut, ``n`` all words of the language. Candidates that a longer
    one absorbs are left out. Order: score and a descending, phrase by bytes. Null and empty texts
    have no words, an empty table gives no row; repeated rows count again.
    """
    dictionary = checkpoint(parse(docs, text, lang, one_in=one_in))
    frequent, totals = frequent_ngrams(dictionary, least, bits=bits)
    frequent = checkpoint(frequent)
    kept = scored(frequent).join(absorbed(frequent), ["lang", "phrase"], "left_anti")
    best = top_per_lang(kept, per_lang).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
