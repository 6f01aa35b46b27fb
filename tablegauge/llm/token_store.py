"""Token ids in files coded by a static range asymmetric numeral system.

One table of token frequencies, counted over all documents, serves every block. A block
holds whole documents in order and is coded by itself in interleaved lanes. Checkpoints in
a block give the lane states and the place in the word stream, so its segments can be
decoded apart; every segment has a checksum of its ids.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablegauge.llm.common import checkpoint, column, map_texts, slices, small_side
from tablegauge.session import scratch_path

END_ID = 0
SCALE_BITS = 20
LANES = 2048
BLOCK_TOKENS = 1 << 18
SEGMENT_STEPS = 32

# Words a worker remembers: those met again, and those met once since they were last let go.
KEPT_WORDS = 1 << 19
NEW_WORDS = 1 << 18

# Bytes of text whose words are looked up together.
LOOKUP_BYTES = 4 << 20

# Marks that may close a word, neighbouring blanks of any kind, and words of Latin letters.
MARKS = ".,;:!?"
NEIGHBOURS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"

LOW = 1 << 31
HEADER = "<4sHBBIQII"
HEADER_SIZE = struct.calcsize(HEADER)
MAGIC = b"TGAN"


# Tokenizing


class WordwiseEncoder:
    """Encodes whole texts with a tokenizer and remembers the ids of words.

    A byte-level tokenizer with the usual split pattern never joins across a single blank
    between two characters that are not blank, so the text between such blanks has the same ids
    everywhere. New words are encoded many at a time in one call and kept apart from words met in
    more than one slice of texts, so the many words that come once do not drive out the others. Other tokenizers, and
    texts with neighbouring blanks, are encoded as they are.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS, new_words: int = NEW_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        added = [t["content"] for t in told.get("added_tokens", [])]
        self.by_word = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and told.get("normalizer") is None
            and not any(re.search(r"\s", a) for a in added)
        )
        n = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        # The byte-level alphabet writes the blank as this letter.
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(n)])
        self.kept: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.kept_words, self.new_words = kept_words, new_words
        # The pattern never cuts inside a run of letters, nor joins one to the marks behind it, so
        # such words need no pattern. Letters of the first blocks are letters in every version.
        self.pieces = Tokenizer.from_file(path)
        if self.by_word:
            self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tails: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _tail(self, marks: str) -> bytes:
        """The ids of marks that close a word."""
        if marks not in self.tails:
            if len(self.tails) > 4096:
                self.tails = {"": b""}
            self.tails[marks] = self._whole(marks)
        return self.tails[marks]

    def _parted(self, words: list[str], ids: np.ndarray) -> list[bytes] | None:
        """The ids of words that each begin with a blank, cut at the tokens that do; None if they don't match."""
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(words):
            return None
        raw, cuts = ids.tobytes(), (at * self.kind.itemsize).tolist()
        return list(map(raw.__getitem__, map(slice, cuts, [*cuts[1:], len(raw)])))

    def _encoded(self, words: list[str], of_letters: bool) -> list[bytes]:
        """The ids of words that follow a blank, many in one call."""
        out: list[bytes] = []
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            if of_letters:
                made = self.pieces.encode_batch_fast([[" " + w for w in part]], is_pretokenized=True, add_special_tokens=False)
            else:
                made = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)
            found = self._parted(part, np.array(made[0].ids, dtype=self.kind))
            out += found if found is not None else [self._whole(" " + w) for w in part]
        return out

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of different words that follow a blank, encoded now."""
        stems = pc.utf8_rtrim(pa.array(words, pa.string()), MARKS)
        plain = pc.match_substring_regex(stems, LETTERS).to_numpy(zero_copy_only=False)
        coded = stems.filter(pa.array(plain)).dictionary_encode()
        different = coded.dictionary.to_pylist()
        ids = [self.kept.get(w) or self.new.get(w) for w in different]
        new = [i for i, found in enumerate(ids) if found is None]
        for i, made in zip(new, self._encoded([different[i] for i in new], True), strict=True):
            ids[i] = made
        out: list[bytes] = [b""] * len(words)
        of_stem = list(map(ids.__getitem__, coded.indices.to_pylist()))
        for i, found, stem in zip(np.flatnonzero(plain).tolist(), of_stem, map(different.__getitem__, coded.indices.to_pylist())):
            word = words[i]
            out[i] = found if len(word) == len(stem) else found + self._tail(word[len(stem) :])
        other = np.flatnonzero(~plain).tolist()
        for i, found in zip(other, self._encoded([words[i] for i in other], False), strict=True):
            out[i] = found
        return out

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of different words that follow a blank; a word met in an earlier slice is kept from now on."""
        ids = list(map(self.kept.get, words))
        missing = [i for i, found in enumerate(ids) if found is None]
        if not missing:
            return ids
        again: dict[str, bytes] = {}
        fresh: list[int] = []
        for i in missing:
            found = self.new.get(words[i])
            if found is None:
                fresh.append(i)
            else:
                ids[i] = again[words[i]] = found
        unknown = [words[i] for i in fresh]
        learned = self._learn(unknown)
        for i, found in zip(fresh, learned, strict=True):
            ids[i] = found
        # More words than may be remembered are not remembered.
        if len(self.kept) + len(again) > self.kept_words:
            self.kept = {}
        if len(again) <= self.kept_words:
            self.kept.update(again)
        if len(self.new) + len(learned) > self.new_words:
            self.new = {}
        if len(learned) <= self.new_words:
            self.new.update(zip(unknown, learned, strict=True))
        return ids

    def encode_many(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of every text as little-endian numbers of ``kind``, closed by ``end``.

        The words of all texts are looked up once each, and the ids put together by their numbers.
        """
        by_word = pc.invert(pc.match_substring_regex(texts, NEIGHBOURS)) if self.by_word else pa.array([False] * len(texts))
        whole: list[bytes | None] = [None] * len(texts)
        for i in np.flatnonzero(~by_word.to_numpy(zero_copy_only=False)).tolist():
            text = texts[i].as_py()
            whole[i] = self._whole(text) if text else b""
        split = pc.split_pattern(pc.if_else(by_word, texts, ""), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        # A first word follows no blank; texts encoded whole have one piece, which is empty.
        is_first = np.zeros(bounds[-1] - bounds[0], dtype=bool)
        firsts = bounds[:-1] - bounds[0]
        is_first[firsts] = True
        values = split.flatten()
        coded = values.filter(pa.array(~is_first)).dictionary_encode()
        begun = self.tokenizer.encode_batch_fast(values.take(pa.array(firsts)).to_pylist(), add_special_tokens=False)
        opening = [np.array(b.ids, dtype=self.kind).tobytes() if w is None else w for b, w in zip(begun, whole, strict=True)]
        pieces = [*self._ids_of(coded.dictionary.to_pylist()), *opening, end]
        known = len(coded.dictionary)
        # Every text in numbers of pieces: its opening, its words, the end.
        numbers = np.full(len(is_first) + len(texts), known + len(texts), dtype=np.int64)
        at = np.arange(len(is_first)) + np.repeat(np.arange(len(texts)), np.diff(bounds))
        numbers[at[~is_first]] = coded.indices.to_numpy()
        numbers[at[is_first]] = known + np.arange(len(texts))
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // self.kind.itemsize
        data = np.frombuffer(b"".join(pieces), dtype=self.kind)
        begins = np.cumsum(sizes) - sizes
        runs = sizes[numbers]
        ends = np.cumsum(runs)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[numbers] - (ends - runs), runs)
        closes = ends[np.cumsum(np.diff(bounds) + 1) - 1] if len(texts) else ends
        offsets = np.concatenate([[0], closes]).astype(np.int64) * self.kind.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(data[take])])

    def encode(self, text: str) -> bytes:
        return self.encode_many(pa.array([text], pa.large_string()))[0].as_py()


def _strings(texts: list[bytes]) -> pa.Array:
    """The texts as strings; bytes that are no UTF-8 become replacement characters."""
    try:
        return pa.array(texts, pa.large_binary()).cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())


def _encoder(path: str) -> WordwiseEncoder:
    """One encoder for all tasks of a worker process."""
    # Functions are sent anew with each task; only a module of the worker itself stays.
    kept = sys.__dict__.setdefault("_tablegauge_encoders", {})
    if path not in kept:
        kept[path] = WordwiseEncoder(path)
    return kept[path]


def tokenize(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", end_id: int = END_ID) -> DataFrame:
    """The ``keep`` columns with ``ids``: little-endian ids of 2 bytes, or 4 for a vocabulary
    above 65,536, each document closed by ``end_id``. A null text has the end only."""

    def measure(texts: list[bytes | None]) -> dict[str, pa.Array]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        made = [encoder.encode_many(_strings(run), end).cast(pa.binary()) for run in slices(texts, LOOKUP_BYTES)]
        ids = pa.concat_arrays(made) if made else pa.array([], type=pa.binary())
        return {"ids": ids, "width": pa.array([encoder.kind.itemsize] * len(ids), type=pa.int32())}

    return map_texts(docs, text, measure, [T.StructField("ids", T.BinaryType()), T.StructField("width", T.IntegerType())], keep)


def token_counts(tokens: DataFrame) -> DataFrame:
    """``(token, n)`` over all documents; each task sends one row per token it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for width in (2, 4):
                own = [i for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w == width]
                if own:
                    more = np.bincount(np.frombuffer(b"".join(own), dtype=f"<u{width}"), minlength=len(total))
                    more[: len(total)] += total
                    total = more
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    return tokens.select("ids", "width").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


# Coding


class FrequencyTable:
    """Frequencies of the tokens that occur, scaled to a power of two in sum, each at least 1."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, scale_bits: int = SCALE_BITS):
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order]
        self.scale_bits = max(scale_bits, int(len(tokens)).bit_length() + 2)
        room = (1 << self.scale_bits) - len(tokens)
        share = [int(c) * room // int(counts.sum()) + 1 for c in counts]
        if share:
            share[int(np.argmax(counts))] += (1 << self.scale_bits) - sum(share)
        self._fill(tokens, np.array(share, dtype=np.uint64))

    def _fill(self, tokens: np.ndarray, share: np.ndarray) -> None:
        size = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(size, dtype=np.uint64)
        self.freq[tokens] = share
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(size, dtype=np.uint32), self.freq.astype(np.int64))

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that occur and their frequencies."""
        tokens = np.flatnonzero(self.freq)
        return tokens, self.freq[tokens]

    @classmethod
    def from_shares(cls, tokens: np.ndarray, share: np.ndarray) -> FrequencyTable:
        table = cls.__new__(cls)
        table.scale_bits = int(share.sum()).bit_length() - 1 if len(share) else SCALE_BITS
        table._fill(tokens.astype(np.int64), share.astype(np.uint64))
        return table


def encode_block(ids: np.ndarray, table: FrequencyTable, lanes: int = LANES, segment_steps: int = SEGMENT_STEPS) -> bytes:
    """One block: header, checkpoints with checksums, words. Id ``t * lanes + k`` is in lane ``k``."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    scale, word = np.uint64(table.scale_bits), np.uint64(32)
    limit = np.uint64(63 - table.scale_bits)
    low_word = np.uint64(0xFFFFFFFF)
    freq, start = table.freq[ids], table.start[ids]
    state = np.full(lanes, LOW, dtype=np.uint64)
    chunks: list[np.ndarray] = [np.empty(0, dtype="<u4")] * steps
    states: dict[int, bytes] = {}
    for t in range(steps - 1, -1, -1):
        lo, hi = t * lanes, min(n, (t + 1) * lanes)
        f, x = freq[lo:hi], state[: hi - lo]
        full = x >= f << limit
        chunks[t] = (x[full] & low_word).astype("<u4")
        x = np.where(full, x >> word, x)
        q = x // f
        state[: hi - lo] = (q << scale) + (x - q * f) + start[lo:hi]
        if t % segment_steps == 0:
            states[t] = state.astype("<u8").tobytes()
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(int)
    marks = sorted(states)
    parts = [struct.pack(HEADER, MAGIC, lanes, table.scale_bits, 0, segment_steps, n, len(marks), int(offsets[-1]))]
    plain = ids.astype("<u4")
    for t in marks:
        check = zlib.crc32(plain[t * lanes : (t + segment_steps) * lanes].tobytes())
        parts.append(struct.pack("<II", int(offsets[t]), check) + states[t])
    parts += [c.tobytes() for c in chunks]
    return b"".join(parts)


def decode_block(block: bytes, table: FrequencyTable, segments: range | None = None) -> np.ndarray:
    """The ids of a block, or of some of its segments; a wrong checksum raises."""
    magic, lanes, scale_bits, _, segment_steps, n, n_marks, n_words = struct.unpack_from(HEADER, block)
    if magic != MAGIC or scale_bits != table.scale_bits:
        raise ValueError("not a block of this table")
    mark_size = 8 + 8 * lanes
    words = np.frombuffer(block, dtype="<u4", count=n_words, offset=HEADER_SIZE + n_marks * mark_size)
    scale, mask, word = np.uint64(scale_bits), np.uint64((1 << scale_bits) - 1), np.uint64(32)
    low = np.uint64(LOW)
    steps = -(-n // lanes) if n else 0
    found = []
    for s in segments if segments is not None else range(n_marks):
        place = HEADER_SIZE + s * mark_size
        at, check = struct.unpack_from("<II", block, place)
        state = np.frombuffer(block, dtype="<u8", count=lanes, offset=place + 8).astype(np.uint64)
        first, last = s * segment_steps, min(steps, (s + 1) * segment_steps)
        out = np.empty(min(n, last * lanes) - first * lanes, dtype="<u4")
        for t in range(first, last):
            size = min(n, (t + 1) * lanes) - t * lanes
            x = state[:size]
            slot = x & mask
            ids = table.symbol[slot]
            out[(t - first) * lanes : (t - first) * lanes + size] = ids
            x = table.freq[ids] * (x >> scale) + slot - table.start[ids]
            need = np.flatnonzero(x < low)
            x[need] = (x[need] << word) | words[at : at + len(need)]
            at += len(need)
            state[:size] = x
        if zlib.crc32(out.tobytes()) != check:
            raise ValueError("a segment does not match its checksum")
        found.append(out)
    return np.concatenate(found) if found else np.empty(0, dtype="<u4")


# Files


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of all documents below ``path`` in ascending order of ``id``, null last.

    ``path/blocks`` holds the blocks with the ids and token counts of their documents,
    ``path/table`` the shared frequencies. Rows with one id follow in the order of their
    checksum and ids; equal rows are interchangeable. A document is never cut, so a very long one makes a block of its own length. The table of frequencies is bounded by
    the vocabulary. Texts are tokenized once; their ids wait in a written table.
    """
    spark = docs.sparkSession
    named = docs.select(column(id).alias("id"), column(text).alias("text"))
    # Of equal ids the ends of the hash spread a hot one over partitions.
    tokens = tokenize(named, tokenizer, ["id"], end_id=end_id).withColumn("tie", F.xxhash64("ids"))
    waiting = scratch_path(spark, "ids")
    tokens.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(waiting)
    tokens = spark.read.parquet(waiting)
    counts = token_counts(tokens).toPandas()
    table = FrequencyTable(counts["token"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64))
    shares = table.shares()
    rows = list(zip(*(s.tolist() for s in shares), strict=True))
    spark.createDataFrame(rows, "token long, freq long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(shares)
    id_type = tokens.schema["id"].dataType
    id_kind = to_arrow_type(id_type)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = FrequencyTable.from_shares(*shared.value)
        ids: list[int | None] = []
        raw: list[np.ndarray] = []
        held, n_blocks = 0, 0

        def block() -> pa.RecordBatch:
            nonlocal ids, raw, held, n_blocks
            made = [
                pa.array([part], type=pa.int32()),
                pa.array([n_blocks], type=pa.int64()),
                pa.array([ids], type=pa.list_(id_kind)),
                pa.array([[len(r) for r in raw]], type=pa.list_(pa.int64())),
                pa.array([held], type=pa.int64()),
                pa.array([encode_block(np.concatenate(raw), table)], type=pa.binary()),
            ]
            ids, raw, held, n_blocks = [], [], 0, n_blocks + 1
            return pa.RecordBatch.from_arrays(made, names=["part", "seq", "ids", "lengths", "n_tokens", "block"])

        for batch in batches:
            for one, body, width in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(one)
                raw.append(np.frombuffer(body, dtype=f"<u{width}"))
                held += len(raw[-1])
                if held >= block_tokens:
                    yield block()
        if raw:
            yield block()

    order = [F.col("id").asc_nulls_last(), "tie", "row"]
    ranged = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids", "width")
    schema = f"part int, seq long, ids array<{id_type.simpleString()}>, lengths array<long>, n_tokens long, block binary"
    ranged.mapInArrow(encode, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids)`` from the files, one row per document.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian unsigned
    32-bit numbers. Blocks are decoded independently.
    """
    rows = spark.read.parquet(f"{path}/table").orderBy("token").toPandas()
    shared = spark.sparkContext.broadcast((rows["token"].to_numpy(), rows["freq"].to_numpy()))
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["ids"].dataType.elementType
    id_kind = to_arrow_type(id_type)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable.from_shares(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                part, before, ids, lengths, block = (batch.column(k)[i].as_py() for k in range(5))
                plain = decode_block(block, table)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                bodies = [plain[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ids), type=pa.int32()),
                        pa.array(ids, type=id_kind),
                        pa.array(starts + before, type=pa.int64()),
                        pa.array(lengths, type=pa.int64()),
                        pa.array(bodies, type=pa.binary()),
                    ],
                    names=["part", "id", "start", "n_tokens", "ids"],
                )

    # Tokens before a block: earlier blocks of its part, and all earlier parts, of which there are
    # as many as tasks wrote.
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.select("part", "seq", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("inside"))
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    places = checkpoint(own.join(base, "part").select("part", "seq", (F.col("inside") + F.col("base")).alias("before")))
    placed = blocks.join(small_side(places, 20)[0], ["part", "seq"]).select("part", "before", "ids", "lengths", "block")
    schema = f"part int, id {id_type.simpleString()}, start long, n_tokens long, ids binary"
    return placed.mapInArrow(decode, schema).drop("part")


def encode_corpus(
    docs: DataFrame, tokenizer: str, path: str | None = None, id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """Write all documents and read them back: ``(id, start, n_tokens, ids_crc32)``.

    ``n_tokens`` counts the end id too. A null or empty text has the end id only; repeated rows
    are written as often as they come; an empty table gives empty files and no row.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer, id, text, **settings)
    return read_token_files(spark, path).select(F.col("id").alias(id), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
