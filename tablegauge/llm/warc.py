"""WARC archives: pages written as records, records found again in byte ranges read in parallel.

The text between two magic lines is a segment; whatever follows a magic line may be a record
and says where the record after it would begin. A payload can hold the magic line too, so a
record is real only if a chain of such successors leads to it from the start of its file.
Tasks follow the chains inside their byte range; pointers that double their reach follow them
from range to range. Magic lines inside payloads are not on the chain and stay payload.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.llm.common import SLICE_BYTES, checkpoint, column, free_name, small_side
from tablegauge.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.0"
CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

# The line every record begins with; splitting at it leaves no "W" inside the separator, so
# a match that fails need not be tried again from its middle.
MAGIC = VERSION + CRLF

WRITTEN_AT = "1970-01-01T00:00:00Z"

# Bytes a revisit takes in a broadcast table: an id, a kind, a digest and some room.
REVISIT_BYTES = 256

# One segment between magic lines, as a task sees it. ``at`` counts from the start of the range.
SEGMENT = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("file_bytes", T.LongType()),
    T.StructField("at", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("next", T.LongType()),
    T.StructField("exit", T.LongType()),
    T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()),
    T.StructField("body", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("page_id", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("sound", T.BooleanType()),
])


# Writing


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32, 8 letters for every 40 bits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _quoted(text: Column, pattern: str) -> Column:
    """``text`` with every character of ``pattern`` as ``%`` and its code in two digits."""
    escape = lambda c: F.when(c.rlike(pattern), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c)
    return F.when(text.rlike(pattern), F.array_join(F.transform(F.split(text, ""), escape), "")).otherwise(text)


def _record_id(page: Column, digest: Column) -> Column:
    """A URN that depends on the page's id and payload only."""
    digits = F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("")), F.isnull(page).cast("string"), digest))
    pieces = [F.substring(digits, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def plan_records(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Which pages revisit others: ``(page_id, payload_sha256, response)``, one row for each pair of the first two.

    Of the pages with one payload of ``least_bytes`` or more, that of the largest id is the
    response. A null id counts as the smallest; rows that repeat both id and payload share
    their fate. Equal payloads are those of one SHA-256. A hot payload is summed up by tasks
    before it travels, and the join back can be split by the engine.
    """
    body = F.coalesce(column(payload).cast("binary"), F.lit(b""))
    keys = pages.select(column(page_id).alias("page_id"), F.sha2(body, 256).alias("sha"), F.octet_length(body).alias("n"))
    keys = checkpoint(keys.where(F.col("n") >= least_bytes).select("page_id", "sha").distinct())
    chosen = keys.groupBy("sha").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("ids"))
    chosen = chosen.where("ids > 1").select("sha", "response")
    found = keys.join(chosen, "sha").where(~F.col("page_id").eqNullSafe(F.col("response")))
    return checkpoint(found.select("page_id", F.col("sha").alias("payload_sha256"), "response"))


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    payload: str = "html",
    url: str = "url",
    least_bytes: int = 0,
    written_at: str = WRITTEN_AT,
) -> None:
    """Write one record per row of ``pages`` into archives below ``path``, one file per task.

    The payload is the column's bytes, UTF-8 for text (null: empty), as the body of an HTTP
    response. Pages that repeat a payload (see ``plan_records``) become revisit records without
    it. A null id or url leaves its header line out, an empty table writes no record; repeated rows give repeated
    records. Further columns are not written. The payload is written by the task that
    reads it; it is shuffled only where the table of revisits is too large to broadcast.
    """
    if url not in pages.columns:
        pages = pages.withColumn(free_name(url, pages.columns), F.lit(None).cast("string"))
    body = F.coalesce(column(payload).cast("binary"), F.lit(b""))
    rows = pages.select(column(page_id).alias("page_id"), column(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("sha", F.sha2("body", 256))
    revisits, _ = small_side(plan_records(pages, page_id, payload, least_bytes), REVISIT_BYTES)
    told = revisits.select(
        F.col("page_id").alias("twin_id"), F.col("payload_sha256").alias("twin_sha"), "response", F.lit(True).alias("again")
    )
    rows = rows.join(told, F.col("page_id").eqNullSafe(F.col("twin_id")) & (F.col("sha") == F.col("twin_sha")), "left")
    again = F.coalesce("again", F.lit(False))
    digest = base32_sha1(F.col("body"))
    rows = rows.select("page_id", "url", "body", "response", again.alias("again"), digest.alias("digest"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("body").cast("string"),
        F.lit(CRLF + CRLF),
    )
    quoted_id = _quoted(F.col("page_id").cast("string"), r"[\x00-\x20%<>\x7F]")
    block_bytes = F.octet_length(http) + F.when(F.col("again"), 0).otherwise(F.octet_length("body"))
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(written_at)),
        # The brackets of this version keep a header line from ending in a magic line.
        _line("WARC-Target-URI", F.concat(F.lit("<"), _quoted(F.col("url"), r"[\x00-\x20<>\x7F]"), F.lit(">"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(F.col("again"), _record_id(F.col("response"), F.col("digest")))),
        _line("WARC-Profile", F.when(F.col("again"), REVISIT_PROFILE)),
        _line("X-Page-ID", F.concat(F.lit("<"), quoted_id, F.lit(">"))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        block_bytes.cast("string"),
        F.lit(CRLF + CRLF),
    )
    content = F.when(F.col("again"), F.lit("")).otherwise(F.col("body").cast("string"))
    rows.select(F.concat(head, http, content).alias("value")).write.option("lineSep", CRLF + CRLF).text(path)


# Reading


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name."""
    lines = (line.partition(b":") for line in head.split(b"\r\n"))
    return {name.strip().lower().decode("latin-1"): value.strip().decode("utf-8", "replace") for name, _, value in lines}


def _in_brackets(value: str | None) -> str | None:
    return value[1:-1] if value is not None and value[:1] == "<" and value[-1:] == ">" else value


def http_payload(block: bytes) -> tuple[int, int | None]:
    """Where the payload of an HTTP block begins, and the length its header tells."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return 0, None
    told = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", block[:end], re.IGNORECASE)
    return end + 4, int(told[1]) if told else None


def _base32(digest: bytes) -> str:
    value = int.from_bytes(digest, "big")
    return "".join(BASE32[value >> 5 * i & 31] for i in reversed(range(len(digest) * 8 // 5)))


def parse_segment(segment: bytes) -> dict:
    """What the bytes after a magic line say, as far as they hold a record.

    ``span`` is the distance from there to the same place in the next record. The payload of a
    record that does not end with its segment is left for ``payloads``.
    """
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return {}
    fields = _fields(segment[:end])
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in fields:
        return {}
    body, length = end + 4, int(length)
    found = {
        "span": body + length + 4 + len(MAGIC),
        "body": body,
        "kind": fields["warc-type"],
        "record_id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "url": _in_brackets(fields.get("warc-target-uri")),
    }
    page = _in_brackets(fields.get("x-page-id"))
    found["page_id"] = None if page is None else unquote(page)
    told = fields.get("warc-payload-digest")
    block = segment[body : body + length]
    start, told_bytes = http_payload(block)
    if found["kind"] == "revisit":
        # Its payload is elsewhere; the header tells the size and digest.
        found |= {"payload_bytes": told_bytes, "payload_digest": (told or "").removeprefix("sha1:") or None, "sound": True}
    elif len(segment) == body + length + 4:
        digest = _base32(hashlib.sha1(block[start:]).digest())
        sound = told in (None, f"sha1:{digest}") and told_bytes in (None, length - start)
        found |= {"payload_bytes": length - start, "payload_digest": digest, "sound": sound}
    return found


def chain_numbers(at: list[int], after: list[int | None]) -> tuple[list[int | None], list[int], list[int]]:
    """For every place its way out of the range, and the bounds that tell the places on the way.

    ``after`` gives the successor of each of the ascending places ``at``. A place lies on the
    way from ``e`` if its ``low`` is at most that of ``e`` and its ``high`` at least.
    """
    index = {p: i for i, p in enumerate(at)}
    parent = [None if p is None else index.get(p) for p in after]
    size = [1] * len(at)
    for i, p in enumerate(parent):
        if p is not None:
            size[p] += size[i]
    out: list[int | None] = [None] * len(at)
    low, free, roots = [0] * len(at), [0] * len(at), 0
    for i in reversed(range(len(at))):
        p = parent[i]
        if p is None:
            out[i] = after[i]
            low[i], roots = roots, roots + size[i]
        else:
            out[i] = out[p]
            low[i] = free[p]
            free[p] += size[i]
        free[i] = low[i] + 1
    return out, low, [lo + n - 1 for lo, n in zip(low, size, strict=True)]


def _close_range(file: str, block: int, file_bytes: int, found: list[dict], used: int) -> pa.RecordBatch:
    """The rows of one byte range. A pointer that stays inside without meeting a segment leads nowhere."""
    for row in found:
        row["next"] = row["at"] + row.pop("span") if "span" in row else None
    places = [row["at"] for row in found]
    known = set(places)
    after = [n if n is not None and (n >= used or n in known) else None for n in (row["next"] for row in found)]
    for row, way, low, high in zip(found, *chain_numbers(places, after), strict=True):
        row |= {"file": file, "block": block, "file_bytes": file_bytes, "exit": way, "low": low, "high": high}
    columns = [pa.array([row.get(f.name) for row in found], type=_ARROW[type(f.dataType)]) for f in SEGMENT]
    return pa.RecordBatch.from_arrays(columns, names=SEGMENT.names)


_ARROW = {T.StringType: pa.string(), T.LongType: pa.int64(), T.BooleanType: pa.bool_()}


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], int, bytes, bool]]:
    """The segments of a task's ranges: file, range and file size, place, bytes, and whether a magic line precedes."""
    now, used = None, 0
    for batch in batches:
        ranges = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for here, value in zip(ranges, batch.column(3).cast(pa.binary()), strict=True):
            if here != now:
                now, used = here, 0
            segment = value.as_py()
            yield here, used, segment, here[1] > 0 or used > 0
            used += len(segment) + len(MAGIC)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, found, used = None, [], 0
    for here, at, segment, marked in _walk(batches):
        if here != now:
            if found:
                yield _close_range(*now, found, used)
            now, found = here, []
        # Before the first magic line of a file only its start is to be found.
        row = parse_segment(segment) if marked else {"span": len(MAGIC)} if not segment else {}
        found.append(row | {"at": at, "length": len(segment)})
        used = at + len(segment) + len(MAGIC)
    if found:
        yield _close_range(*now, found, used)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` cut at magic lines, with file and byte range, in order within a range."""
    raw = spark.read.schema("value string").option("lineSep", MAGIC).text(path)
    return raw.select("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size", "value")


def _bases(segments: DataFrame) -> DataFrame:
    """The place in its file at which each byte range's first segment begins; one row per range."""
    used = segments.groupBy("file", "block").agg(F.sum(F.col("length") + len(MAGIC)).alias("used"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return used.select("file", "block", F.coalesce(F.sum("used").over(before), F.lit(0)).alias("base"))


def _reachable_entries(nodes: DataFrame) -> DataFrame:
    """The nodes ``(file, at)`` on the chain from the place 0 of each file, by pointer jumping.

    A node's ``jump`` leads to the next range the chain enters. Every round adds the jump targets of what
    is reached and doubles the jumps, so rounds grow with the logarithm of the ranges of a file.
    """
    pointers = nodes.select("file", "at", "jump")
    reached = checkpoint(nodes.where("at = 0").select("file", "at"))
    known = reached.count()
    while True:
        onward = reached.join(pointers.where("jump IS NOT NULL"), ["file", "at"]).select("file", F.col("jump").alias("at"))
        reached = checkpoint(reached.union(onward).distinct())
        now = reached.count()
        if now == known:
            return reached.join(nodes.select("file", "at"), ["file", "at"], "left_semi")
        known = now
        further = pointers.select("file", F.col("at").alias("jump"), F.col("jump").alias("jump_on"))
        pointers = checkpoint(
            pointers.where("jump IS NOT NULL").join(further, ["file", "jump"]).select("file", "at", F.col("jump_on").alias("jump"))
        )


def find_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, one row for each, verified from the files' starts.

    Columns: ``file``, ``at`` (offset of the magic line), ``until`` (offset behind the record), ``kind``,
    ``record_id``, ``refers_to``, ``url``, ``page_id``, ``payload_bytes``, ``payload_digest``,
    and ``sound``: whether length and digest agree with the bytes; null where the payload
    holds magic lines, see ``payloads``. Raises ValueError if a chain ends before its file does. A folder without records
    gives no row, an empty file none.
    """
    segments = checkpoint(_scan(spark, path).mapInArrow(_segments, SEGMENT))
    bases = checkpoint(_bases(segments))
    placed = segments.join(bases, ["file", "block"])
    shifted = ("at", "next", "exit")
    nodes = placed.select("file", "block", "low", *[(F.col(c) + F.col("base")).alias(c) for c in shifted])
    targets = nodes.where("exit IS NOT NULL").select("file", F.col("exit").alias("at")).distinct()
    entered = nodes.join(targets, ["file", "at"], "left_semi").unionByName(nodes.where("at = 0"))
    entries = checkpoint(entered.select("file", "at", "block", "low", F.col("exit").alias("jump")).distinct())
    reached = _reachable_entries(entries).join(entries, ["file", "at"])
    ways = checkpoint(reached.select("file", "block", F.col("low").alias("entry"), F.col("jump")))
    _require_complete(segments, ways)
    on_the_way = F.col("entry").between(F.col("low"), F.col("high"))
    real = placed.join(ways.drop("jump"), ["file", "block"]).where(on_the_way).where("kind IS NOT NULL")
    # A place counts from the end of its magic line.
    return real.select(
        "file",
        (F.col("at") + F.col("base") - len(MAGIC)).alias("at"),
        (F.col("next") + F.col("base") - len(MAGIC)).alias("until"),
        (F.col("body") + len(MAGIC)).alias("body"),
        "kind", "record_id", "refers_to", "url", "page_id", "payload_bytes", "payload_digest", "sound",
    )


def _require_complete(segments: DataFrame, ways: DataFrame) -> None:
    """Every file with a byte has a chain that leaves at its end."""
    sizes = segments.where("block = 0 AND at = 0").select("file", F.col("file_bytes").alias("size")).distinct()
    ends = ways.select("file", (F.col("jump") - len(MAGIC)).alias("size"))
    broken = sizes.where("size > 0").join(ends, ["file", "size"], "left_anti").select("file").limit(3).collect()
    if broken:
        raise ValueError(f"the chain of records ends early in {', '.join(row['file'] for row in broken)}")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of every segment with their place."""
    kinds = [("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("segment", pa.binary())]
    held: list[tuple] = []
    size = 0
    for (file, block, _), at, segment, _ in _walk(batches):
        held.append((file, block, at, segment))
        size += len(segment) + 100
        if size > SLICE_BYTES:
            yield _batch(held, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, kinds)


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    values = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, type=k) for v, (_, k) in zip(values, kinds, strict=True)], names=[n for n, _ in kinds]
    )


def _joined(rows: pa.Table) -> pa.Table:
    """One record put together from its segments."""
    rows = rows.sort_by("place")
    record = MAGIC.encode() + MAGIC.encode().join(rows.column("segment").to_pylist())
    at, until, body = (rows.column(c)[0].as_py() for c in ("at", "until", "body"))
    block = record[body : until - at - 4]
    payload = block[http_payload(block)[0] :]
    return pa.table({
        "file": rows.column("file").slice(0, 1), "at": pa.array([at], type=pa.int64()), "payload": pa.array([payload], type=pa.binary())
    })


# Bytes of a file that share a key when segments look for their record.
STRIDE = 1 << 20


def payloads(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """The payloads of the given records that are not revisits, as ``(file, at, payload)``.

    ``records`` are rows of ``find_records``. The archives are read a second time. A record with magic lines in its
    payload is put together from its segments, so a task holds one record at a time.
    """
    pieces = _scan(spark, path).mapInArrow(_pieces, "file string, block long, at long, segment binary")
    lengths = _scan(spark, path).select(
        F.col("file_path").alias("file"), F.col("file_block_start").alias("block"), F.octet_length("value").alias("length")
    )
    bases = checkpoint(_bases(lengths))
    placed = pieces.join(bases, ["file", "block"]).select(
        "file", (F.col("at") + F.col("base") - len(MAGIC)).alias("place"), "segment"
    )
    # A record covers strides; a segment lies in the one it begins in.
    covered = F.sequence(F.floor(F.col("at") / STRIDE), F.floor((F.col("until") - 1) / STRIDE))
    wanted = records.where("kind <> 'revisit'").select("file", "at", "until", "body", F.explode(covered).alias("stride"))
    met = placed.withColumn("stride", F.floor(F.col("place") / STRIDE)).join(wanted, ["file", "stride"])
    met = met.where((F.col("place") >= F.col("at")) & (F.col("place") < F.col("until"))).drop("stride")
    return met.groupBy("file", "at").applyInArrow(_joined, "file string, at long, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``find_records`` with size and digest of every payload, also of those that hold magic lines."""
    records = checkpoint(find_records(spark, path))
    split = records.where("payload_bytes IS NULL AND kind <> 'revisit'")
    if split.isEmpty():
        return records
    body = payloads(spark, path, split).select(
        "file", "at", F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest")
    )
    filled = records.join(checkpoint(body), ["file", "at"], "left")
    return filled.withColumns({
        "payload_bytes": F.coalesce("payload_bytes", "n"), "payload_digest": F.coalesce("payload_digest", "digest")
    }).drop("n", "digest")


def round_trip(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Archive ``pages`` and tell per page what the archives hold, read back from them.

    Returns ``page_id`` in its own type, ``payload_bytes``, ``payload_digest`` (bare base32),
    ``record_type`` and ``refers_to``, the page a revisit points at. One row per row of
    ``pages``: null ids, null and empty payloads, repeated rows and an empty table included; see
    ``write_archives`` for what each becomes. A revisit finds its response by record id.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, page_id, payload, url)
    records = checkpoint(read_archives(spark, path))
    kind = pages.schema[page_id].dataType
    targets = records.where("kind = 'response'").groupBy(F.col("record_id").alias("refers_to"))
    targets = targets.agg(F.first("page_id").alias("target"))
    known = records.where("kind <> 'revisit'").select("*", F.lit(None).cast("string").alias("target"))
    again = records.where("kind = 'revisit'").join(targets, "refers_to", "left").select(*known.columns)
    return known.union(again).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.col("target").cast(kind).alias("refers_to"),
    )
