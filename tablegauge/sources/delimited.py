"""Delimited text with a header row, typed the way a data-frame CSV reader types it."""

from __future__ import annotations

import codecs
import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.functions.scalars import column
from tablegauge.session import checkpoint
from tablegauge.sources import quoted

# The spellings of a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The spellings of a truth value.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# Encodings the engine reads itself, by their codec names.
NATIVE_ENCODINGS = ("utf-8", "ascii", "iso8859-1", "utf-16", "utf-16-be", "utf-16-le", "utf-32")

_INTEGER = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


_BEYOND = "_beyond_header"


class SourceError(ValueError):
    """The input cannot be read."""


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "utf-8",
    typed: bool = True,
    row_id: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a header-led text table.

    Short rows are filled up with gaps; a row with more fields than the header is an error.
    ``row_id`` names an extra bigint column that follows the order of the file; it is taken
    right after the scan, where the engine numbers rows split by split. ``multi_line``
    allows line breaks inside quotes; such files, and those in multi-byte encodings, are cut into
    records by range in parallel (see ``quoted``), and rows are numbered in file order.
    """
    try:
        native = codecs.lookup(encoding).name in NATIVE_ENCODINGS
    except LookupError as exc:
        raise SourceError(f"encoding '{encoding}' is not supported") from exc
    wide = codecs.lookup(encoding).name.startswith(("utf-16", "utf-32"))
    if (multi_line and not wide) or not (native or _is_single_byte(encoding)):
        raw, names = _read_records(spark, path, sep, encoding, row_id)
        return type_columns(raw, names) if typed else raw.drop(_BEYOND)
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding if native else "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    try:
        names = reader.csv(path).columns
    except AnalysisException as exc:
        raise SourceError(f"cannot read '{path}': {exc.getCondition()}") from exc
    if not names:
        raise SourceError("the input has no columns")
    # Fields beyond the header fall into one more column.
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BEYOND]])
    raw = reader.schema(schema).csv(path)
    if not native:
        raw = _from_single_byte(raw, encoding)
        names = raw.columns[:-1]
    if row_id:
        raw = raw.withColumn(row_id, F.monotonically_increasing_id())
    return type_columns(raw, names) if typed else raw.drop(_BEYOND)


def _read_records(spark: SparkSession, path: str, sep: str, encoding: str, row_id: str | None) -> tuple[DataFrame, list[str]]:
    """All rows as text columns, cut into records and split into fields in parallel."""
    try:
        rows = checkpoint(quoted.records(spark, path, sep, encoding))
    except AnalysisException as exc:
        raise SourceError(f"cannot read '{path}': {exc.getCondition()}") from exc
    except ValueError as exc:
        raise SourceError(str(exc)) from exc
    head = rows.where("header").orderBy("row").select("text").first()
    if head is None or not head["text"]:
        raise SourceError("the input has no columns")
    names = _header_names(next(csv.reader([head["text"]], delimiter=sep)))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BEYOND]])
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    fields = F.from_csv("text", _ddl(schema), options)
    parsed = rows.where(~F.col("header")).select("row", fields.alias("_fields"))
    kept = [F.col("_fields")[n].alias(n) for n in [*names, _BEYOND]]
    return parsed.select(*kept, *([F.col("row").alias(row_id)] if row_id else [])), names


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)


def _header_names(found: list[str]) -> list[str]:
    """Column names as the engine's own reader gives them: numbers for empty ones and behind repeated ones."""
    seen = [n.lower() for n in found if n]
    return [f"_c{i}" if not n else f"{n}{i}" if seen.count(n.lower()) > 1 else n for i, n in enumerate(found)]


def _is_single_byte(encoding: str) -> bool:
    try:
        return len(bytes(range(32, 127)).decode(encoding)) == 95 and len(bytes(range(128, 256)).decode(encoding, "replace")) == 128
    except (UnicodeDecodeError, LookupError):
        return False


def _from_single_byte(df: DataFrame, encoding: str) -> DataFrame:
    """Text read byte by byte as Latin-1, turned into the characters of ``encoding``."""
    pairs = []
    for byte in range(128, 256):
        try:
            pairs.append((chr(byte), bytes([byte]).decode(encoding)))
        except UnicodeDecodeError:
            continue
    if not pairs or any(len(c) != 1 for _, c in pairs):
        raise SourceError(f"encoding '{encoding}' is not supported")
    read, meant = ("".join(side) for side in zip(*pairs))
    names = [c.encode("latin-1").decode(encoding) for c in df.columns]
    return df.toDF(*names).withColumns({n: F.translate(column(n), read, meant) for n in names})


def type_columns(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Blank out the missing-value spellings and give each text column its type.

    One scan counts, per column, the values that would not parse; whole columns then
    become bigint, double or boolean, and stay text when neither fits. A column without
    values is double. Booleans with gaps stay text, because a plain data frame has no
    nullable truth value.
    """
    names = names or [c for c in df.columns if c != _BEYOND]
    values = {n: F.when(~column(n).isin(*NA_TOKENS), column(n)) for n in names}
    checks = []
    for i, n in enumerate(names):
        v = values[n]
        checks += [
            F.count(v).alias(f"n{i}"),
            F.count_if(v.isNotNull() & (~v.rlike(_INTEGER) | F.trim(v).try_cast("bigint").isNull())).alias(f"i{i}"),
            F.count_if(~v.rlike(_DECIMAL)).alias(f"d{i}"),
            F.count_if(~v.isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias(f"b{i}"),
        ]
    beyond = F.count(_BEYOND) if _BEYOND in df.columns else F.lit(0)
    seen = df.agg(F.count(F.lit(1)).alias("rows"), beyond.alias("beyond"), *checks).first()
    if seen["beyond"]:
        raise SourceError(f"{seen['beyond']} rows have more fields than the header")

    typed = {}
    for i, n in enumerate(names):
        v = values[n]
        filled, bad_int, bad_float, bad_bool = (seen[f"{k}{i}"] for k in "nidb")
        if filled and not bad_int:
            typed[n] = F.trim(v).try_cast("bigint")
        elif not bad_float:
            typed[n] = F.trim(v).try_cast("double")
        elif not bad_bool and filled == seen["rows"]:
            typed[n] = v.isin(*TRUE_TOKENS)
        else:
            typed[n] = v
    return df.withColumns(typed).drop(_BEYOND)
