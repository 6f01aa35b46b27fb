"""Benchmark decontamination by winnowing, in DataFrame functions only.

The fingerprint of a text is, for every run of ``SPAN - GRAM + 1`` word grams, the smallest
hash. A shared span of ``SPAN`` words or more holds such a run in both texts, so it shares a
fingerprint. Texts that share one are read again, and each hit is extended along its
alignment by comparing words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import checkpoint, column, content_key, free_name, let, lower_ascii, small_side

SPAN = 10
GRAM = 5
KEYS = ["k1", "k2"]


def _split_words(text: Column, breaks: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), breaks), "")


def clean_words(text: Column) -> Column:
    """Runs of 0-9, a-z (after lower-casing A-Z) and characters beyond ASCII."""
    return _split_words(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _raw_words(text: Column) -> Column:
    """The same words with their case as it is: cheaper, and enough for hashes that ignore case."""
    return _split_words(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _steps(count: Column) -> Column:
    """1 to ``count`` as an array, empty for less than one."""
    return F.when(count < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), count))


def _runs(values: Column, n: int, join: Callable[..., Column]) -> Column:
    """``join`` of every run of ``n`` neighbours."""
    heads = F.slice(values, 1, F.greatest(F.size(values) - (n - 1), F.lit(0)))
    return F.transform(heads, lambda v, i: join(v, *[F.get(values, i + k) for k in range(1, n)]))


def _grams(hashes: Column, n: int) -> Column:
    """The hash of every run of ``n`` words, from the hashes of the words."""
    return _runs(hashes, n, lambda *run: F.xxhash64(F.lit(n), *run))


def _lows(grams: Column, width: int) -> Column:
    """The smallest of every ``width`` neighbouring hashes."""
    return _runs(grams, width, lambda *run: F.least(*run)) if width > 1 else grams


def _word_hashes(words: Column) -> Column:
    # Lower-casing all letters makes more words equal than asked for; the extension compares exactly.
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _fingerprints(words: Column, span: int, gram: int, short: list[int]) -> Column:
    """The fingerprints of a text, with all grams of the ``short`` lengths."""

    def pick(hashes: Column) -> Column:
        kept = let(_grams(hashes, gram), lambda g: _lows(g, span - gram + 1))
        return F.concat(kept, *[_grams(hashes, n) for n in short]) if short else kept

    return let(_word_hashes(words), pick)


def _places(words: Column, lengths: list[int]) -> Column:
    """(hash, 1-based position) of every gram of the given lengths."""

    def of_length(hashes: Column, n: int) -> Column:
        return F.transform(_grams(hashes, n), lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at")))

    return let(_word_hashes(words), lambda hashes: F.concat(*[of_length(hashes, n) for n in lengths]))


def _items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """``(item, name, item_words)``: items by an internal key that no null id lacks; those without a word can't be hit."""
    named = benchmark.select(column(id).alias("name"), clean_words(column(text)).alias("item_words"))
    key = F.xxhash64(F.isnull("name"), F.col("name").cast("string"), "item_words").alias("item")
    return checkpoint(named.where(F.size("item_words") > 0).select(key, "name", "item_words").distinct())


def _item_prints(items: DataFrame, span: int, gram: int, short: list[int]) -> DataFrame:
    """(h, item, item_at): the fingerprints of the items with all their places."""
    parts = []
    long_items = items.where(F.size("item_words") >= span)
    kept = let(
        _word_hashes(F.col("item_words")),
        lambda hashes: let(
            _grams(hashes, gram),
            lambda g: let(
                _lows(g, span - gram + 1),
                lambda low: F.filter(
                    F.transform(g, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at"))),
                    lambda p: F.array_contains(low, p["h"]),
                ),
            ),
        ),
    )
    parts.append(long_items.select("item", F.explode(kept).alias("p")))
    for n in short:
        own = items.where(F.size("item_words") == n)
        parts.append(own.select("item", F.explode(_places(F.col("item_words"), [n])).alias("p")))
    made = parts[0]
    for part in parts[1:]:
        made = made.union(part)
    return checkpoint(made.select(F.col("p.h").alias("h"), "item", F.col("p.at").alias("item_at")))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> tuple[DataFrame, DataFrame]:
    """All documents as ``(*keep, k1, k2, n_words)``, and the hits of each text.

    The second table has ``(k1, k2, n_hit, n_items, items)``, one row for each different text with a hit: the
    words inside any occurrence of a window of ``span`` item words (or of a whole shorter item),
    the number of different items that occur and their sorted ids. All items without an id count
    as one, which the list leaves out. ``k1`` and ``k2`` identify the text, so copies
    are read once more at most once.
    """
    items = _items(benchmark, item_id, item_text)
    short = sorted(r[0] for r in items.where(F.size("item_words") < span).select(F.size("item_words")).distinct().collect())
    prints = _item_prints(items, span, gram, short)

    key = dict(zip(KEYS, content_key(column(text)), strict=True))
    wanted = checkpoint(prints.select("h").distinct().withColumn("shared", F.lit(True)))
    lookup, is_small = small_side(wanted, 16)
    read = docs.select(*[column(c) for c in keep], *[k.alias(n) for n, k in key.items()], _raw_words(column(text)).alias("words"))
    own = _fingerprints(F.col("words"), span, gram, short)
    # Repeated fingerprints cost less than finding them, unless rows must travel to the table.
    own = own if is_small else F.array_distinct(own)
    each = read.select(
        *[column(c) for c in [*keep, *KEYS]],
        F.size("words").cast("long").alias("n_words"),
        F.posexplode_outer(own).alias("place", "h"),
    )
    # A first row for every document, and those that share a fingerprint with an item.
    first = F.coalesce("place", F.lit(0)) == 0
    rows = checkpoint(
        each.join(lookup, "h", "left")
        .where(first | F.col("shared"))
        .select(*[column(c) for c in [*keep, *KEYS]], "n_words", first.alias("first"), F.col("shared").isNotNull().alias("shared"))
    )
    marked = rows.where("first").drop("first", "shared")
    suspects = checkpoint(rows.where("shared").select(*KEYS).distinct())

    # The words of the suspects, one row for each different text.
    texts = docs.select(*[k.alias(n) for n, k in key.items()], column(text).alias("body"))
    found = texts.join(small_side(suspects, 16)[0], KEYS, "left_semi").groupBy(*KEYS).agg(F.first("body").alias("body"))
    bodies = checkpoint(found.select(*KEYS, clean_words(F.col("body")).alias("words")))

    lengths = [gram, *short] if gram not in short else short
    places = bodies.select(*KEYS, F.explode(_places(F.col("words"), lengths)).alias("p"))
    lined = (
        places.select(*KEYS, F.col("p.h").alias("h"), F.col("p.at").alias("at"))
        .join(small_side(prints, 24)[0], "h")
        .select(*KEYS, "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    # A row per text and item with its alignments, so the words of a text travel once per item.
    aligned = lined.groupBy(*KEYS, "item").agg(F.collect_list("shift").alias("shifts"))
    paired = aligned.join(bodies, KEYS).join(items, "item")

    def reach(shift: Column) -> Column:
        """The text positions hit along one alignment: the extended runs that are long enough."""
        size = F.size("item_words")
        need = F.least(size, F.lit(span))
        first = F.greatest(F.lit(1), 1 - shift)
        last = F.least(size, F.size("words") - shift)
        length = last - first + 1
        same = F.array_join(
            F.zip_with(
                F.slice("item_words", first, F.greatest(length, F.lit(0))),
                F.slice("words", first + shift, F.greatest(length, F.lit(0))),
                lambda a, b: F.when(a == b, F.lit("1")).otherwise(F.lit("0")),
            ),
            "",
        )
        starts = let(
            same, lambda s: F.filter(_steps(length - need + 1), lambda i: F.substr(s, i, need) == F.repeat(F.lit("1"), need))
        )
        at = first + shift
        return F.flatten(F.transform(starts, lambda i: F.sequence(at + i - 1, at + i + need - 2)))

    positions = F.array_distinct(F.flatten(F.transform("shifts", reach)))
    hit = checkpoint(paired.select(*KEYS, "name", positions.alias("at")).where(F.size("at") > 0))
    covered = hit.select(*KEYS, F.explode("at").alias("at")).distinct().groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_hit"))
    items_hit = F.sort_array(F.collect_set(F.col("name").cast("string")))
    unnamed = F.max(F.isnull("name").cast("long"))
    named = hit.groupBy(*KEYS).agg(items_hit.alias("items"), unnamed.alias("unnamed"))
    named = named.select(*KEYS, (F.size("items") + F.col("unnamed")).alias("n_items"), "items")
    return marked, checkpoint(covered.join(named, KEYS))


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_words, n_hit, n_items, items, contaminated)``, one row per document.

    Null and empty texts have no words and no hit. Repeated rows get the same answer, a null
    id stays null. Items without words never occur; an empty benchmark hits nothing. Items
    with one id and different texts count as one item; items without an id count as one in
    ``n_hit``, ``n_items`` and ``contaminated`` and are left out of ``items`` only.
    """
    named = docs.select(column(id).alias("id"), column(text).alias("text"))
    marked, hits = overlaps(named, benchmark, ["id"])
    joined = marked.join(hits, KEYS, "left")
    return joined.select(
        F.col("id").alias(id),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents no benchmark window occurs in, with their columns as they are.

    A window of an item without an id counts as any other.
    """
    _, hits = overlaps(docs, benchmark, [], text)
    bad = hits.select(F.struct(*KEYS).alias(free_name("mark", docs.columns)))
    name = bad.columns[0]
    own = content_key(column(text))
    mark = F.struct(own[0].alias("k1"), own[1].alias("k2"))
    return docs.join(small_side(bad, 16)[0], mark == bad[name], "left_anti")
