"""The corpus queries, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import Query
from tablegauge.llm import (
    collocations,
    context_tree,
    decontaminate,
    html_text,
    line_dedup,
    mixing,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    spelling,
    token_store,
    warc,
)
from tablegauge.sources import load_table

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op1_simhash_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, folder, "documents"))


@query("op4_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.encode_corpus(load_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query("op7_quality_rules")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents")
    rules = quality_rules.fit(docs, load_table(spark, folder, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op8_benchmark_decontamination",
    rf"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
      b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
      bw AS (SELECT item_id, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i, ws
        FROM b WHERE len(ws) > 0),
      bg AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM bw),
      dw AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM d, (SELECT DISTINCT n FROM bg)),
      dg AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM dw),
      h AS MATERIALIZED (SELECT doc_id, dg.n, i, item_id FROM dg JOIN bg ON dg.gram = bg.gram AND dg.n = bg.n),
      c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
      t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
)
def contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = load_table(spark, folder, "documents"), load_table(spark, folder, "benchmark")
    found = decontaminate.contamination(docs, benchmark)
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op9_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, carry=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op3_secret_scan")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(load_table(spark, folder, "documents"))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


@query("op6_sampled_splitters")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign(load_table(spark, folder, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op10_context_tree_scores")
def scores(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.score(load_table(spark, folder, "documents"))


@query("op2_html_text")
def html_pages(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(load_table(spark, folder, "pages"))


@query("op5_fuzzy_line_dedup")
def fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(load_table(spark, folder, "documents"))


@query(
    "op11_warc_round_trip",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
      s AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes,
      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(x, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)),
        'string_agg', '') AS payload_digest,
      CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> top THEN top END AS refers_to
    FROM s""",
)
def archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(load_table(spark, folder, "pages"))


@query("op12_spelling_variants")
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(load_table(spark, folder, "documents"))


@query("op13_phrase_collocations")
def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(load_table(spark, folder, "documents"))
