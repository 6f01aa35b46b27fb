"""From raw documents to token files: rules, near duplicates, benchmark passages, mix, ids."""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablegauge.llm import decontaminate, mixing, quality_rules, simhash, token_store  # noqa: E402
from tablegauge.session import checkpoint  # noqa: E402
from tablegauge.sources import load_table  # noqa: E402

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, load_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest id."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, load_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places and checksums, read back from the written token files."""
    return token_store.encode_corpus(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_ids),
]

# Fingerprints, learned rules and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
