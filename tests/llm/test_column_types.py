"""Ids, sources and further columns of other types than the given tables have."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablegauge.llm import mixing, simhash, token_store

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("kind,ids", [("string", ["b", "a", None, "é"]), ("date", None), ("decimal(20,2)", None), ("int", [3, 1, None, 2])])
def test_token_files_carry_ids_of_any_type(spark, kind, ids):
    texts = ["one two", "three", None, "four  five six"]
    if ids is None:
        ids = [r.v for r in spark.sql(
            "SELECT cast(v AS date) v FROM VALUES ('2024-01-03'), ('2024-01-01'), (NULL), ('2024-01-02') AS t(v)" if kind == "date"
            else "SELECT cast(v AS decimal(20,2)) v FROM VALUES (3.25), (1.5), (NULL), (2.0) AS t(v)").collect()]
    docs = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string")
    got = {r.doc_id: r for r in token_store.encode_corpus(docs, TOKENIZER).collect()}
    plain = Tokenizer.from_file(TOKENIZER)
    start = 0
    for i in [*sorted(x for x in ids if x is not None), None]:
        tokens = plain.encode(texts[ids.index(i)] or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(tokens, dtype="<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(tokens), crc)
        start += len(tokens)


@pytest.mark.parametrize("kind", ["int", "string", "boolean", "double"])
def test_sources_of_any_type(spark, kind):
    values = {"int": [10, 9, None], "string": ["a", "-", None], "boolean": [False, True, None], "double": [0.5, 2.0, None]}[kind]
    rows = [(i, " ".join(["w"] * (1 + i % 7)), values[i % 3]) for i in range(200)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source {kind}")
    got = mixing.mix(docs).collect()
    assert len(got) == 200 and dict(docs.dtypes) == dict(mixing.mixed(docs).dtypes)
    taken = {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        assert abs(r.target - taken[r.source]) >= 0
    targets = {r.source: r.target for r in got}
    assert set(taken) == set(values)
    for s in values:
        assert abs(taken[s] - targets[s]) <= 1


def test_one_of_each_group_with_map_columns(spark):
    docs = spark.sql(
        """SELECT * FROM VALUES (1, 'a b c d', map('k', 1)), (1, 'a b c d', map('k', 1)), (2, 'a b c d', map('k', 2)),
        (3, 'x y z w', CAST(NULL AS map<string, int>)), (3, 'x y z w', CAST(NULL AS map<string, int>)) AS t(doc_id, text, first)"""
    )
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.first) for r in got.collect()) == [(1, {"k": 1}), (3, None)]
