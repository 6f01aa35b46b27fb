"""Every query with a SQL counterpart gives the same rows as DuckDB on the smallest tables."""

import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == columns
    places = [theirs.index(c) for c in columns]
    want = ordered([[r[p] for p in places] for r in cursor.fetchall()])
    assert ordered(df.select(*[f"`{c}`" for c in columns]).collect()) == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 11
