"""The method choice reads the larger tables with all their numeric columns."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.mark.parametrize("table", ["customer", "part"])
def test_choice_reads_the_table(spark, table):
    rows = entry.queries()[f"j10_j13_cluster_choice_{table}s"](spark, FOLDER).collect()
    assert {(r["dataset"], r["method"]) for r in rows} == {(table, "kmeans"), (table, "dbscan")}
    assert all(r["best_model"] in ("KMeans", "DBSCAN") for r in rows)
