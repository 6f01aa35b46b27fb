from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablegauge import session


def fake(master, root=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: root or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_named_folder_is_used():
    path = session.scratch_path(fake("yarn", "hdfs://shared/steps/"), "step")
    assert path.startswith("hdfs://shared/steps/tablegauge-app-1/step-")


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.scratch_path(fake("yarn"), "step")


def test_local_session_chooses_one_folder():
    first, second = (session.scratch_path(fake("local[2]"), "step") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_checkpoint_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, array(1.5D) AS c UNION ALL SELECT 2, 'x', array()")
    again = session.checkpoint(df)
    assert again.dtypes == df.dtypes
    assert sorted(again.collect()) == sorted(df.collect(), key=lambda r: r.a)
    assert session.checkpoint_counting(df, F.col("a") > 1)[1] == 1


def test_only_small_frames_are_marked_for_broadcast(spark):
    df = spark.range(10)
    assert session.if_small(df, 9) is df
    assert session.if_small(df, 10) is not df
