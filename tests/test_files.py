import pytest

from tablegauge.operators import profile
from tablegauge.plans import clusters, report
from tablegauge.sources import read_delimited
from tablegauge.sources.delimited import SourceError


def write(tmp_path, text, encoding="utf-8", name="t.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_types_follow_the_values(spark, tmp_path):
    path = write(
        tmp_path,
        "whole,gappy,real,odd,yes,maybe,day,none,huge,quoted\n"
        '1,NA,1.5,1,True,True,2024-01-02,,99999999999999999999,"a,b"\n'
        '2,7,n/a,x,False,None,2024-01-03,NaN,1,"say ""hi"""\n'
        "-3,null,1e3,3,TRUE,False,2024-01-04,<NA>,2,plain\n",
    )
    df = read_delimited(spark, path, row_id="row")
    types = dict(df.dtypes)
    assert types == {
        "whole": "bigint", "gappy": "bigint", "real": "double", "odd": "string", "yes": "boolean", "maybe": "string",
        "day": "string", "none": "double", "huge": "double", "quoted": "string", "row": "bigint",
    }
    rows = df.orderBy("row").collect()
    assert [r.whole for r in rows] == [1, 2, -3] and [r.gappy for r in rows] == [None, 7, None]
    assert [r.real for r in rows] == [1.5, None, 1000.0] and [r.maybe for r in rows] == ["True", None, "False"]
    assert [r.quoted for r in rows] == ["a,b", 'say "hi"', "plain"]
    labels = {r["name"]: r["dtype"] for r in profile.summarize(df.drop("row")).collect()}
    assert labels["gappy"] == "float64" and labels["day"] == "object" and labels["none"] == "float64"


def test_byte_order_mark_separator_and_encoding(spark, tmp_path):
    path = write(tmp_path, "﻿Имя;Число\nКазань;1\n")
    assert read_delimited(spark, path, sep=";").columns == ["Имя", "Число"]
    path = write(tmp_path, "Имя;Число\nКазань;1\n", "cp1251", "w.csv")
    assert read_delimited(spark, path, sep=";", encoding="windows-1251").first()["Имя"] == "Казань"


def test_short_and_long_rows(spark, tmp_path):
    df = read_delimited(spark, write(tmp_path, "a,b,c\n1,2\n3,4,5\n\n6\n"))
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, 2, None), (3, 4, 5), (6, None, None)]
    with pytest.raises(SourceError):
        read_delimited(spark, write(tmp_path, "a,b\n1,2,3\n", name="long.csv"))


def test_line_break_inside_quotes(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"x\ny"\n2,z\n')
    assert [r.b for r in read_delimited(spark, path, multi_line=True).orderBy("a").collect()] == ["x\ny", "z"]


def test_missing_file_is_a_user_error(spark, tmp_path):
    with pytest.raises(SourceError):
        read_delimited(spark, str(tmp_path / "absent.csv"))


def test_report_bundle(spark, tmp_path):
    lines = ["ID,Status,Group,Zero"] + [f"ID_{i},ACTIVE,{'AB'[i % 2]},0" for i in range(8)]
    path = write(tmp_path, "\n".join(lines) + "\n")
    df = read_delimited(spark, path, row_id="row")
    out = str(tmp_path / "out")
    flags = report.write_report(df.drop("row"), "t.csv", out).first()
    assert flags["quality_score"] == pytest.approx(1 - 0.2 - 0.15 - 0.05)
    text = "\n".join(r.value for r in spark.read.text(f"{out}/report").collect())
    want = report.digest(flags.asDict(), "t.csv", 8, 4, True, True, True)
    assert "\n".join(want) == text
    assert "- Оценка качества: **0.60**" in text and "- Макс. доля пропусков по колонке: **0.00%**" in text
    assert "- Константные колонки: Да. Список: ['Status', 'Zero']" in text
    assert "- Высокая кардинальность: Да. Список: ['ID']" in text
    top = spark.read.option("header", True).csv(f"{out}/top_categories")
    assert {r.column for r in top.select("column").distinct().collect()} == {"ID", "Status", "Group"}
    assert spark.read.option("header", True).csv(f"{out}/summary").count() == 4
    assert spark.read.option("header", True).csv(f"{out}/histograms").count() == 20


def test_report_texts_without_numbers_or_categories(spark):
    flags = {
        "has_constant_columns": False, "has_high_cardinality_categoricals": False, "quality_score": 0.694,
        "max_missing_share": 0.05556, "too_few_rows": True, "too_many_columns": False, "too_many_missing": False,
    }
    lines = report.digest(flags, "f.csv", 36, 14, False, False, False, "T", 3)
    assert lines[0] == "# T" and "- Top-K категорий: **3**" in lines
    assert "- Оценка качества: **0.69**" in lines and "- Макс. доля пропусков по колонке: **5.56%**" in lines
    assert report.NO_GAPS in lines and report.NO_CORRELATION in lines and report.NO_CATEGORIES in lines


def test_cluster_evaluation_artifacts(spark, tmp_path):
    rows = [(i, [float(i % 2) * 9 + (i % 5) / 10, float(i % 3) / 10]) for i in range(60)]
    points = spark.createDataFrame(rows, "id bigint, x array<double>")
    result = clusters.evaluate(points, "toy", range(2, 4), (0.3, 0.5), (3,), n_init=1)
    config = result.config.first()
    scores = result.k_scores.toPandas()
    assert config.n_clusters == scores.k[scores.silhouette.argmax()]
    assert config.selection_criterion == "silhouette_score"
    assert config.best_model in ("KMeans", "DBSCAN")
    assert result.metrics.count() == 2 and result.projection.count() == 60
    clusters.write_evaluation(result, str(tmp_path / "c"))
    labels = spark.read.option("header", True).csv(str(tmp_path / "c" / "labels"))
    assert labels.columns == ["sample_id", "cluster_label"] and labels.count() == 60


def test_no_density_clusters_falls_back(spark):
    points = spark.createDataFrame([(i, [float(i), float(i * i)]) for i in range(12)], "id bigint, x array<double>")
    result = clusters.evaluate(points, "toy", range(2, 3), (0.001,), (3,), n_init=1)
    rows = {r.method: r for r in result.metrics.collect()}
    assert (rows["dbscan"].silhouette, rows["dbscan"].davies_bouldin, rows["dbscan"].calinski_harabasz) == (-1.0, float("inf"), 0.0)
    assert result.config.first().best_model == "KMeans" and result.config.first().eps is None
