"""Array arithmetic over the embedding column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.catalog import query, rounded
from tablegauge.functions import arrays
from tablegauge.functions.scalars import as_text
from tablegauge.sources import load_table

_E = "list_transform(embedding, lambda x: x::DOUBLE)"


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))


@query(
    "x5_x6_x7_array_literals",
    f"""SELECT vec_id, list_sum([1.0, 3.0, 5.0])::DOUBLE AS one_d, 20.0::DOUBLE AS two_d, 25 AS n_zeros, 8.0::DOUBLE AS n_ones,
       array_to_string(range(2, 15, 2), ',') AS evens FROM embeddings""",
)
def literals(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select(
        "vec_id",
        arrays.total(arrays.vector([1, 3, 5])).alias("one_d"),
        arrays.total(F.flatten(arrays.matrix([[1, 3, 5], [2, 4, 5]]))).alias("two_d"),
        F.size(F.flatten(arrays.zeros(5, 5))).alias("n_zeros"),
        arrays.total(F.flatten(arrays.ones(2, 4))).alias("n_ones"),
        F.array_join(as_text_array(arrays.value_range(2, 15, 2)), ",").alias("evens"),
    )


def as_text_array(col):
    return F.transform(col, lambda x: as_text(x))


@query(
    "x8_x9_x10_shape_element_section",
    f"""SELECT vec_id, len(embedding) AS width, round(embedding[3]::DOUBLE, 6) AS third,
       round(embedding[64]::DOUBLE, 6) AS last, len(embedding[5:6]) AS part_width,
       round(list_sum({_E}[5:6]), 6) AS part_sum FROM embeddings""",
)
def positions(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("e")
    part = arrays.section(e, 4, 6)
    return rounded(
        _vectors(spark, folder).select(
            "vec_id",
            arrays.shape(e)[0].cast("bigint").alias("width"),
            arrays.element(e, 2).alias("third"),
            arrays.element(e, -1).alias("last"),
            F.size(part).cast("bigint").alias("part_width"),
            arrays.total(part).alias("part_sum"),
        )
    )


@query(
    "x11_elementwise",
    f"""SELECT vec_id,
       round(list_sum(list_transform(list_zip({_E}[1:32], {_E}[33:64]), lambda p: p[1] + p[2])), 6) AS added,
       round(list_sum(list_transform(list_zip({_E}[1:32], {_E}[33:64]), lambda p: p[1] * p[2])), 6) AS multiplied
       FROM embeddings""",
)
def elementwise(spark: SparkSession, folder: str) -> DataFrame:
    a, b = arrays.section(F.col("e"), 0, 32), arrays.section(F.col("e"), 32, 64)
    return rounded(
        _vectors(spark, folder).select(
            "vec_id", arrays.total(arrays.add(a, b)).alias("added"), arrays.total(arrays.multiply(a, b)).alias("multiplied")
        )
    )


@query("x12_matrix_mean", f"SELECT vec_id, round(list_avg({_E}), 6) AS mean, round(list_avg({_E}), 6) AS nested FROM embeddings")
def matrix_mean(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.array(arrays.section(F.col("e"), 0, 32), arrays.section(F.col("e"), 32, 64))
    return rounded(
        _vectors(spark, folder).select(
            "vec_id", arrays.mean(F.col("e")).alias("mean"), arrays.matrix_mean(rows).alias("nested")
        )
    )


@query("x4_cast_to_text", "SELECT CAST(c_nationkey AS VARCHAR) AS value, count(*) AS n FROM customer GROUP BY 1")
def text(spark: SparkSession, folder: str) -> DataFrame:
    customers = load_table(spark, folder, "customer")
    return customers.groupBy(as_text(F.col("c_nationkey")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
