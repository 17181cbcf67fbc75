"""Results on their way out of a relation, read back as rows."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession

from .registry import register, rel


@register("SELECT n_nationkey, n_name FROM nation")
def result_arrow_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = rel(spark, sf_dir, "nation").project("n_nationkey, n_name").to_arrow_reader(10)
    return spark.createDataFrame(reader.read_all())


@register("SELECT r_regionkey, r_name FROM region")
def result_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rel(spark, sf_dir, "region").project("r_regionkey, r_name")
    rows = [r.fetchone(), *r.fetchmany(2), *r.fetchall()]
    return spark.createDataFrame(rows, "r_regionkey int, r_name string")


@register("SELECT s_suppkey, s_name FROM supplier")
def result_frame_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rel(spark, sf_dir, "supplier").project("s_suppkey, s_name")
    frames = itertools.takewhile(len, (r.fetch_df_chunk() for _ in itertools.count()))
    return spark.createDataFrame([tuple(x) for f in frames for x in f.itertuples(index=False)], "s_suppkey long, s_name string")


@register("SELECT 25 AS n, 3 AS m")
def result_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, m = rel(spark, sf_dir, "nation").shape
    return spark.createDataFrame([(n, m)], "n int, m int")


@register("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
def result_executed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").aggregate("n_regionkey, count(*) AS n").execute().dataframe
