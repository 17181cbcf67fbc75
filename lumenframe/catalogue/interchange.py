"""Objects in and out: pandas, Arrow, numpy, values and Python functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import connection, register, rel


@register("SELECT r_regionkey, r_name FROM region")
def scan_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = rel(spark, sf_dir, "region").df()
    return connection(spark, sf_dir).from_df(frame).project("r_regionkey, r_name").dataframe


@register("SELECT n_nationkey, n_name FROM nation")
def scan_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).from_arrow(rel(spark, sf_dir, "nation").to_arrow_reader()).project("n_nationkey, n_name").dataframe


@register("SELECT CAST(n_nationkey AS INTEGER) AS a, CAST(n_regionkey AS INTEGER) AS b FROM nation")
def scan_numpy(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = rel(spark, sf_dir, "nation").project("n_nationkey AS a, n_regionkey AS b").fetchnumpy()
    return connection(spark, sf_dir).from_df(dict(arrays)).dataframe


@register("SELECT * FROM (VALUES (1, 'x'), (2, 'y')) t(col0, col1)")
def scan_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).values((1, "x"), (2, "y")).project("CAST(col0 AS INTEGER) AS col0, col1").dataframe


@register("SELECT CAST(i AS BIGINT) AS v FROM generate_series(1, 10) t(i)")
def scan_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).table_function("generate_series", [1, 10]).project("CAST(generate_series AS BIGINT) AS v").dataframe


@register("SELECT r_regionkey AS k FROM region WHERE false")
def scan_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).empty({"k": "INTEGER"}).dataframe


@register("SELECT p_partkey, p_size + 1 AS x FROM part")
def udf_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    con.create_function("plus_one", lambda x: x + 1, ["INTEGER"], "INTEGER")
    return con.sql("SELECT p_partkey, plus_one(p_size) AS x FROM part").dataframe


@register("SELECT p_partkey, p_size * 2 AS x FROM part")
def udf_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    import pyarrow.compute as pc

    con = connection(spark, sf_dir)
    con.create_function("twice", lambda x: pc.multiply(x, 2), ["INTEGER"], "INTEGER", type="arrow")
    return con.sql("SELECT p_partkey, twice(p_size) AS x FROM part").dataframe


@register("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE 0 END AS x FROM nation")
def udf_null_handling(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    con.create_function("none_as_zero", lambda x: 0 if x is None else x, ["INTEGER"], "INTEGER", null_handling="special")
    return con.sql("SELECT n_nationkey, none_as_zero(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END) AS x FROM nation").dataframe


@register("SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN NULL ELSE 100 // n_nationkey END AS x FROM nation")
def udf_exception_handling(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    con.create_function("hundredth", lambda x: 100 // x, ["INTEGER"], "INTEGER", exception_handling="return_null")
    return con.sql("SELECT n_nationkey, hundredth(n_nationkey) AS x FROM nation").dataframe
