"""Files and tables written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..relation import Relation
from ..sources import readers
from .registry import connection, register, rel

_FOLDERS: dict[str, str] = {}


def _place(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share, else in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/lumenframe-{name}-{uuid.uuid4().hex}"


@register("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "parquet")
    rel(spark, sf_dir, "customer").project("c_custkey, c_name, c_mktsegment").to_parquet(path, compression="zstd", partition_by=["c_mktsegment"], overwrite=True)
    return readers.read_parquet(spark, path, hive_partitioning=True).select("c_custkey", "c_name", "c_mktsegment")


@register("SELECT p_partkey, p_name, p_size FROM part")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "csv")
    rel(spark, sf_dir, "part").project("p_partkey, p_name, p_size").to_csv(path, sep="|", header=True, overwrite=True)
    return readers.read_csv(spark, path, sep="|", header=True, columns={"p_partkey": "BIGINT", "p_name": "VARCHAR", "p_size": "INTEGER"})


@register("SELECT s_suppkey, s_name FROM supplier")
def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "json")
    rel(spark, sf_dir, "supplier").project("s_suppkey, s_name").to_json(path, overwrite=True)
    return readers.read_json(spark, path, columns={"s_suppkey": "BIGINT", "s_name": "VARCHAR"})


@register("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3")
def sink_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _place(spark, "copy")
    con = connection(spark, sf_dir)
    con.execute(f"COPY (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3) TO '{path}' (FORMAT parquet)")
    return con.read_parquet(path).dataframe


@register("SELECT r_regionkey, r_name FROM region UNION ALL SELECT 99, 'NOWHERE'")
def sink_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    con, name = connection(spark, sf_dir), f"lumenframe_{uuid.uuid4().hex}"
    rel(spark, sf_dir, "region").project("r_regionkey, r_name").create(name)
    con.table(name).insert([99, "NOWHERE"])
    out = con.table(name).dataframe
    return out


@register("SELECT r_regionkey, CASE WHEN r_regionkey = 1 THEN 'changed' ELSE r_name END AS r_name FROM region WHERE r_regionkey <> 4")
def sink_update_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    con, name = connection(spark, sf_dir), f"lumenframe_{uuid.uuid4().hex}"
    rel(spark, sf_dir, "region").project("r_regionkey, r_name").create(name)
    con.execute(f"UPDATE {name} SET r_name = 'changed' WHERE r_regionkey = 1")
    con.execute(f"DELETE FROM {name} WHERE r_regionkey = 4")
    return con.table(name).dataframe


@register("SELECT r_name, count(*) OVER () AS n FROM region")
def sink_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = rel(spark, sf_dir, "region").create_view("regions_seen")
    return view.query("v", "SELECT r_name, count(*) OVER () AS n FROM v").dataframe


@register("SELECT n_nationkey, file_row_number AS r FROM (SELECT n_nationkey, row_number() OVER () - 1 AS file_row_number FROM nation)")
def scan_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by their place in the file, which holds them in the order of their key."""
    df = readers.read_parquet(spark, f"{sf_dir}/nation.parquet", file_row_number=True, filename=True)
    return Relation(df).filter("ends_with(filename, 'nation.parquet')").project("n_nationkey, file_row_number AS r").dataframe
