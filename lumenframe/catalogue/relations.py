"""Operators of the relation object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..expressions import ColumnExpression, ConstantExpression, StarExpression
from .registry import register, rel


@register("SELECT p_partkey, upper(p_name) AS name, p_retailprice * 2 AS twice FROM part")
def rel_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "part").project("p_partkey, upper(p_name) AS name, p_retailprice * 2 AS twice").dataframe


@register("SELECT p_name, p_brand, p_type FROM part")
def rel_select_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "part").select_types(["VARCHAR"]).dataframe


@register("SELECT o_totalprice FROM orders")
def rel_getitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "orders")["o_totalprice"].dataframe


@register("SELECT * FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'")
def rel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").filter("c_acctbal > 5000 AND c_mktsegment = 'BUILDING'").dataframe


@register("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def rel_order_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").project("c_custkey, c_acctbal").order("c_acctbal DESC, c_custkey").limit(20).dataframe


@register("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 10 OFFSET 5")
def rel_limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "supplier").project("s_suppkey, s_name").order("s_suppkey").limit(10, offset=5).dataframe


@register("SELECT n_nationkey, n_name FROM nation ORDER BY n_regionkey DESC, n_name LIMIT 12")
def rel_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = rel(spark, sf_dir, "nation").sort(ColumnExpression("n_regionkey").desc().nulls_last(), ColumnExpression("n_name").asc())
    return ordered.limit(12).project("n_nationkey, n_name").dataframe


@register("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def rel_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "lineitem").project("l_returnflag, l_linestatus").distinct().dataframe


@register("SELECT DISTINCT event_type FROM events")
def rel_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "events").unique("event_type").dataframe


@register("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def rel_aggregate_implicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "orders").aggregate("o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total").dataframe


@register("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def rel_aggregate_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "orders").aggregate("o_orderpriority, o_orderstatus, count(*) AS n", "CUBE (o_orderpriority, o_orderstatus)").dataframe


@register("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")
def rel_aggregate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "orders").aggregate("o_orderpriority, o_orderstatus, count(*) AS n", "ROLLUP (o_orderpriority, o_orderstatus)").dataframe


@register("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def rel_aggregate_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "lineitem").aggregate("l_returnflag, l_linestatus, count(*) AS n", "GROUPING SETS ((l_returnflag), (l_linestatus), ())").dataframe


@register("SELECT max(l_quantity) AS m, max(l_tax) AS t FROM lineitem")
def rel_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "lineitem").apply("max", "l_quantity, l_tax").dataframe.toDF("m", "t")


@register("SELECT p_size, count(p_size) AS n FROM part GROUP BY p_size")
def rel_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "part").value_counts("p_size").dataframe.toDF("p_size", "n")


@register("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def rel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").join(rel(spark, sf_dir, "region"), "n_regionkey = r_regionkey").project("n_name, r_name").dataframe


@register("SELECT r_name, n_name FROM region CROSS JOIN nation")
def rel_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "region").cross(rel(spark, sf_dir, "nation").set_alias("n")).project("r_name, n_name").dataframe


@register("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def rel_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").project("c_nationkey AS k").union(rel(spark, sf_dir, "supplier").project("s_nationkey")).dataframe


@register("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def rel_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").project("c_nationkey AS k").except_(rel(spark, sf_dir, "supplier").project("s_nationkey")).dataframe


@register("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def rel_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").project("c_nationkey AS k").intersect(rel(spark, sf_dir, "supplier").project("s_nationkey")).dataframe


@register("SELECT event_type, count(*) AS n FROM events GROUP BY event_type HAVING count(*) > 1")
def rel_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "events").query("seen", "SELECT event_type, count(*) AS n FROM seen GROUP BY event_type HAVING count(*) > 1").dataframe


@register("SELECT p_partkey, p_size * 3 AS thrice FROM part")
def rel_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "part").project("p_partkey, p_size").map(
        lambda d: d.assign(thrice=d.p_size * 3)[["p_partkey", "thrice"]], schema={"p_partkey": "BIGINT", "thrice": "INTEGER"}
    ).dataframe


@register("""SELECT 'count' AS aggr, count(p_size)::DOUBLE AS size, count(p_name)::VARCHAR AS name FROM part UNION ALL SELECT 'mean', round(avg(p_size), 6), NULL FROM part
    UNION ALL SELECT 'stddev', round(stddev_samp(p_size), 6), NULL FROM part UNION ALL SELECT 'min', min(p_size), min(p_name) FROM part
    UNION ALL SELECT 'max', max(p_size), max(p_name) FROM part UNION ALL SELECT 'median', median(p_size), NULL FROM part""")
def rel_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = rel(spark, sf_dir, "part").project("p_size, p_name").describe()
    return shown.project("aggr, round(CAST(p_size AS DOUBLE), 6) AS size, p_name AS name").dataframe


@register("SELECT n_nationkey, n_regionkey, 1 AS one FROM nation")
def rel_star_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").select(StarExpression(exclude=["n_name"]), ConstantExpression(1).alias("one")).dataframe
