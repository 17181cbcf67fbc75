"""All kinds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import asof_join, range_join, salted_join
from .registry import register, rel, table

def _kind(how: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = rel(spark, sf_dir, "customer").project("c_custkey, c_nationkey, c_acctbal").set_alias("c")
        o = rel(spark, sf_dir, "orders").project("o_orderkey, o_custkey, o_totalprice").set_alias("o")
        return c.join(o, "c.c_custkey = o.o_custkey AND c.c_acctbal > 0 AND o.o_totalprice > 150000", how=how).dataframe

    run.__name__ = f"join_{how}"
    register(sql, f"join_{how}")(run)


# customers in debt and small orders meet nothing, so both sides keep rows without a match
_C = "(SELECT c_custkey, c_nationkey, c_acctbal FROM customer) c"
_O = "(SELECT o_orderkey, o_custkey, o_totalprice FROM orders) o"
for _how, _text in (("inner", "JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN"), ("outer", "FULL JOIN"), ("semi", "SEMI JOIN"), ("anti", "ANTI JOIN")):
    _kind(_how, f"SELECT * FROM {_C} {_text} {_O} ON c_custkey = o_custkey AND c_acctbal > 0 AND o_totalprice > 150000")


@register("SELECT n_nationkey, n_name, s_suppkey FROM nation JOIN (SELECT s_nationkey AS n_nationkey, s_suppkey FROM supplier) USING (n_nationkey)")
def join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rel(spark, sf_dir, "supplier").project("s_nationkey AS n_nationkey, s_suppkey").set_alias("s")
    return rel(spark, sf_dir, "nation").join(s, ["n_nationkey"]).project("n_nationkey, n_name, s_suppkey").dataframe


@register("SELECT a.n_name AS x, b.n_name AS y FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_self_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = rel(spark, sf_dir, "nation").set_alias("a"), rel(spark, sf_dir, "nation").set_alias("b")
    return a.join(b, "a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey").dataframe.select(F.col("a.n_name").alias("x"), F.col("b.n_name").alias("y"))


@register("""SELECT r_name, count(*) AS n, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def join_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o, cu = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(cu, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count("*").alias("n"), F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).cast("double").alias("revenue"))


@register("""SELECT e.event_id, o.o_orderkey FROM events e ASOF LEFT JOIN (SELECT DISTINCT ON (k, o_orderdate) o_custkey % 50 AS k, o_orderdate, max(o_orderkey) OVER (PARTITION BY o_custkey % 50, o_orderdate) AS o_orderkey FROM orders) o
    ON e.user_id % 50 = o.k AND e.ts >= o.o_orderdate""")
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 50).alias("k"), F.col("ts").alias("at"))
    o = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("k"), F.col("o_orderdate").alias("at")).agg(F.max("o_orderkey").alias("o_orderkey"))
    return asof_join(e, o.select("at", "o_orderkey", "k"), on="at", by=["k"]).select("event_id", "o_orderkey")


@register("""SELECT p_partkey, b.name FROM part JOIN (VALUES (0.0, 1200.0, 'low'), (1000.0, 1500.0, 'mid'), (1400.0, 9999.0, 'high')) b(lo, hi, name) ON p_retailprice >= lo AND p_retailprice < hi""")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.createDataFrame([(0.0, 1200.0, "low"), (1000.0, 1500.0, "mid"), (1400.0, 9999.0, "high")], "lo double, hi double, name string")
    return range_join(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi", 500.0).select("p_partkey", "name")


@register("SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return salted_join(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), s, ["l_suppkey"], 4).select("l_orderkey", "l_linenumber", "s_name")
