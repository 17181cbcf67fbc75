"""Ranking, offset and aggregate windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import top_k
from .registry import register, rel, table

_BY = "over (partition by o_custkey order by o_orderdate, o_orderkey)"
_RUN = "over (partition by n_regionkey order by n_nationkey rows between unbounded preceding and current row)"


def _ranking(name: str, call: str, oracle: str, *args: object) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = getattr(rel(spark, sf_dir, "orders"), name)(*args, projected_columns="o_orderkey").dataframe.toDF("o_orderkey", "x")
        return out.withColumn("x", F.expr(call))

    run.__name__ = f"win_{name}"
    register(f"SELECT o_orderkey, {oracle} AS x FROM orders", f"win_{name}")(run)


_W = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
_ranking("row_number", "cast(x as bigint)", f"row_number() {_W}", _BY)
_ranking("rank", "cast(x as bigint)", "rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority)", "over (partition by o_custkey order by o_orderpriority)")
_ranking("dense_rank", "cast(x as bigint)", "dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority)", "over (partition by o_custkey order by o_orderpriority)")
_ranking("percent_rank", "round(x, 8)", f"round(percent_rank() {_W}, 8)", _BY)
_ranking("cume_dist", "round(x, 8)", f"round(cume_dist() {_W}, 8)", _BY)
_ranking("n_tile", "cast(x as bigint)", f"ntile(3) {_W}", _BY, 3)
_ranking("lag", "x", f"lag(o_totalprice, 1, -1.0) {_W}", "o_totalprice", _BY, 1, "-1.0D")
_ranking("lead", "x", f"lead(o_orderkey, 2) {_W}", "o_orderkey", _BY, 2)
_ranking("first_value", "x", f"first_value(o_orderkey) {_W}", "o_orderkey", _BY)
_ranking("last_value", "x", f"last_value(o_orderkey) {_W}", "o_orderkey", _BY)
_ranking("nth_value", "x", f"nth_value(o_orderkey, 2) {_W}", "o_orderkey", _BY, 2)


def _running(name: str, cast: str, oracle: str, **more: object) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = getattr(rel(spark, sf_dir, "nation"), name)("n_nationkey", window_spec=_RUN, projected_columns="n_nationkey", **more).dataframe.toDF("n_nationkey", "x")
        return out.withColumn("x", F.expr(cast))

    run.__name__ = f"win_{name}"
    w = "OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    register(f"SELECT n_nationkey, {oracle.replace('{w}', w)} AS x FROM nation", f"win_{name}")(run)


_running("sum", "cast(x as bigint)", "CAST(sum(n_nationkey) {w} AS BIGINT)")
_running("avg", "round(x, 8)", "round(avg(n_nationkey) {w}, 8)")
_running("min", "x", "min(n_nationkey) {w}")
_running("max", "x", "max(n_nationkey) {w}")
_running("count", "x", "count(n_nationkey) {w}")
_running("median", "round(x, 8)", "round(median(n_nationkey) {w}, 8)")
_running("quantile_cont", "round(x, 8)", "round(quantile_cont(n_nationkey, 0.3) {w}, 8)", q=0.3)
_running("quantile_disc", "cast(x as int)", "quantile_disc(n_nationkey, 0.3) {w}", q=0.3)
_running("list", "x", "list(n_nationkey) {w}")
_running("product", "x", "product(n_nationkey) {w}")
_running("stddev_pop", "round(x, 8)", "round(stddev_pop(n_nationkey) {w}, 8)")
_running("bit_or", "x", "bit_or(n_nationkey) {w}")
_running("string_agg", "x", "string_agg(n_nationkey, '+') {w}", sep="+")


@register("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY epoch_us(o_orderdate) RANGE BETWEEN 7776000000000 PRECEDING AND CURRENT ROW), 2) AS s FROM orders")
def win_range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("o_custkey").orderBy(F.unix_micros(F.col("o_orderdate").cast("timestamp"))).rangeBetween(-7776000000000, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("s"))


@register("SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n <= 3")
def win_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "part"), ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 3).select("p_brand", "p_partkey")


@register("SELECT n_nationkey, 1 AS x FROM nation")
def win_rank_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").rank("over ()", projected_columns="n_nationkey").dataframe.toDF("n_nationkey", "x")


@register("""SELECT n_nationkey, (SELECT v FROM (SELECT m.n_nationkey % 3 AS v, count(*) AS c, min(m.n_nationkey) AS f FROM nation m WHERE m.n_regionkey = n.n_regionkey AND m.n_nationkey <= n.n_nationkey GROUP BY 1)
    ORDER BY c DESC, f LIMIT 1) AS x FROM nation n""")
def win_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent value so far; of equally frequent ones the first seen."""
    return rel(spark, sf_dir, "nation").mode("n_nationkey % 3", window_spec=_RUN, projected_columns="n_nationkey").dataframe.toDF("n_nationkey", "x")
