"""Every named aggregate, grouped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as LF
from .registry import both, register, rel, table


def _by_flag(name: str, column: str, sql: str, cast: str = "", **more: object) -> None:
    """An aggregate of lineitem by return flag, through the relation's method of that name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = getattr(rel(spark, sf_dir, "lineitem"), name)(column, groups="l_returnflag", projected_columns="l_returnflag", **more).dataframe.toDF("l_returnflag", "x")
        return out.withColumn("x", F.expr(cast)) if cast else out

    run.__name__ = f"agg_{name}"
    register(f"SELECT l_returnflag, {sql} AS x FROM lineitem GROUP BY l_returnflag", f"agg_{name}")(run)


_by_flag("avg", "l_quantity", "round(avg(l_quantity), 6)", "round(x, 6)")
_by_flag("bit_and", "l_orderkey", "bit_and(l_orderkey)")
_by_flag("bit_or", "l_orderkey", "bit_or(l_orderkey)")
_by_flag("bit_xor", "l_orderkey", "bit_xor(l_orderkey)")
_by_flag("bool_and", "l_quantity > 0", "bool_and(l_quantity > 0)")
_by_flag("bool_or", "l_quantity > 49", "bool_or(l_quantity > 49)")
_by_flag("count", "l_tax", "count(l_tax)")
_by_flag("favg", "l_discount", "round(favg(l_discount), 6)", "round(x, 6)")
_by_flag("fsum", "l_extendedprice", "round(fsum(l_extendedprice), 2)", "round(x, 2)")
_by_flag("geomean", "l_quantity", "round(geomean(l_quantity), 6)", "round(x, 6)")
_by_flag("max", "l_extendedprice", "max(l_extendedprice)")
_by_flag("min", "l_shipdate", "min(l_shipdate)")
_by_flag("median", "l_quantity", "median(l_quantity)")
_by_flag("quantile_cont", "l_extendedprice", "round(quantile_cont(l_extendedprice, 0.3), 4)", "round(x, 4)", q=0.3)
_by_flag("quantile_disc", "l_extendedprice", "quantile_disc(l_extendedprice, 0.3)", q=0.3)
_by_flag("stddev_pop", "l_quantity", "round(stddev_pop(l_quantity), 6)", "round(x, 6)")
_by_flag("stddev_samp", "l_quantity", "round(stddev_samp(l_quantity), 6)", "round(x, 6)")
_by_flag("sum", "l_linenumber", "CAST(sum(l_linenumber) AS BIGINT)")
_by_flag("var_pop", "l_quantity", "round(var_pop(l_quantity), 5)", "round(x, 5)")
_by_flag("var_samp", "l_quantity", "round(var_samp(l_quantity), 5)", "round(x, 5)")


@register("SELECT p_brand, arg_max(p_partkey, p_retailprice * 1000000 + p_partkey) AS hi, arg_min(p_partkey, p_retailprice * 1000000 + p_partkey) AS lo FROM part GROUP BY p_brand")
def agg_arg_max_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = rel(spark, sf_dir, "part")
    key = "p_retailprice * 1000000 + p_partkey"
    hi = parts.arg_max("p_partkey", key, groups="p_brand", projected_columns="p_brand").dataframe.toDF("p_brand", "hi")
    lo = parts.arg_min("p_partkey", key, groups="p_brand", projected_columns="p_brand").dataframe.toDF("p_brand", "lo")
    return hi.join(lo, "p_brand")


@register("SELECT n_regionkey, CAST(bitstring_agg(n_nationkey, 0, 24) AS VARCHAR) AS x FROM nation GROUP BY n_regionkey")
def agg_bitstring_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").bitstring_agg("n_nationkey", min=0, max=24, groups="n_regionkey", projected_columns="n_regionkey").dataframe.toDF("n_regionkey", "x")


@register("""SELECT e.key AS k, CAST(e.value AS BIGINT) AS n FROM (SELECT unnest(map_entries(histogram(p_size))) AS e FROM part)""")
def agg_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = rel(spark, sf_dir, "part").histogram("p_size").dataframe.toDF("h")
    return h.select(F.explode("h").alias("k", "n")).select("k", F.col("n").cast("long").alias("n"))


@register("SELECT r_regionkey, list(n_name ORDER BY n_name) AS x FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey")
def agg_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rel(spark, sf_dir, "nation").list("n_name", groups="n_regionkey", projected_columns="n_regionkey").dataframe.toDF("r_regionkey", "x")
    return out.withColumn("x", F.array_sort("x"))


@register("SELECT n_regionkey, product(n_nationkey + 1) AS x FROM nation GROUP BY n_regionkey")
def agg_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "nation").product("n_nationkey + 1", groups="n_regionkey", projected_columns="n_regionkey").dataframe.toDF("n_regionkey", "x")


both(
    "agg_string_agg",
    "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS x FROM nation GROUP BY n_regionkey",
    "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS x FROM nation GROUP BY n_regionkey",
)


@register("SELECT p_brand, min(v) AS x FROM (SELECT p_brand, p_size AS v, count(*) AS n, max(count(*)) OVER (PARTITION BY p_brand) AS m FROM part GROUP BY p_brand, p_size) WHERE n = m GROUP BY p_brand")
def agg_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "part").mode("p_size", groups="p_brand", projected_columns="p_brand").dataframe.toDF("p_brand", "x")


@register("SELECT o_orderstatus, first(o_orderkey ORDER BY o_orderkey) AS f, last(o_orderkey ORDER BY o_orderkey) AS l FROM orders GROUP BY o_orderstatus")
def agg_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The methods ``first`` and ``last`` over a sorted frame, which fixes the order of rows."""
    over = "over (partition by o_orderstatus order by o_orderkey rows between unbounded preceding and unbounded following)"
    o = rel(spark, sf_dir, "orders").set_alias("o")
    f = o.first("o_orderkey", window_spec=over, projected_columns="o_orderstatus").dataframe.toDF("o_orderstatus", "f").distinct()
    last = o.last("o_orderkey", window_spec=over, projected_columns="o_orderstatus").dataframe.toDF("o_orderstatus", "l").distinct()
    return f.join(last, "o_orderstatus")


@register("SELECT count(DISTINCT l_suppkey) AS s, count(DISTINCT l_partkey) AS p, count(DISTINCT l_orderkey) FILTER (WHERE l_quantity > 25) AS o FROM lineitem")
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregation for each column: together they would multiply the rows by the columns."""
    li = table(spark, sf_dir, "lineitem")
    big = li.where("l_quantity > 25").agg(F.countDistinct("l_orderkey").alias("o"))
    return li.agg(F.countDistinct("l_suppkey").alias("s")).crossJoin(li.agg(F.countDistinct("l_partkey").alias("p"))).crossJoin(big)  # one row each


@register("""SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS c, round(covar_pop(l_quantity, l_extendedprice), 2) AS cp,
    round(covar_samp(l_quantity, l_extendedprice), 2) AS cs, round(skewness(l_extendedprice), 5) AS sk FROM lineitem GROUP BY l_returnflag""")
def agg_corr_covar_skewness(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, p = "l_quantity", "l_extendedprice"
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.corr(q, p), 6).alias("c"), F.round(F.covar_pop(q, p), 2).alias("cp"), F.round(F.covar_samp(q, p), 2).alias("cs"), F.round(LF.skewness(p), 5).alias("sk")
    )


@register("SELECT l_returnflag, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY l_returnflag")
def agg_approx_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a handful of values the estimate is exact."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_linenumber", 0.02).alias("n"))


@register("SELECT r AS n_regionkey, any_value(v) AS x FROM (SELECT n_regionkey AS r, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey * 10 END AS v FROM nation) GROUP BY r")
def agg_any_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value and NULLs in each group, so that only the NULLs may be passed over."""
    r = rel(spark, sf_dir, "nation").project("n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey * 10 END AS v")
    return r.any_value("v", groups="n_regionkey", projected_columns="n_regionkey").dataframe.toDF("n_regionkey", "x")
