"""Functions by their DataFrame names that the other modules don't call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as S

from .. import functions as F
from .registry import register, table

c = S.col


@register("""SELECT p_partkey, p_size + 1 AS e, upper(p_brand) AS u, lower(p_name) AS lo, coalesce(nullif(p_size, 7), -1) AS nv, nullif(p_size, 7) IS NOT NULL AS nn, substr(p_name, 2, 3) AS su,
    regexp_matches(p_name, '^[a-m]') AS re, regexp_extract(p_name, '[aeiou][a-z]') AS rs, list_position(['red', 'tan', p_brand], p_brand)::INTEGER AS fs, decode(from_base64(base64(encode(p_name)))) AS ub, 'One Two' AS ic FROM part""")
def fn_more_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, size = c("p_name"), F.nullif(c("p_size"), S.lit(7))
    found = F.regexp_substr(n, S.lit("[aeiou][a-z]"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.expr("p_size + 1").alias("e"), F.ucase("p_brand").alias("u"), F.call_function("lower", n).alias("lo"), F.nvl(size, S.lit(-1)).alias("nv"), F.isnotnull(size).alias("nn"),
        F.substr(n, S.lit(2), S.lit(3)).alias("su"), F.regexp(n, S.lit("^[a-m]")).alias("re"), F.coalesce(found, S.lit("")).alias("rs"),
        F.find_in_set(c("p_brand"), F.concat(S.lit("red,tan,"), c("p_brand"))).alias("fs"), S.decode(F.unbase64(F.base64(F.encode(n, "UTF-8"))), "UTF-8").alias("ub"), F.initcap(S.lit("oNE two")).alias("ic"),
    )


@register("""SELECT c_custkey, abs(c_acctbal) AS a, CAST(ceil(c_acctbal) AS BIGINT) AS ce, round_even(c_acctbal, 1) AS b, sign(c_acctbal)::DOUBLE AS s, c_acctbal AS p, round(exp(1), 6) AS e,
    true AS r FROM customer""")
def fn_more_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = c("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.abs(b).alias("a"), F.ceiling(b).alias("ce"), F.bround(b, 1).alias("b"), F.signum(b).alias("s"), F.positive(b).alias("p"), F.round(F.e(), 6).alias("e"), (F.rand(3) < 1).alias("r")
    )


@register("""SELECT event_id, current_date = today() AS cd, current_date = today() AS c2, now() IS NOT NULL AS n, CAST(date_part('month', ts) AS INTEGER) AS dp, CAST(day(ts) AS INTEGER) AS dm, CAST(second(ts) AS INTEGER) AS s,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS ud FROM events""")
def fn_more_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = c("ts")
    text = S.date_format(t, "yyyy-MM-dd HH:mm:ss")
    same = (F.to_timestamp(text) == F.to_timestamp_ltz(text)) & (F.to_timestamp_ntz(text) == F.date_trunc("second", t).cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select(
        "event_id", (F.curdate() == F.current_date()).alias("cd"), (F.current_date() == S.current_date()).alias("c2"), F.now().isNotNull().alias("n"), F.datepart(S.lit("month"), t).cast("int").alias("dp"),
        F.dayofmonth(t).alias("dm"), F.second(t).cast("int").alias("s"), S.when(same, S.date_format(F.to_timestamp_ntz(text), "yyyy-MM-dd HH:mm:ss")).alias("t"), F.unix_date(t.cast("date")).cast("long").alias("ud"),
    )


@register("""SELECT n_nationkey, [0, n_nationkey, 2] AS pr, [n_nationkey, 9, 2] AS ins, list_sort(list_distinct([n_nationkey, 1, 2, 1, 7])) AS un, [n_nationkey, 2] AS co, [n_regionkey, n_regionkey] AS rp,
    n_nationkey AS z1, n_name AS z2, list_transform([n_nationkey, 2], lambda x: x + 1) AS tr, [n_nationkey, 2][1] AS g FROM nation""")
def fn_more_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("n_nationkey")
    pair = F.array(k, S.lit(2))
    zipped = F.arrays_zip(F.array(k).alias("a"), F.array(c("n_name")).alias("b"))[0]
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", F.array_prepend(pair, S.lit(0)).alias("pr"), F.array_insert(pair, 2, S.lit(9)).alias("ins"), F.array_sort(F.array_union(pair, F.array(S.lit(1), S.lit(1), S.lit(7)))).alias("un"),
        F.array_compact(F.array(k, S.lit(None), S.lit(2))).alias("co"), F.array_repeat(c("n_regionkey"), 2).alias("rp"), zipped["a"].alias("z1"), zipped["b"].alias("z2"),
        F.transform(pair, lambda x: x + 1).alias("tr"), F.get(pair, S.lit(0)).alias("g"),
    )


@register("""SELECT s, round(avg(x), 6) AS m, min(x) AS lo, median(x) AS md, round(product(x + 1), 3) AS p, round(stddev(x), 6) AS s1, round(stddev_samp(x), 6) AS s2, round(stddev_pop(x), 6) AS s3, round(stddev(x), 6) AS s4,
    round(var_pop(x), 6) AS v1, round(var_samp(x), 6) AS v2, round(variance(x), 6) AS v3, count(DISTINCT x) AS ac, count(DISTINCT x) AS ac2, CAST(len(list(x)) AS INTEGER) AS l
    FROM (SELECT n_regionkey AS s, CAST(nullif(n_nationkey % 4, 1) AS DOUBLE) AS x FROM nation) GROUP BY s""")
def fn_more_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lambda e, n=6: F.round(e, n)
    x = c("x")
    src = table(spark, sf_dir, "nation").select(c("n_regionkey").alias("s"), F.nullif(c("n_nationkey") % 4, S.lit(1)).cast("double").alias("x"))
    # few values, for which the estimate of distinct ones is exact; the list has its NULLs
    return src.groupBy("s").agg(
        r(F.mean(x)).alias("m"), F.min(x).alias("lo"), F.median(x).alias("md"), r(F.product(x + 1), 3).alias("p"), r(F.stddev(x)).alias("s1"), r(F.stddev_samp(x)).alias("s2"), r(F.stddev_pop(x)).alias("s3"), r(F.std(x)).alias("s4"),
        r(F.var_pop(x)).alias("v1"), r(F.var_samp(x)).alias("v2"), r(F.variance(x)).alias("v3"), F.approx_count_distinct(x).alias("ac"), F.approxCountDistinct(x).alias("ac2"), S.size(F.array_agg(x)).alias("l"),
    )


@register("""SELECT g, any_value(v) AS a, any_value(v) AS f, any_value(v) AS l, mode(v) AS m FROM (SELECT n_regionkey AS g, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey * 10 END AS v FROM nation) GROUP BY g""")
def fn_any_first_last_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value and NULLs in a group: which one counts doesn't depend on the order of rows."""
    src = table(spark, sf_dir, "nation").select(c("n_regionkey").alias("g"), S.when(c("n_nationkey") % 2 == 0, c("n_regionkey") * 10).alias("v"))
    return src.groupBy("g").agg(F.any_value("v").alias("a"), F.first("v", ignorenulls=True).alias("f"), F.last("v", ignorenulls=True).alias("l"), F.mode("v").alias("m"))


@register("SELECT o_orderkey, r_name FROM orders JOIN (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON o_custkey = c_custkey")
def fn_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions are of a fixed small size, so they may be sent to every task."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    small = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cu = table(spark, sf_dir, "customer")
    cu = cu.join(F.broadcast(small), cu.c_nationkey == small.n_nationkey).select("c_custkey", "r_name")
    o = table(spark, sf_dir, "orders")
    return o.join(cu, o.o_custkey == cu.c_custkey).select("o_orderkey", "r_name")


@register("SELECT n_regionkey, map_keys(histogram(n_nationkey % 3)) AS k, CAST(map_values(histogram(n_nationkey % 3)) AS BIGINT[]) AS v, round(exp(avg(ln(n_nationkey + 1))), 6) AS g FROM nation GROUP BY n_regionkey")
def fn_histogram_geomean(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.histogram(c("n_nationkey") % 3)
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(S.map_keys(h).alias("k"), S.map_values(h).alias("v"), F.round(F.geomean(c("n_nationkey") + 1), 6).alias("g"))
