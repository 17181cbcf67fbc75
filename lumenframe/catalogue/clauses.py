"""SQL of the relational dialect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import both, connection, register

both("sql_filter_clause", "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, count(*) AS n FROM lineitem GROUP BY l_returnflag")
both("sql_group_by_all", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
both("sql_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 12")
both("sql_from_first", "FROM region")
both("sql_exclude", "SELECT * EXCLUDE (n_name) FROM nation")
both("sql_cte", "WITH a AS (SELECT n_regionkey AS r, count(*) AS n FROM nation GROUP BY 1), b AS (SELECT max(n) AS m FROM a) SELECT r, n FROM a WHERE n >= (SELECT m FROM b)")
both("sql_recursive", "WITH RECURSIVE t(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 12) SELECT n, f FROM t")
both("sql_scalar_subquery", "SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
both("sql_exists", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
both("sql_in_subquery", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
both("sql_alias_in_where", "SELECT p_partkey, p_size * 2 AS twice FROM part WHERE twice < 20")
both("sql_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
both("sql_distinct_from", "SELECT p_partkey FROM part WHERE nullif(p_size, 5) IS DISTINCT FROM 7")
both("sql_cast_operator", "SELECT p_partkey::VARCHAR AS k, p_retailprice::INTEGER8 AS p FROM part".replace("INTEGER8", "BIGINT"), "SELECT p_partkey::VARCHAR AS k, trunc(p_retailprice)::BIGINT AS p FROM part")
both("sql_values", "SELECT * FROM (VALUES (1, 'a'), (2, 'b')) t(x, y)")
both("sql_qualify", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
both("sql_pivot", "PIVOT (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM orders) ON o_orderstatus IN ('F', 'O', 'P') USING count(o_orderkey) GROUP BY o_orderpriority")
both("sql_unpivot", "UNPIVOT (SELECT n_nationkey, CAST(n_regionkey AS BIGINT) AS a, CAST(n_nationkey * 2 AS BIGINT) AS b FROM nation) ON a, b INTO NAME n VALUE v")
both("sql_limit_offset", "SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 7 OFFSET 3")
both("sql_order_by_all", "SELECT r_name, r_regionkey FROM region ORDER BY ALL")
both("sql_between_like", "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20 AND p_name LIKE '%e%'")
both("sql_window_clause", "SELECT o_orderkey, rank() OVER w AS r FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice)")
both("sql_grouping_id", "SELECT o_orderstatus, grouping(o_orderstatus) AS g, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus)", "SELECT o_orderstatus, CAST(grouping(o_orderstatus) AS TINYINT) AS g, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus)")
both("sql_lateral_alias", "SELECT p_size * 2 AS a, a + 1 AS b, p_partkey FROM part")
both(
    "sql_lateral_join",
    "SELECT n_name, t.s_suppkey FROM nation, LATERAL (SELECT s_suppkey FROM supplier WHERE s_nationkey = n_nationkey ORDER BY s_suppkey LIMIT 1) t",
)
both("sql_unnest", "SELECT r_regionkey, unnest([1, 2, 3]) AS v FROM region")
both("sql_range", "SELECT range AS i FROM range(10)")


@register("SELECT o_orderkey FROM orders WHERE o_custkey = 7 OR o_totalprice > 400000")
def sql_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    return con.sql("SELECT o_orderkey FROM orders WHERE o_custkey = $1 OR o_totalprice > $2", params=[7, 400000]).dataframe


@register("SELECT o_orderkey FROM orders WHERE o_custkey = 11")
def sql_named_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql("SELECT o_orderkey FROM orders WHERE o_custkey = $key", params={"key": 11}).dataframe


@register("SELECT r_regionkey, r_name FROM region")
def sql_file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql(f"SELECT r_regionkey, r_name FROM '{sf_dir}/region.parquet'").dataframe


@register("SELECT 2 AS x")
def sql_multi_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql("SELECT 1 AS x; SELECT 2 AS x;").dataframe


@register("SELECT n_name FROM nation WHERE n_regionkey = 2")
def sql_replacement_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    asian = con.sql("SELECT * FROM nation WHERE n_regionkey = 2")  # noqa: F841  named in the query
    return con.sql("SELECT n_name FROM asian").dataframe
