"""Reports over the star schema, and grouped shapes of a known benchmark for data frames."""

from __future__ import annotations

from .registry import both

both(
    "report_shipping_priority",
    """SELECT l_orderkey, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue, o_orderdate FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderdate < DATE '1996-01-01' AND l_shipdate > DATE '1996-01-01' GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10""",
)
both(
    "report_local_supplier",
    """SELECT n_name, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    AND s_nationkey = c_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""",
)
both("report_forecast", "SELECT CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM lineitem WHERE l_discount BETWEEN 0.02 AND 0.08 AND l_quantity < 24")
both(
    "report_large_orders",
    """SELECT c_name, o_orderkey, round(sum(l_quantity), 2) AS q FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200) GROUP BY c_name, o_orderkey""",
)
both(
    "report_customer_distribution",
    "SELECT n, count(*) AS customers FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '1-URGENT' GROUP BY c_custkey) x GROUP BY n",
)
both(
    "report_promotion",
    "SELECT round(100.0 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) / sum(l_extendedprice * (1 - l_discount)), 4) AS share FROM lineitem JOIN part ON l_partkey = p_partkey",
)
both(
    "report_top_supplier",
    """WITH r AS (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS total FROM lineitem GROUP BY l_suppkey) SELECT s_suppkey, s_name, total FROM supplier JOIN r ON s_suppkey = k
    WHERE total = (SELECT max(total) FROM r)""",
)
both(
    "report_order_priority",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 30) GROUP BY o_orderpriority",
)
both(
    "report_nation_volume",
    """SELECT a.n_name AS sn, b.n_name AS cn, year(l_shipdate) AS y, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS v FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON c_nationkey = b.n_nationkey WHERE a.n_regionkey = 0 AND b.n_regionkey = 1 GROUP BY a.n_name, b.n_name, year(l_shipdate)""",
    """SELECT a.n_name AS sn, b.n_name AS cn, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS v FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON c_nationkey = b.n_nationkey WHERE a.n_regionkey = 0 AND b.n_regionkey = 1 GROUP BY a.n_name, b.n_name, year(l_shipdate)""",
)
both("group_sum_by_one", "SELECT l_suppkey, round(sum(l_quantity), 2) AS v FROM lineitem GROUP BY l_suppkey")
both("group_sum_by_two", "SELECT l_suppkey, l_returnflag, round(sum(l_quantity), 2) AS v FROM lineitem GROUP BY l_suppkey, l_returnflag")
both("group_sum_mean", "SELECT l_partkey, round(sum(l_quantity), 2) AS s, round(avg(l_tax), 6) AS m FROM lineitem GROUP BY l_partkey")
both("group_means", "SELECT l_linenumber, round(avg(l_quantity), 6) AS a, round(avg(l_tax), 6) AS b, round(avg(l_discount), 6) AS c FROM lineitem GROUP BY l_linenumber")
both("group_median_sd", "SELECT l_suppkey, l_linestatus, median(l_quantity) AS m, round(stddev(l_quantity), 6) AS s FROM lineitem GROUP BY l_suppkey, l_linestatus")
both("group_range", "SELECT l_partkey, round(max(l_quantity) - min(l_tax), 4) AS r FROM lineitem GROUP BY l_partkey")
both(
    "group_largest_two",
    "SELECT l_partkey, l_extendedprice AS v FROM (SELECT l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC) AS n FROM lineitem) x WHERE n <= 2",
)
both("group_regression", "SELECT l_returnflag, l_linestatus, round(pow(corr(l_quantity, l_extendedprice), 2), 6) AS r2 FROM lineitem GROUP BY l_returnflag, l_linestatus")
both("group_by_many", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(sum(l_extendedprice), 2) AS v, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber")
