"""SQL of the relational dialect over columns with NULLs, where it differs from Spark's."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .registry import both, connection, register

#: Nations with NULLs in a number and a text.
T = "(SELECT n_nationkey AS id, nullif(n_regionkey, 2) AS k, nullif(n_name, 'NATION_4') AS s, nullif(n_nationkey % 7, 3) AS x, CAST(nullif(n_nationkey % 4, 1) AS DOUBLE) AS y FROM nation) t"

both("sql_null_order", f"SELECT k, id, row_number() OVER (ORDER BY k, id) AS up, row_number() OVER (ORDER BY k DESC, id) AS down FROM {T}")
both("sql_null_order_limit", f"SELECT id, k FROM {T} ORDER BY k DESC NULLS FIRST, id LIMIT 6")
both("sql_null_order_subquery", f"SELECT id FROM (SELECT id, k FROM {T} ORDER BY k, id LIMIT 21) z")
both("sql_order_by_all_nulls", f"SELECT k, id FROM {T} ORDER BY ALL LIMIT 22")
both("sql_concat_nulls", f"SELECT id, concat(s, '-', x) AS c, concat('a', NULL) AS a FROM {T}")
both("sql_regexp_replace", r"SELECT n_nationkey, regexp_replace(n_name, 'A', 'b') AS one, regexp_replace(n_name, 'A', 'b', 'g') AS every, regexp_replace(n_name, '(.)(.)', '\2\1') AS turned, regexp_extract(n_name, '[A-Z]_([0-9])', 1) AS d FROM nation")
both("sql_regexp_match", "SELECT n_nationkey, n_name ~ '.*A' AS f, n_name SIMILAR TO 'A.*|B.*' AS g, regexp_matches(n_name, 'A$') AS m, regexp_full_match(n_name, '[A-Z]+') AS u FROM nation")
both("sql_string_split", "SELECT p_partkey, string_split(p_name, ' ') AS a, string_split('1.2.3', '.') AS b, string_split(p_brand, '#')[2] AS c FROM part")
both("sql_day_of_week", "SELECT o_orderkey, dayofweek(o_orderdate) AS a, isodow(o_orderdate) AS b, extract(dow FROM o_orderdate) AS c, dayname(o_orderdate) AS d, monthname(o_orderdate) AS e FROM orders")
both("sql_date_diff", "SELECT o_orderkey, date_diff('day', DATE '1995-01-31', o_orderdate) AS d, date_diff('month', DATE '1995-01-31', o_orderdate) AS m, date_diff('year', o_orderdate, DATE '1995-01-31') AS y, date_diff('week', DATE '1995-01-31', o_orderdate) AS w FROM orders")
both("sql_date_parts", "SELECT o_orderkey, date_part('year', o_orderdate) AS y, date_part('quarter', o_orderdate) AS q, date_part('doy', o_orderdate) AS d, extract(week FROM o_orderdate) AS w, date_part('decade', o_orderdate) AS e FROM orders")
both("sql_date_trunc", "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS m, strftime(date_trunc('quarter', o_orderdate), '%d/%m/%y') AS q FROM orders")
both("sql_strftime", "SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS a, strftime(ts, '%a %d %b, day %j') AS b FROM events")
both("sql_strptime", "SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d') AS a FROM orders")
both("sql_list_literal", "SELECT n_nationkey, [n_nationkey, n_regionkey, 7][2] AS a, [1, 2, 3][-1] AS b, [1, 2][n_regionkey] AS c, len([n_nationkey, 1]) AS n, [1, 2, 3, 4][2:3] AS s FROM nation")
both("sql_struct_literal", "SELECT n_nationkey, {'a': n_name, 'b': n_regionkey}.a AS a, {'a': 1, 'b': n_regionkey}['b'] AS b, struct_pack(p := n_nationkey).p AS p FROM nation")
both("sql_map_literal", "SELECT n_nationkey, MAP {'x': n_nationkey, 'y': n_regionkey}['y'] AS y, MAP {'x': 1}['z'] AS z, cardinality(MAP {'x': 1, 'y': 2}) AS n FROM nation", "SELECT n_nationkey, MAP {'x': n_nationkey, 'y': n_regionkey}['y'] AS y, MAP {'x': 1}['z'] AS z, CAST(cardinality(MAP {'x': 1, 'y': 2}) AS BIGINT) AS n FROM nation")
both("sql_list_comprehension", "SELECT n_nationkey, [e * 2 FOR e IN [n_nationkey, n_regionkey, 3] IF e > 2] AS l FROM nation")
both("sql_lambda", "SELECT n_nationkey, list_transform([n_nationkey, 2], lambda e: e + 1) AS t, list_filter([n_nationkey, 2, 9], lambda e: e > 5) AS f, list_reduce([n_nationkey, 2, 9], lambda a, b: a + b) AS r FROM nation")
both("sql_list_functions", "SELECT n_nationkey, list_sort([n_nationkey, 3, 1]) AS s, list_reverse_sort([n_nationkey, 3]) AS r, list_contains([1, 2, 3], n_nationkey) AS c, list_position([5, 6], n_nationkey) AS p, list_distinct([1, 1])[1] AS d, list_unique([1, 1, n_nationkey])::BIGINT AS u, list_slice([1, 2, 3], 2, 3) AS sl FROM nation")
both("sql_list_aggregates", "SELECT n_nationkey, list_sum([n_nationkey, 2])::DOUBLE AS s, list_avg([n_nationkey, 2]) AS a, list_max([n_nationkey, 2]) AS m, list_aggregate([n_nationkey, 2], 'min') AS i FROM nation")
both("sql_power", "SELECT n_nationkey, n_regionkey ** 2 AS a, 2 ^ n_regionkey AS b, 2 ** -1 AS c FROM nation")
both("sql_integer_division", "SELECT n_nationkey, n_nationkey // 3 AS a, n_nationkey % 3 AS b, n_nationkey / 4 AS c FROM nation")
both("sql_qualify_alias", f"SELECT id, k, row_number() OVER (PARTITION BY k ORDER BY id DESC) AS r FROM {T} QUALIFY r <= 2")
both("sql_qualify_cte", "WITH a AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS s FROM a")
both("sql_qualify_subquery", "SELECT count(*) AS n FROM (SELECT o_orderkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) <= 2) z")
both("sql_qualify_union", f"SELECT id FROM {T} QUALIFY row_number() OVER (ORDER BY id DESC) = 1 UNION ALL SELECT id FROM {T} QUALIFY row_number() OVER (ORDER BY id) <= 2")
both("sql_pivot_in_from", "SELECT * FROM (PIVOT (SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders) ON o_orderstatus IN ('F', 'O') USING count(o_orderkey) GROUP BY o_orderpriority) p WHERE o_orderpriority < '4'")
both("sql_pivot_cte", "WITH p AS (PIVOT (SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders) ON o_orderstatus IN ('F', 'P') USING max(o_orderkey) GROUP BY o_orderpriority) SELECT o_orderpriority, F, P FROM p")
both("sql_pivot_found_values", "PIVOT (SELECT l_returnflag, l_linestatus, l_orderkey FROM lineitem) ON l_returnflag USING count(l_orderkey) GROUP BY l_linestatus")
both("sql_unpivot_in_from", "SELECT n, sum(v)::BIGINT AS v FROM (UNPIVOT (SELECT n_nationkey, CAST(n_regionkey AS BIGINT) AS a, CAST(n_nationkey AS BIGINT) AS b FROM nation) ON a, b INTO NAME n VALUE v) u GROUP BY n")
both("sql_unnest_select", "SELECT r_regionkey, unnest([1, 2, r_regionkey]) AS v FROM region")
both("sql_unnest_from", "SELECT v + 1 AS v FROM unnest([1, 2, 3]) u(v)")
both("sql_range_from", "SELECT i * 2 AS j FROM range(2, 9) r(i)")
both("sql_generate_series_from", "SELECT i AS j FROM generate_series(1, 9, 2) r(i)")
both("sql_range_scalar", "SELECT n_nationkey, range(n_regionkey::BIGINT) AS a, generate_series(1, 3) AS b, range(0, 10, 4) AS c FROM nation")
both("sql_distinct_on", f"SELECT DISTINCT ON (k) k, id, s FROM {T} ORDER BY k, id DESC")
both("sql_star_replace", f"SELECT * REPLACE (x + 1 AS x, lower(s) AS s) FROM {T}")
both("sql_star_exclude_replace", f"SELECT * EXCLUDE (y) REPLACE (id * 2 AS id) FROM {T}")
both("sql_list_ordered", f"SELECT k, list(x ORDER BY x DESC, id) FILTER (WHERE x IS NOT NULL) AS l, list(id ORDER BY s, id) FILTER (WHERE id > 5) AS m FROM {T} GROUP BY k")
both("sql_string_agg_ordered", f"SELECT k, string_agg(s ORDER BY s DESC) AS a, string_agg(s, '-' ORDER BY id) AS b, string_agg(DISTINCT k::VARCHAR, '/') AS c FROM {T} GROUP BY k")
both("sql_first_ordered", f"SELECT k, first(id ORDER BY x DESC, id DESC) AS f, last(id ORDER BY x, id) AS l, first(x ORDER BY id) AS g, last(s ORDER BY s NULLS FIRST) AS h FROM {T} GROUP BY k")
both("sql_any_value", f"SELECT y IS NULL AS g, any_value(k ORDER BY k) AS a FROM (SELECT nullif(r_regionkey, 3) AS k, nullif(r_regionkey, 3) AS y FROM region WHERE r_regionkey IN (2, 3)) GROUP BY y IS NULL")
both("sql_histogram", f"SELECT k, map_keys(histogram(x)) AS a, CAST(map_values(histogram(x)) AS BIGINT[]) AS b FROM {T} GROUP BY k")
both("sql_quantiles", f"SELECT quantile_disc(x, 0.3)::INTEGER AS a, quantile_cont(x, 0.3) AS b, median(x) AS c, quantile_disc(x, [0.25, 0.75])::INTEGER[] AS d FROM {T}")
both("sql_moments", f"SELECT round(skewness(x), 6) AS a, round(kurtosis(x), 6) AS b, round(product(y + 1), 3) AS c, round(geomean(y + 1), 6) AS d FROM {T}")
both("sql_arg_max", f"SELECT k, arg_max(s, id) AS a, arg_min(s, id) AS b, max(id, 2) AS c, min(id, 3) AS d FROM {T} GROUP BY k")
both("sql_format", "SELECT n_nationkey, format('{} in {}', n_name, n_regionkey) AS f, printf('%d:%s', n_nationkey, n_name) AS p FROM nation")
both("sql_string_escapes", r"SELECT n_nationkey, 'a\b' AS a, 'it''s' AS b, length('\d') AS c, replace(n_name, 'A', '\') AS d FROM nation")
both("sql_quoted_names", 'SELECT n_name AS "odd name", n_regionkey AS "from" FROM nation')
both("sql_casts", "SELECT n_nationkey::VARCHAR AS a, CAST(n_regionkey AS DOUBLE) AS b, try_cast(n_name AS INTEGER) AS c, [n_regionkey]::VARCHAR[] AS d, '2020-02-03'::DATE AS e FROM nation")
both("sql_greatest_least", f"SELECT id, greatest(x, y) AS g, least(x, y, 2) AS l, coalesce(x, -1) AS c, nullif(x, 5) AS n, ifnull(s, '?') AS i FROM {T}")
both("sql_window_frames", f"SELECT id, sum(x) OVER (ORDER BY id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS a, first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY id) AS b, lag(x, 1, -1) OVER (ORDER BY id) AS c, count(*) OVER w AS d FROM {T} WINDOW w AS (PARTITION BY k)")
both("sql_trigonometry_division", "SELECT n_nationkey, round(sin(n_nationkey), 6) AS s, trunc(n_nationkey / 3) AS t, even(n_nationkey / 3.0) AS e, xor(n_nationkey, 3) AS x, bit_count(n_nationkey)::BIGINT AS b FROM nation", "SELECT n_nationkey, round(sin(n_nationkey), 6) AS s, trunc(n_nationkey / 3)::BIGINT AS t, even(n_nationkey / 3.0) AS e, xor(n_nationkey, 3) AS x, bit_count(n_nationkey)::BIGINT AS b FROM nation")


@register("SELECT column_name, column_type FROM (DESCRIBE SELECT n_nationkey, n_name, [1] AS c, DATE '2020-01-01' AS d FROM nation)")
def sql_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql("DESCRIBE SELECT n_nationkey, n_name, [1] AS c, DATE '2020-01-01' AS d FROM nation").project("column_name, column_type").dataframe


@register("SELECT column_name, column_type, min, max, count, null_percentage::DOUBLE AS p FROM (SUMMARIZE SELECT n_nationkey, nullif(n_name, 'NATION_4') AS s FROM nation)")
def sql_summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = connection(spark, sf_dir).sql("SUMMARIZE SELECT n_nationkey, nullif(n_name, 'NATION_4') AS s FROM nation")
    return rel.project('column_name, column_type, min, max, "count", null_percentage::DOUBLE AS p').dataframe


@register("SELECT 'physical_plan' AS explain_key, true AS scans UNION ALL SELECT 'analyzed_plan', true")
def sql_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    plain, run = con.sql("EXPLAIN SELECT n_name FROM nation"), con.sql("EXPLAIN ANALYZE SELECT count(*) FROM nation")
    return plain.union(run).project("explain_key, contains(lower(explain_value), 'scan parquet') AS scans").dataframe


@register("SELECT count(*) AS n FROM nation")
def sql_read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql(f"SELECT count(*) AS n FROM read_parquet(['{sf_dir}/nation.parquet'])").dataframe


@register("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2 AND n_nationkey > 5")
def sql_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    con.execute("PREPARE found AS SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = $1 AND n_nationkey > $2")
    return con.sql("EXECUTE found(2, 5)").dataframe


@register("SELECT r_regionkey * 2 AS twice, r_name FROM region")
def sql_insert_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    con, name = connection(spark, sf_dir), f"returned_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (r_regionkey INT, r_name STRING) USING parquet")
    try:
        rows = con.sql(f"INSERT INTO {name} SELECT r_regionkey, r_name FROM region RETURNING CAST(r_regionkey * 2 AS INTEGER) AS twice, r_name").fetchall()
        return spark.createDataFrame(rows if con.table(name).shape[0] == len(rows) else [], "twice int, r_name string")
    finally:
        spark.sql(f"DROP TABLE {name}")


@register("SELECT * FROM (VALUES (1, 'x'), (1, 'x'), (1, 'x')) v(column0, column1)")
def sql_repeat_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection(spark, sf_dir).sql("SELECT * FROM repeat_row(1, 'x', num_rows := 3)").dataframe


@register("SELECT true AS same, true AS inside")
def sql_setseed(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = connection(spark, sf_dir)
    drawn = []
    for _ in range(2):
        con.execute("SELECT setseed(0.3)")
        drawn.append([r for (r,) in con.sql("SELECT random() AS r FROM range(5)").fetchall()])
    return spark.createDataFrame([(drawn[0] == drawn[1], all(0 <= r < 1 for r in drawn[0]))], "same boolean, inside boolean")
