"""The DataFrame surface, which is Spark's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .registry import register, table


@register("SELECT p_partkey, p_size + 1 AS size, p_name AS title, p_size * 2 AS a, p_size - 1 AS b FROM part")
def df_with_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    p = p.withColumns({"a": F.col("p_size") * 2, "b": F.col("p_size") - 1}).withColumn("p_size", F.col("p_size") + 1)
    return p.withColumnRenamed("p_size", "size").withColumnsRenamed({"p_name": "title"})


@register("SELECT r_regionkey AS k, r_name AS n, NULL::INTEGER AS x FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def df_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("n"))
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("x"), F.col("n_name").alias("n"), F.col("n_nationkey").alias("k"))
    return r.unionByName(n, allowMissingColumns=True)


@register("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def df_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").dropDuplicates(["c_nationkey", "c_mktsegment"])


@register("SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def df_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey").intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@register("SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS a, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY o_orderstatus")
def df_grouped_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy("o_orderstatus")
    out = g.count().withColumnRenamed("count", "n")
    a = g.avg("o_totalprice").toDF("o_orderstatus", "a").withColumn("a", F.round("a", 4))
    return out.join(a, "o_orderstatus").join(g.max("o_totalprice").toDF("o_orderstatus", "hi"), "o_orderstatus").join(g.min("o_totalprice").toDF("o_orderstatus", "lo"), "o_orderstatus")


@register("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_acctbal > 0 ORDER BY s_name LIMIT 5")
def df_transform_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    positive = lambda d: d.where(d.s_acctbal > 0)
    return table(spark, sf_dir, "supplier").transform(positive).orderBy("s_name").limit(5).drop("s_nationkey", "s_acctbal").toDF("id", "name")


@register("SELECT * FROM (VALUES (1, 'a'), (2, 'b')) t(x, y)")
def df_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([Row(x=1, y="a"), Row(x=2, y="b")], "x int, y string")


@register("SELECT CAST(i AS BIGINT) AS id FROM range(2, 20, 3) t(i)")
def df_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(2, 20, 3)


@register("SELECT e.event_type, count(*) AS n FROM events e WHERE e.value > 50 AND e.event_type LIKE 'c%' GROUP BY e.event_type")
def df_column_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").alias("e")
    kept = e.filter((F.col("e.value") > 50) & F.col("e.event_type").startswith("c") & F.col("e.event_type").like("c%") & F.col("e.event_type").isNotNull())
    return kept.groupBy("event_type").count().withColumnRenamed("count", "n")


@register("SELECT label, vec_id, embedding[1] AS first, embedding[2] AS second FROM embeddings")
def df_get_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("label", "vec_id", e.embedding[0].alias("first"), F.get("embedding", F.lit(1)).alias("second"))


@register("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01'")
def df_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("li_seen")
    return spark.sql("SELECT count(*) AS n FROM li_seen WHERE l_shipdate >= TIMESTAMP_NTZ '1995-01-01 00:00:00'")
