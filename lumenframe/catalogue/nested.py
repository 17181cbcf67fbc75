"""Lists, structs, maps and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import register, table


@register("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 4) AS norm2, len(list_filter(embedding, lambda x: x > 0)) AS pos FROM embeddings")
def nested_higher_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    norm = F.aggregate(e, F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(norm, 4).alias("norm2"), F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("pos"))


@register("SELECT o_custkey, s.n AS n, s.t AS t FROM (SELECT o_custkey, struct_pack(n := count(*), t := round(sum(o_totalprice), 2)) AS s FROM orders GROUP BY o_custkey)")
def nested_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.struct(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("t")).alias("s"))
    return s.select("o_custkey", "s.n", "s.t")


@register("SELECT label, i, round(avg(x), 5) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i")
def nested_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", (F.col("i") + 1).cast("long").alias("i")).agg(F.round(F.avg(F.col("x").cast("double")), 5).alias("m"))


@register("SELECT n_regionkey AS k, map_keys(m) AS ks, map_values(m) AS vs FROM (SELECT n_regionkey, map_from_entries(list({'k': n_name, 'v': n_nationkey} ORDER BY n_name)) AS m FROM nation GROUP BY n_regionkey)")
def nested_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey")))
    m = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(F.map_from_entries(entries).alias("m"))
    return m.select("k", F.map_keys("m").alias("ks"), F.map_values("m").alias("vs"))


@register("SELECT event_id, json_type(props) IS NOT NULL AS ok, len(json_keys(props)) AS n FROM events WHERE props IS NOT NULL")
def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("props IS NOT NULL")
    return e.select("event_id", F.try_parse_json("props").isNotNull().alias("ok"), F.size(F.json_object_keys("props")).cast("long").alias("n"))


@register("SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) AS x FROM customer GROUP BY c_nationkey")
def nested_collect_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("x"))
