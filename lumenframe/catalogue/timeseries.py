"""Windows of event time, sessions and stream forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from .registry import register, table


@register("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def ts_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streaming.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], [F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@register("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events),
    g AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, min(ts) AS session_start, count(*) AS n FROM g GROUP BY user_id, k""")
def ts_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streaming.sessions(table(spark, sf_dir, "events"), "ts", "30 minutes", ["user_id"], [F.count("*").alias("n")])
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


@register("SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type")
def ts_deduplicated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = streaming.deduplicated(table(spark, sf_dir, "events"), "ts", ["user_id", "event_type"], "1 hour")
    return e.groupBy("event_type").agg(F.count("*").alias("n"))
