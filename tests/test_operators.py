"""Joins that Spark has no operator for, streams, and every registered query on a small table set."""

from __future__ import annotations

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lumenframe import catalogue, streaming
from lumenframe.operators import joins

SMALL = Path("/root/testdata/sf0.001")


def test_asof_join(spark):
    rng = random.Random(1)
    left = [(i, rng.choice("ab"), rng.choice([None, *range(20)])) for i in range(60)]
    right = [(rng.choice("ab"), rng.randrange(20), i) for i in range(25)]
    l, r = spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, t int, v int")
    for strict in (False, True):
        got = {x.id: (x.t_right, x.v) for x in joins.asof_join(l, r, "t", ["k"], strict).collect()}
        for i, k, t in left:
            fits = [(b, v) for a, b, v in right if a == k and t is not None and (b < t if strict else b <= t)]
            assert got[i] == max(fits, default=(None, None)), (i, strict)


def test_range_join(spark):
    rng = random.Random(2)
    points = [(i, rng.uniform(-20, 120)) for i in range(80)]
    spans = [(i, lo := rng.uniform(-20, 100), lo + rng.choice([0.0, 1.0, 60.0])) for i in range(30)]
    got = joins.range_join(spark.createDataFrame(points, "p int, x double"), spark.createDataFrame(spans, "s int, lo double, hi double"), "x", "lo", "hi", 10.0).select("p", "s").collect()
    assert sorted(map(tuple, got)) == sorted((p, s) for p, x in points for s, lo, hi in spans if lo <= x < hi)


def test_salted_join_and_top_k(spark):
    left = spark.createDataFrame([(i, 0 if i % 3 else i % 7) for i in range(100)], "i int, k int")
    right = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k int, n string")
    assert sorted(map(tuple, joins.salted_join(left, right, ["k"], 4).select("i", "n").collect())) == sorted(map(tuple, left.join(right, "k").select("i", "n").collect()))
    with pytest.raises(ValueError, match="left"):
        joins.salted_join(left, right, ["k"], how="full")
    assert sorted(r.i for r in joins.top_k(left, ["k"], [F.col("i").desc()], 1).where("k = 0").collect()) == [98]


def test_stream_equals_batch(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=7 * i), f"u{i % 3}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, user string, value double")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = streaming.read_stream(spark, f"{tmp_path}/in", df.schema)
    aggs = [F.count("*").alias("n"), F.sum("value").alias("total")]
    out = streaming.tumbling(stream, "ts", "1 hour", ["user"], aggs, late="10 years")
    q = out.writeStream.outputMode("complete").format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    want = streaming.tumbling(df, "ts", "1 hour", ["user"], aggs).collect()
    assert sorted(map(tuple, spark.table("seen").collect())) == sorted(map(tuple, want))
    once = streaming.deduplicated(df.union(df), "ts", ["id"], "1 hour")
    assert once.count() == 60
    totals = streaming.running_totals(stream, "user", "value", "string").writeStream.outputMode("update").format("memory").queryName("totals").start()
    totals.processAllAvailable()
    totals.stop()
    assert {r.user: r.n for r in spark.table("totals").groupBy("user").agg(F.max("n").alias("n")).collect()} == {"u0": 20, "u1": 20, "u2": 20}


@pytest.mark.skipif(not SMALL.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["pricing_summary", "sql_pivot", "join_asof", "win_mode", "sink_update_delete", "sink_parquet_partitioned", "udf_arrow", "ts_sessions", "scan_numpy", "fn_date"])
def test_registered_queries_run(spark, name):
    assert catalogue.QUERIES[name](spark, str(SMALL)).count() > 0


def test_each_query_has_a_twin():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)


def test_scan_is_pruned_and_filtered(spark):
    if not SMALL.exists():
        pytest.skip("needs the driver's tables")
    df = catalogue.QUERIES["report_forecast"](spark, str(SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "l_comment" not in plan and "l_shipdate" not in plan.split("ReadSchema")[-1]
