"""The rest of the DataFrame surface: columns, operators, rows, readers, catalog, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.paths import scratch
from .registry import register, table


@register("SELECT n_nationkey AS a, -n_nationkey AS neg, n_regionkey = 1 OR n_nationkey < 3 AS o, NOT (n_regionkey = 1) AS i, true AND n_regionkey > 2 AS ra, false OR n_regionkey > 2 AS ro FROM nation")
def col_logic(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r, k = n.n_regionkey, n["n_nationkey"]
    return n.select(k.alias("a"), (-k).alias("neg"), ((r == 1) | (k < 3)).alias("o"), (~(r == 1)).alias("i"), (True & (r > 2)).alias("ra"), (False | (r > 2)).alias("ro"))


@register("SELECT n_nationkey, n_nationkey / 4 AS td, n_nationkey % 4 AS m, power(n_nationkey, 2) AS p, 10 + n_nationkey AS ra, 3 * n_nationkey AS rm, 50 - n_nationkey AS rs, 50 / (n_nationkey + 1) AS rt, 50 % (n_nationkey + 1) AS rmo, power(2, n_nationkey) AS rp FROM nation")
def col_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        k, (k / 4).alias("td"), (k % 4).alias("m"), (k**2).alias("p"), (10 + k).alias("ra"), (3 * k).alias("rm"), (50 - k).alias("rs"), (50 / (k + 1)).alias("rt"), (50 % (k + 1)).alias("rmo"), (2**k).alias("rp")
    )


@register("SELECT n_nationkey, n_regionkey = 2 AS e, n_regionkey <> 2 AS ne, n_regionkey < 2 AS lt, n_regionkey <= 2 AS le, n_regionkey > 2 AS gt, n_regionkey >= 2 AS ge, regexp_matches(n_name, 'A$') AS r, n_name ILIKE 'a%' AS il FROM nation")
def col_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = n.n_regionkey
    return n.select(n.n_nationkey, (r == 2).alias("e"), (r != 2).alias("ne"), (r < 2).alias("lt"), (r <= 2).alias("le"), (r > 2).alias("gt"), (r >= 2).alias("ge"), n.n_name.rlike("A$").alias("r"), n.n_name.ilike("a%").alias("il"))


def _places(spark: SparkSession, sf_dir: str, key) -> DataFrame:  # noqa: ANN001
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr("nullif(n_regionkey, 2)").alias("k"))
    return n.select("n_nationkey", *[F.row_number().over(Window.orderBy(o, "n_nationkey")).alias(a) for a, o in key.items()])


@register("""SELECT n_nationkey, row_number() OVER (ORDER BY k ASC NULLS FIRST, n_nationkey) AS af, row_number() OVER (ORDER BY k ASC NULLS LAST, n_nationkey) AS al,
    row_number() OVER (ORDER BY k DESC NULLS FIRST, n_nationkey) AS df, row_number() OVER (ORDER BY k DESC NULLS LAST, n_nationkey) AS dl,
    row_number() OVER (ORDER BY k ASC NULLS FIRST, n_nationkey) AS a, row_number() OVER (ORDER BY k DESC NULLS LAST, n_nationkey) AS d FROM (SELECT n_nationkey, nullif(n_regionkey, 2) AS k FROM nation)""")
def col_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return _places(spark, sf_dir, {"af": k.asc_nulls_first(), "al": k.asc_nulls_last(), "df": k.desc_nulls_first(), "dl": k.desc_nulls_last(), "a": k.asc(), "d": k.desc()})


@register("""SELECT n_nationkey, row_number() OVER (ORDER BY k ASC NULLS FIRST, n_nationkey) AS af, row_number() OVER (ORDER BY k ASC NULLS LAST, n_nationkey) AS al,
    row_number() OVER (ORDER BY k DESC NULLS FIRST, n_nationkey) AS df, row_number() OVER (ORDER BY k DESC NULLS LAST, n_nationkey) AS dl,
    row_number() OVER (ORDER BY k ASC NULLS FIRST, n_nationkey) AS a, row_number() OVER (ORDER BY k DESC NULLS LAST, n_nationkey) AS d FROM (SELECT n_nationkey, nullif(n_regionkey, 2) AS k FROM nation)""")
def fn_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .. import functions as L

    return _places(spark, sf_dir, {"af": L.asc_nulls_first("k"), "al": L.asc_nulls_last("k"), "df": L.desc_nulls_first("k"), "dl": L.desc_nulls_last("k"), "a": L.asc("k"), "d": L.desc("k")})


@register("SELECT r_regionkey, r_name FROM region WHERE r_regionkey < 3 UNION ALL SELECT 3 + r_regionkey, r_name FROM region WHERE r_regionkey < 2 UNION ALL SELECT 10, min(r_name) FROM region")
def df_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """collect, head, take and first, as rows again."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    head = [Row(x.r_regionkey, x.r_name) for x in r.head(3)]
    taken = [Row(3 + x["r_regionkey"], x[1]) for x in r.take(2)]
    first = r.orderBy("r_name").first()
    return spark.createDataFrame([*head, *taken, Row(10, first.r_name)], r.schema)


@register("SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey + 100, r_name FROM region")
def df_to_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """toPandas and toArrow, read again."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    arrow = spark.createDataFrame(r.toArrow()).withColumn("r_regionkey", F.col("r_regionkey") + 100)
    return spark.createDataFrame(r.toPandas(), "r_regionkey int, r_name string").unionAll(arrow)


@register("SELECT c.c, c.t FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) c(c, t)")
def df_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    assert n.columns == n.schema.names == [c for c, _ in n.dtypes]
    return spark.createDataFrame(n.dtypes, "c string, t string")


@register("SELECT contains(t, 'n_nationkey: integer') AS a, contains(t, 'NATION_0') AS b FROM (SELECT ' |-- n_nationkey: integer NATION_0' AS t)")
def df_printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """show and printSchema, from what they print."""
    import contextlib
    import io

    n, out = table(spark, sf_dir, "nation"), io.StringIO()
    with contextlib.redirect_stdout(out):
        n.printSchema()
        n.orderBy("n_nationkey").show(3)
    return spark.createDataFrame([("n_nationkey: integer" in out.getvalue(), "NATION_0" in out.getvalue())], "a boolean, b boolean")


@register("SELECT a.r_regionkey AS x, b.r_regionkey AS y FROM region a CROSS JOIN region b")
def df_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").alias("x")).crossJoin(r.select(F.col("r_regionkey").alias("y")))


@register("SELECT k FROM (SELECT n_regionkey AS k FROM nation INTERSECT ALL SELECT s_nationkey % 5 FROM supplier)")
def df_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k")).intersectAll(table(spark, sf_dir, "supplier").select(F.col("s_nationkey") % 5))


@register("SELECT k FROM (SELECT s_nationkey % 5 AS k FROM supplier EXCEPT ALL SELECT n_regionkey FROM nation)")
def df_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 5).alias("k")).exceptAll(table(spark, sf_dir, "nation").select("n_regionkey"))


@register("SELECT DISTINCT n_regionkey FROM nation")
def df_drop_duplicates_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_regionkey").drop_duplicates()


@register("SELECT n_regionkey, round(avg(n_nationkey), 6) AS m, count(*) AS n FROM nation GROUP BY n_regionkey")
def df_groupby_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "nation").groupby("n_regionkey")
    return g.mean("n_nationkey").toDF("n_regionkey", "m").withColumn("m", F.round("m", 6)).join(g.count().withColumnRenamed("count", "n"), "n_regionkey")


@register("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(n_nationkey) AS BIGINT) AS s FROM nation")
def df_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").cache()
    try:
        return spark.createDataFrame([(n.count(), n.agg(F.sum("n_nationkey")).first()[0])], "n long, s long")
    finally:
        n.unpersist()


@register("SELECT r_regionkey FROM region")
def df_global_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"seen_{uuid.uuid4().hex}"
    table(spark, sf_dir, "region").createGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}").select("r_regionkey")
    finally:
        spark.catalog.dropGlobalTempView(name)


@register("SELECT 'session' AS what, true AS ok UNION ALL SELECT 'conf', true UNION ALL SELECT 'version', true UNION ALL SELECT 'context', true UNION ALL SELECT 'streams', true UNION ALL SELECT 'new', true")
def session_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """getActiveSession, conf, version, sparkContext, streams and newSession."""
    other = spark.newSession()
    spark.conf.set("lumenframe.catalogue.note", "here")
    rows = [
        ("session", SparkSession.getActiveSession() is not None), ("conf", spark.conf.get("lumenframe.catalogue.note") == "here" and other.conf.get("lumenframe.catalogue.note", "none") == "none"),
        ("version", spark.version[0].isdigit()), ("context", other.sparkContext is spark.sparkContext), ("streams", isinstance(spark.streams.active, list)), ("new", other.range(3).count() == 3),
    ]
    return spark.createDataFrame(rows, "what string, ok boolean")


@register("SELECT n_nationkey, n_name, 'csv' AS how FROM nation UNION ALL SELECT n_nationkey, n_name, 'json' FROM nation UNION ALL SELECT n_nationkey, n_name, 'parquet' FROM nation UNION ALL SELECT n_nationkey, n_name, 'load' FROM nation")
def io_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DataFrame.write and SparkSession.read in four ways."""
    n, at = table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), scratch(spark, "io")
    n.write.csv(f"{at}/csv", header=True)
    n.write.json(f"{at}/json")
    n.write.parquet(f"{at}/parquet")
    back = {
        "csv": spark.read.csv(f"{at}/csv", schema=n.schema, header=True), "json": spark.read.json(f"{at}/json", schema=n.schema),
        "parquet": spark.read.parquet(f"{at}/parquet"), "load": spark.read.format("parquet").load(f"{at}/parquet"),
    }
    out = None
    for how, df in back.items():
        df = df.withColumn("how", F.lit(how))
        out = df if out is None else out.unionByName(df)
    return out


@register("SELECT 'columns' AS what, 3 AS n UNION ALL SELECT 'table', 1 UNION ALL SELECT 'database', 1 UNION ALL SELECT 'function', 1 UNION ALL SELECT 'rows', 25")
def catalog_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """saveAsTable, table, listTables, listColumns, listDatabases, setCurrentDatabase, listFunctions, udf.register."""
    name = f"kept_{uuid.uuid4().hex}"
    table(spark, sf_dir, "nation").write.saveAsTable(name)
    try:
        spark.catalog.setCurrentDatabase("default")
        spark.udf.register("catalogue_plus", lambda x: x + 1, "int")
        rows = [
            ("columns", len(spark.catalog.listColumns(name))), ("table", sum(t.name == name for t in spark.catalog.listTables())), ("database", sum(d.name == "default" for d in spark.catalog.listDatabases())),
            ("function", sum(f.name == "catalogue_plus" for f in spark.catalog.listFunctions(pattern="catalogue_plus"))), ("rows", spark.table(name).count()),
        ]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql("DROP TEMPORARY FUNCTION IF EXISTS catalogue_plus")
    return spark.createDataFrame(rows, "what string, n int")


@register("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """readStream with load, a state of counts, and toTable."""
    from ..streaming import to_table

    at, name = scratch(spark, "stream"), f"streamed_{uuid.uuid4().hex}"
    table(spark, sf_dir, "events").select("event_type", "event_id").repartition(3).write.parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    events = spark.readStream.format("parquet").schema(schema).load(f"{at}/in")
    to_table(events, name, f"{at}/checkpoint").awaitTermination()
    try:
        return spark.createDataFrame(spark.table(name).groupBy("event_type").agg(F.count("*").alias("n")).collect(), "event_type string, n long")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@register("SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts with a watermark that lets all events in, from a stream."""
    from ..streaming import read_stream, tumbling

    at, name = scratch(spark, "stream"), f"windows_{uuid.uuid4().hex}"
    table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(f"{at}/in")
    events = read_stream(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema, 100)
    out = tumbling(events, "ts", "1 day", ["event_type"], [F.count("*").alias("n")], late="4000 days")
    out.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.table(name).select(F.unix_micros("window_start").alias("day"), "event_type", "n").collect()
    spark.catalog.dropTempView(name)
    return spark.createDataFrame(rows, "day long, event_type string, n long")


@register("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals with state of one's own; the last row of each key."""
    from ..streaming import read_stream, running_totals

    at, name = scratch(spark, "stream"), f"totals_{uuid.uuid4().hex}"
    table(spark, sf_dir, "events").select("event_type", F.col("value").cast("double").alias("value")).repartition(3).write.parquet(f"{at}/in")
    events = read_stream(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema)
    out = running_totals(events, "event_type", "value", "string")
    out.writeStream.outputMode("update").format("memory").queryName(name).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = spark.table(name).groupBy("event_type").agg(F.max("n").alias("n"), F.round(F.max_by("total", "n"), 4).alias("total")).collect()
    spark.catalog.dropTempView(name)
    return spark.createDataFrame(last, "event_type string, n long, total double")
