"""Scalar functions by family, several in a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as S

from .. import functions as F
from .registry import register, table

c = S.col


@register("""SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS lo, length(p_name) AS le, CAST(strlen(p_name) AS INTEGER) AS ol, trim(p_type) AS tr, lpad(p_brand, 12, '*') AS lp,
    rpad(p_brand, 12, '*') AS rp, left(p_name, 3) AS lf, right(p_name, 3) AS rt, substr(p_name, 2, 4) AS su, concat(p_brand, '-', p_type) AS cc, concat_ws('/', p_brand, NULL, p_type) AS cw,
    contains(p_name, 'a') AS co, starts_with(p_name, 'a') AS st, ends_with(p_name, 'e') AS en, instr(p_name, 'a') AS ins, reverse(p_name) AS re, repeat(p_brand, 2) AS rep, ascii(p_name) AS asc,
    replace(p_name, ' ', '') AS rpl, ltrim('  x ') AS lt, rtrim('  x ') AS rtr, trim('xxaxx', 'x') AS bt FROM part""")
def fn_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, b, t = "p_name", "p_brand", "p_type"
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper(n).alias("up"), F.lcase(b).alias("lo"), S.length(n).cast("long").alias("le"), F.octet_length(n).alias("ol"), F.trim(t).alias("tr"), F.lpad(b, 12, "*").alias("lp"),
        F.rpad(b, 12, "*").alias("rp"), F.left(c(n), S.lit(3)).alias("lf"), F.right(c(n), S.lit(3)).alias("rt"), F.substring(n, 2, 4).alias("su"), F.concat(c(b), S.lit("-"), c(t)).alias("cc"),
        F.concat_ws("/", c(b), S.lit(None).cast("string"), c(t)).alias("cw"), F.contains(c(n), S.lit("a")).alias("co"), F.startswith(c(n), S.lit("a")).alias("st"), F.endswith(c(n), S.lit("e")).alias("en"),
        F.instr(n, "a").cast("long").alias("ins"), F.reverse(n).alias("re"), F.repeat(b, 2).alias("rep"), F.ascii(n).alias("asc"), S.replace(c(n), S.lit(" "), S.lit("")).alias("rpl"),
        F.ltrim(S.lit("  x ")).alias("lt"), F.rtrim(S.lit("  x ")).alias("rtr"), F.btrim(S.lit("xxaxx"), S.lit("x")).alias("bt"),
    )


@register(r"""SELECT p_partkey, regexp_matches(p_name, '[aeiou]{2}') AS m, regexp_replace(p_name, '[aeiou]', '_', 'g') AS r, regexp_extract(p_name, '([a-z]+)', 1) AS x,
    len(regexp_extract_all(p_name, '[aeiou]')) AS n, regexp_extract_all(p_name, '([a-z])[aeiou]', 1) AS xs, string_split(p_type, ' ') AS s, split_part(p_type, ' ', 1) AS sp,
    p_name LIKE '%a%' AS lk, p_name ILIKE '%A%' AS il, levenshtein(p_name, p_type) AS lv FROM part""")
def fn_regex_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, t = c("p_name"), c("p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_like(n, S.lit("[aeiou]{2}")).alias("m"), F.regexp_replace(n, "[aeiou]", "_").alias("r"), F.regexp_extract(n, "([a-z]+)", 1).alias("x"),
        F.regexp_count(n, S.lit("[aeiou]")).cast("long").alias("n"), F.regexp_extract_all(n, S.lit("([a-z])[aeiou]"), 1).alias("xs"), F.split(t, " ").alias("s"),
        F.split_part(t, S.lit(" "), S.lit(1)).alias("sp"), F.like(n, S.lit("%a%")).alias("lk"), F.ilike(n, S.lit("%A%")).alias("il"), F.levenshtein(n, t).cast("long").alias("lv"),
    )


@register("""SELECT p_partkey, md5(p_name) AS m, sha256(p_name) AS s, hex(p_name) AS h, base64(encode(p_name)) AS b, decode(unhex(hex(p_name))) AS u, chr(65 + CAST(p_size % 26 AS INTEGER)) AS ch,
    format('{}-{}', p_brand, p_size) AS f FROM part""")
def fn_hash_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = c("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.md5(n).alias("m"), F.sha2(n, 256).alias("s"), F.hex(n).alias("h"), F.base64(F.encode(n, "UTF-8")).alias("b"), S.decode(F.unhex(F.hex(n)), "UTF-8").alias("u"),
        F.char(65 + c("p_size") % 26).alias("ch"), F.printf(S.lit("%s-%s"), c("p_brand"), c("p_size")).alias("f"),
    )


@register("""SELECT c_custkey, abs(c_acctbal) AS a, CAST(ceil(c_acctbal) AS BIGINT) AS ce, CAST(floor(c_acctbal) AS BIGINT) AS fl, round(c_acctbal, 1) AS r, sign(c_acctbal) AS sg, round(sqrt(abs(c_acctbal)), 6) AS sq,
    round(cbrt(abs(c_acctbal)), 6) AS cb, round(exp(c_acctbal / 10000), 6) AS ex, round(ln(abs(c_acctbal) + 1), 6) AS l, round(log2(abs(c_acctbal) + 1), 6) AS l2, CAST(factorial(c_nationkey % 15) AS BIGINT) AS fa,
    greatest(c_acctbal, 100.0) AS g, least(c_acctbal, 100.0) AS le, round(pow(c_nationkey, 2), 2) AS p, -c_acctbal AS ng FROM customer""")
def fn_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, n = c("c_acctbal"), c("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.abs(b).alias("a"), F.ceil(b).alias("ce"), F.floor(b).alias("fl"), F.round(b, 1).alias("r"), F.sign(b).cast("byte").alias("sg"), F.round(F.sqrt(F.abs(b)), 6).alias("sq"),
        F.round(F.cbrt(F.abs(b)), 6).alias("cb"), F.round(F.exp(b / 10000), 6).alias("ex"), F.round(F.ln(F.abs(b) + 1), 6).alias("l"), F.round(F.log2(F.abs(b) + 1), 6).alias("l2"),
        F.factorial(n % 15).alias("fa"), F.greatest(b, S.lit(100.0)).alias("g"), F.least(b, S.lit(100.0)).alias("le"), F.round(F.pow(n, S.lit(2)), 2).alias("p"), F.negative(b).alias("ng"),
    )


@register("""SELECT DISTINCT l_discount, round(sin(l_discount), 8) AS s, round(cos(l_discount), 8) AS co, round(tan(l_discount), 8) AS t, round(asin(l_discount), 8) AS asi, round(acos(l_discount), 8) AS ac,
    round(atan(l_discount), 8) AS at, round(atan2(l_discount, 1.0), 8) AS a2, round(cot(l_discount + 1), 8) AS ct, round(degrees(l_discount), 8) AS d, round(radians(l_discount), 8) AS r,
    round(pi(), 8) AS p FROM lineitem""")
def fn_trigonometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = c("l_discount")
    fs = {"s": F.sin(x), "co": F.cos(x), "t": F.tan(x), "asi": F.asin(x), "ac": F.acos(x), "at": F.atan(x), "a2": F.atan2(x, S.lit(1.0)), "ct": F.cot(x + 1), "d": F.degrees(x), "r": F.radians(x), "p": F.pi()}
    return table(spark, sf_dir, "lineitem").select("l_discount").distinct().select("l_discount", *[F.round(f, 8).alias(k) for k, f in fs.items()])


@register("""SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofweek(o_orderdate) + 1 AS dw, dayofyear(o_orderdate) AS dy,
    weekofyear(o_orderdate) AS w, isodow(o_orderdate) - 1 AS wd, hour(o_orderdate) AS h, minute(o_orderdate) AS mi, CAST(date_trunc('month', o_orderdate) AS DATE) AS tr,
    CAST(last_day(o_orderdate) AS DATE) AS ld, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS am, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS dd,
    epoch_us(o_orderdate) AS us, epoch_ms(o_orderdate) AS ms, CAST(epoch(o_orderdate) AS BIGINT) AS s FROM orders""")
def fn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, long = c("o_orderdate"), "long"
    day = o.cast("date")
    ts = o.cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(o).cast(long).alias("y"), F.quarter(o).cast(long).alias("q"), F.month(o).cast(long).alias("m"), F.day(o).cast(long).alias("d"), F.dayofweek(o).cast(long).alias("dw"),
        F.dayofyear(o).cast(long).alias("dy"), F.weekofyear(o).cast(long).alias("w"), F.weekday(o).cast(long).alias("wd"), F.hour(o).cast(long).alias("h"), F.minute(o).cast(long).alias("mi"),
        F.date_trunc("month", o).cast("date").alias("tr"), F.last_day(day).alias("ld"), F.add_months(day, 2).alias("am"), F.date_diff(S.lit("1992-01-01").cast("date"), day).cast(long).alias("dd"),
        F.unix_micros(ts).alias("us"), F.unix_millis(ts).alias("ms"), F.unix_seconds(ts).alias("s"),
    )


@register("""SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS d, strftime(o_orderdate, '%Y%m') AS m, date_part('year', o_orderdate) AS y,
    extract(month FROM o_orderdate) AS mo, TRY_CAST('x' AS DATE) IS NULL AS bad FROM orders""")
def fn_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.formats import java_pattern

    o = c("o_orderdate")
    text = S.date_format(o, java_pattern("%d/%m/%Y"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date(text, java_pattern("%d/%m/%Y")).alias("d"), S.date_format(o, java_pattern("%Y%m")).alias("m"), F.date_part(S.lit("year"), o).cast("long").alias("y"),
        F.extract(S.lit("month"), o).cast("long").alias("mo"), F.try_to_timestamp(S.lit("x")).isNull().alias("bad"),
    )


@register("""SELECT vec_id, len(embedding) AS n, round(list_max(embedding), 5) AS mx, round(list_min(embedding), 5) AS mn, list_contains([1, 2, label], label) AS co, list_position([5, label, 7], label) AS po,
    list_sort(list_distinct([3, 1, 3, label])) AS di, [label, 1] || [2] AS ap, array_to_string([label, 9], '-') AS j, flatten([[label], [1, 2]]) AS fl, [10, 20, 30, 40][2:3] AS sl,
    list_sort(list_intersect([1, 2, 3], [2, 3, label])) AS it, list_has_any([1, label], [label]) AS ov, generate_series(1, 5) AS sq, list_filter([1, 2, label], lambda x: x <> 2) AS rm, list_reverse_sort([1, 3, 2]) AS rs
    FROM embeddings""")
def fn_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v = c("embedding"), c("label")
    arr = lambda *xs: F.array(*[x if not isinstance(x, int) else S.lit(x) for x in xs])
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array_size(e).cast("long").alias("n"), F.round(F.array_max(e), 5).alias("mx"), F.round(F.array_min(e), 5).alias("mn"), F.array_contains(arr(1, 2, v), v).alias("co"),
        F.array_position(arr(5, v, 7), v).cast("int").alias("po"), F.array_sort(F.array_distinct(arr(3, 1, 3, v))).alias("di"), F.array_append(arr(v, 1), S.lit(2)).alias("ap"),
        F.array_join(S.transform(arr(v, 9), lambda x: x.cast("string")), "-").alias("j"), F.flatten(F.array(arr(v), arr(1, 2))).alias("fl"), F.slice(arr(10, 20, 30, 40), 2, 2).alias("sl"),
        F.array_sort(F.array_intersect(arr(1, 2, 3), arr(2, 3, v))).alias("it"), F.arrays_overlap(arr(1, v), arr(v)).alias("ov"), F.sequence(S.lit(1).cast("long"), S.lit(5).cast("long")).alias("sq"),
        F.array_remove(arr(1, 2, v), 2).alias("rm"), F.sort_array(arr(1, 3, 2), False).alias("rs"),
    )


@register("""SELECT user_id, coalesce(nullif(event_type, 'click'), 'c') AS co, ifnull(NULL, user_id) AS i, CASE WHEN user_id IS NULL THEN 0 ELSE 1 END AS n2, value IS NOT DISTINCT FROM value AS eq,
    isnan(value) AS na, user_id IS NULL AS nl, coalesce(user_id, 0) AS z FROM events""")
def fn_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v = c("user_id"), c("value")
    return table(spark, sf_dir, "events").select(
        "user_id", F.coalesce(F.nullif(c("event_type"), S.lit("click")), S.lit("c")).alias("co"), F.ifnull(S.lit(None).cast("long"), u).alias("i"), F.nvl2(u, S.lit(1), S.lit(0)).alias("n2"),
        F.equal_null(v, v).alias("eq"), F.isnan(v).alias("na"), F.isnull(u).alias("nl"), F.zeroifnull(u).alias("z"),
    )
