"""Composed expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..expressions import CaseExpression, CoalesceOperator, ColumnExpression, ConstantExpression, FunctionExpression, SQLExpression
from .registry import register, rel

C = ColumnExpression


@register("""SELECT l_orderkey, l_linenumber, l_quantity + 1 AS a, l_quantity - 1 AS s, round(l_quantity * 1.5, 4) AS m, round(l_quantity / 4, 4) AS d, l_orderkey // 7 AS i,
    l_orderkey % 7 AS r, l_quantity ** 2 AS p, -l_quantity AS n FROM lineitem""")
def expr_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, k = C("l_quantity"), C("l_orderkey")
    r4 = lambda e: FunctionExpression("round", e, ConstantExpression(4))
    return rel(spark, sf_dir, "lineitem").select(
        k, C("l_linenumber"), (q + 1).alias("a"), (q - 1).alias("s"), r4(q * 1.5).alias("m"), r4(q / 4).alias("d"), (k // 7).cast("BIGINT").alias("i"), (k % 7).alias("r"), (q**2).alias("p"), (-q).alias("n")
    ).dataframe


@register("""SELECT l_orderkey, l_linenumber, l_quantity = 10 AS e, l_quantity != 10 AS ne, l_quantity > 10 AS g, l_quantity >= 10 AS ge, l_quantity < 10 AS l, l_quantity <= 10 AS le,
    l_quantity > 5 AND l_quantity < 20 AS a, l_quantity < 5 OR l_quantity > 20 AS o, NOT (l_quantity < 5) AS nt FROM lineitem""")
def expr_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = C("l_quantity")
    return rel(spark, sf_dir, "lineitem").select(
        C("l_orderkey"), C("l_linenumber"), (q == 10).alias("e"), (q != 10).alias("ne"), (q > 10).alias("g"), (q >= 10).alias("ge"), (q < 10).alias("l"), (q <= 10).alias("le"),
        ((q > 5) & (q < 20)).alias("a"), ((q < 5) | (q > 20)).alias("o"), (~(q < 5)).alias("nt"),
    ).dataframe


@register("""SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE 'large' END AS c, p_size IN (1, 2, 3) AS i, p_size NOT IN (1, 2, 3) AS ni,
    p_size BETWEEN 5 AND 15 AS b, p_size IS NULL AS n, p_size IS NOT NULL AS nn FROM part""")
def expr_case_in_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = C("p_size")
    return rel(spark, sf_dir, "part").select(
        C("p_partkey"), CaseExpression(s < 10, "small").when(s < 30, "middle").otherwise("large").alias("c"), s.isin(1, 2, 3).alias("i"), s.isnotin(1, 2, 3).alias("ni"),
        s.between(5, 15).alias("b"), s.isnull().alias("n"), s.isnotnull().alias("nn"),
    ).dataframe


@register("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS s, length(c_name) AS n, CAST(c_acctbal AS BIGINT) AS w FROM customer")
def expr_function_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "customer").select(
        C("c_custkey"), CoalesceOperator(FunctionExpression("nullif", C("c_mktsegment"), ConstantExpression("BUILDING")), ConstantExpression("none")).alias("s"),
        FunctionExpression("length", C("c_name")).cast("BIGINT").alias("n"), FunctionExpression("rint", C("c_acctbal")).cast("BIGINT").alias("w"),
    ).dataframe


@register("SELECT o_orderkey, round(o_totalprice * 1.1, 4) AS t FROM orders WHERE o_orderstatus = 'F'")
def expr_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel(spark, sf_dir, "orders").filter(SQLExpression("o_orderstatus = 'F'")).select(C("o_orderkey"), SQLExpression("round(o_totalprice * 1.1D, 4)").alias("t")).dataframe


@register("SELECT list_transform([p_size, p_size + 1], lambda x: x * 10) AS t, p_partkey FROM part")
def expr_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from ..expressions import Expression, LambdaExpression

    items = FunctionExpression("list_value", C("p_size"), C("p_size") + 1)
    return rel(spark, sf_dir, "part").select(Expression(F.transform(items.column, LambdaExpression("x", lambda x: x * 10))).alias("t"), C("p_partkey")).dataframe
