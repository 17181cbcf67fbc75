"""Joins that Spark has no operator for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


#: Ranges of ``on`` into which ``asof_join`` deals each key, so that no key is one task.
RANGES = 64


def _position(column: str, kind: T.DataType) -> Column | None:
    """An orderable value as a number, or None if its type has none."""
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return None


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str], strict: bool = False, suffix: str = "_right", ranges: int = RANGES) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of the same ``by`` whose ``on`` is not after it.

    Both sides go into one sorted pass by key and range of ``on``, where the last right row is
    carried forward; no range join. The ranges are cut at quantiles of the right side's ``on``,
    so that a hot key is spread over ``ranges`` tasks; the last right row of the ranges before
    enters each range as one more row. ``strict``: the right row must be earlier. Left rows
    without a match keep NULLs; a null ``on`` matches nothing. Ties on the right: the greatest
    row counts. Column names that begin with ``__asof`` are taken.
    """
    taken = [c for c in (*left.columns, *right.columns) if c.startswith("__asof")]
    if taken:
        raise ValueError(f"columns {taken} have names that the join needs")
    extra = [c for c in right.columns if c not in by]
    names = {c: (c + suffix if c in left.columns else c) for c in extra}
    packed = F.struct(*[F.col(c) for c in extra])
    kind = right.select(packed.alias("r")).schema["r"].dataType
    place = _position(on, right.schema[on].dataType) if type(left.schema[on].dataType) is type(right.schema[on].dataType) else None
    cuts: list[float] = []
    if place is not None and ranges > 1:
        found = right.agg(F.percentile_approx(place, [i / ranges for i in range(1, ranges)], 1000)).first()[0]
        cuts = sorted(set(found or ()))
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= place)) if cuts else F.lit(0)
    sides = F.lit(1 if strict else 0), F.lit(0 if strict else 1)
    rows_right = right.where(F.col(on).isNotNull()).select(*by, part.alias("__asof_part"), F.col(on).alias("__asof_on"), sides[0].alias("__asof_side"), packed.alias("__asof_right"))
    rows_left = left.select(*by, part.alias("__asof_part"), F.col(on).alias("__asof_on"), sides[1].alias("__asof_side"), F.lit(None).cast(kind).alias("__asof_right"), F.struct("*").alias("__asof_left"))
    whole = rows_left.schema["__asof_left"].dataType
    if cuts:
        ends = rows_right.groupBy(*by, "__asof_part").agg(F.max(F.struct("__asof_on", "__asof_right")).alias("__asof_end"))
        keys = rows_left.groupBy(*by, "__asof_part").agg(F.lit(None).cast(ends.schema["__asof_end"].dataType).alias("__asof_end"))
        each = ends.unionByName(keys).groupBy(*by, "__asof_part").agg(F.max("__asof_end").alias("__asof_end"))
        before = Window.partitionBy(*by).orderBy("__asof_part").rowsBetween(Window.unboundedPreceding, -1)  # at most ``ranges`` rows
        carried = each.withColumn("__asof_end", F.max("__asof_end").over(before)).where("__asof_end IS NOT NULL")
        rows_right = rows_right.unionByName(carried.select(*by, "__asof_part", "__asof_end.__asof_on", sides[0].alias("__asof_side"), "__asof_end.__asof_right"))
    both = rows_left.unionByName(rows_right.withColumn("__asof_left", F.lit(None).cast(whole)))
    w = Window.partitionBy(*by, "__asof_part").orderBy("__asof_on", "__asof_side", F.col("__asof_right").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__asof_last", F.last("__asof_right", ignorenulls=True).over(w)).where("__asof_left IS NOT NULL")
    last = F.when(F.col("__asof_on").isNotNull(), F.col("__asof_last"))
    return found.select("__asof_left.*", *[last[c].alias(names[c]) for c in extra])


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float, how: str = "inner") -> DataFrame:
    """Rows with ``low <= point < high``, as an equality join on bins of ``width``.

    Each interval is put into the bins that it covers, so choose ``width`` near the usual length
    of an interval; the exact test follows.
    """
    bins = F.sequence(F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long"))
    spread = right.where(F.col(low) < F.col(high)).withColumn("__bin", F.explode(bins))
    own = left.withColumn("__bin", F.floor(F.col(point) / width).cast("long"))
    test: Column = (own["__bin"] == spread["__bin"]) & (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    return own.join(spread, test, how).drop("__bin")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """An equality join whose hot left keys are dealt over ``salts`` tasks; the right side repeats."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side can be salted")
    # by the row's content, so that a task that runs again deals the same rows the same way
    content = [F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f"`{f.name}`") for f in left.schema if not isinstance(f.dataType, T.MapType)]
    own = left.withColumn("__salt", F.pmod(F.xxhash64(*content), F.lit(salts)).cast("int"))
    other = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return own.join(other, [*on, "__salt"], how).drop("__salt")


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= k).drop("__n")
