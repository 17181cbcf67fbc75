"""Scalar and aggregate functions by their DataFrame names.

Most are Spark's own; those below differ from Spark in a documented way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.dialect import FUNCTIONS

#: Functions that are Spark's as they are.
SAME = tuple(
    """
    col lit expr when struct broadcast asc desc asc_nulls_first asc_nulls_last desc_nulls_first desc_nulls_last
    coalesce nvl nvl2 ifnull nullif zeroifnull isnull isnotnull isnan equal_null greatest least
    upper ucase lower lcase initcap length octet_length trim ltrim rtrim btrim lpad rpad left right substr substring concat concat_ws contains
    startswith endswith like ilike regexp regexp_like regexp_replace regexp_extract regexp_extract_all regexp_count regexp_substr split split_part instr
    find_in_set levenshtein reverse repeat printf ascii char encode hex unhex base64 unbase64 md5 sha2
    abs ceil ceiling floor round bround sign signum negative positive sqrt cbrt pow exp ln log2 factorial degrees radians sin cos tan cot asin acos
    atan atan2 e pi rand
    curdate current_date now date_trunc date_part datepart extract add_months last_day year quarter month day dayofmonth dayofweek dayofyear weekofyear
    weekday hour minute second to_date to_timestamp to_timestamp_ltz to_timestamp_ntz try_to_timestamp unix_date unix_micros unix_millis unix_seconds
    array array_append array_prepend array_insert array_contains array_position array_distinct array_intersect array_union array_remove array_compact
    array_repeat array_size array_max array_min array_sort sort_array array_join arrays_overlap arrays_zip flatten slice sequence get transform
    sum avg mean min max count median product first last approx_count_distinct corr covar_pop covar_samp stddev stddev_samp stddev_pop std var_pop var_samp
    variance
    """.split()
)

globals().update({name: getattr(F, name) for name in SAME})


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def call_function(name: str, *cols: Column | str) -> Column:
    """A SQL function by name; names of the relational dialect are translated."""
    return F.call_function(FUNCTIONS.get(name.lower(), name), *cols)


def date_diff(end: Column | str, start: Column | str) -> Column:
    """Days from ``end`` to ``start``: the operands stand the other way round than in Spark."""
    return F.date_diff(_c(start), _c(end))


datediff = date_diff


def any_value(c: Column | str) -> Column:
    """The first value that isn't NULL."""
    return F.any_value(_c(c), ignoreNulls=F.lit(True))


def collect_list(c: Column | str) -> Column:
    """All values, NULLs too; Spark's own drops them."""
    return F.transform(F.collect_list(F.struct(_c(c).alias("v"))), lambda x: x["v"])


array_agg = collect_list


def mode(c: Column | str) -> Column:
    """The most frequent value, the smallest of equally frequent ones."""
    return F.call_function("mode", _c(c), F.lit(True))


def skewness(c: Column | str) -> Column:
    """Bias-corrected skewness; NULL for fewer than three values."""
    c = _c(c)
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def approxCountDistinct(c: Column | str) -> Column:  # noqa: N802
    return F.approx_count_distinct(_c(c))


def geomean(c: Column | str) -> Column:
    return F.exp(F.avg(F.ln(_c(c))))


def histogram(c: Column | str) -> Column:
    """A map from each value to its count."""
    values = F.collect_list(_c(c))
    keys = F.array_sort(F.array_distinct(values))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.size(F.filter(values, lambda v: v == k)).cast("long")))


__all__ = [*SAME, "call_function", "date_diff", "datediff", "any_value", "collect_list", "array_agg", "mode", "skewness", "approxCountDistinct", "geomean", "histogram"]
