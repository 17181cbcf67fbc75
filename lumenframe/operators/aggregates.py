"""Named aggregates as Spark SQL text, each with the form it takes over a window."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from ..plans.dialect import has_order, window

_FRAME = "filter(transform(collect_list(struct({c} AS v)) {over}, x -> x.v), x -> x IS NOT NULL)"
_SORTED = f"array_sort({_FRAME})"


@dataclass(frozen=True)
class Aggregate:
    """``plain``: text with {c}, {p}, {q}; ``framed``: the form where Spark's own takes no order or
    frame, with {over} for the window. Without it, ``plain`` is followed by the window."""

    plain: str
    framed: str | None = None


def _at(position: str) -> str:
    """An element of the frame's sorted values (``s``) by a position from 0 in terms of ``n``."""
    return f"transform(array({_SORTED}), s -> {position})[0]"


_CONT = "if(size(s) = 0, null, s[int(floor({p} * (size(s) - 1)))] + ({p} * (size(s) - 1) - floor({p} * (size(s) - 1))) * (s[int(ceil({p} * (size(s) - 1)))] - s[int(floor({p} * (size(s) - 1)))]))"
_DISC = "if(size(s) = 0, null, s[greatest(0, int(ceil({p} * size(s))) - 1)])"
_MODE = (
    "element_at(transform(array_sort(transform(array_distinct(s), v -> struct(-size(filter(s, y -> y = v)) AS k, array_position(s, v) AS i, v AS v))), e -> e.v), 1)"
)

AGGREGATES: dict[str, Aggregate] = {
    "any_value": Aggregate("any_value({c}, true)"),
    "arg_max": Aggregate("max_by({c}, CASE WHEN {c} IS NOT NULL THEN {q} END)"),
    "arg_min": Aggregate("min_by({c}, CASE WHEN {c} IS NOT NULL THEN {q} END)"),
    "avg": Aggregate("avg({c})"),
    "bit_and": Aggregate("bit_and({c})"),
    "bit_or": Aggregate("bit_or({c})"),
    "bit_xor": Aggregate("bit_xor({c})"),
    "bitstring_agg": Aggregate("array_join(transform(sequence(bigint({p}), bigint({q})), i -> if(array_contains(collect_set(bigint({c})), i), '1', '0')), '')"),
    "bool_and": Aggregate("bool_and({c})"),
    "bool_or": Aggregate("bool_or({c})"),
    "count": Aggregate("count({c})"),
    "favg": Aggregate("avg(double({c}))"),
    "fsum": Aggregate("sum(double({c}))"),
    "first": Aggregate("first({c})"),
    "last": Aggregate("last({c})"),
    "geomean": Aggregate("exp(avg(ln({c})))"),
    "histogram": Aggregate(
        "map_from_entries(array_sort(transform(array_distinct(collect_list({c})), k -> struct(k AS key, size(filter(collect_list({c}), y -> y = k)) AS value))))",
        f"transform(array({_SORTED}), s -> map_from_entries(array_sort(transform(array_distinct(s), k -> struct(k AS key, size(filter(s, y -> y = k)) AS value)))))[0]",
    ),
    "list": Aggregate("transform(collect_list(struct({c} AS v)), x -> x.v)", "transform(collect_list(struct({c} AS v)) {over}, x -> x.v)"),
    "max": Aggregate("max({c})"),
    "min": Aggregate("min({c})"),
    "product": Aggregate(
        "aggregate(collect_list(double({c})), if(count({c}) = 0, null, 1.0D), (a, x) -> a * x)",
        f"transform(array({_FRAME}), s -> if(size(s) = 0, null, aggregate(s, 1.0D, (a, x) -> a * double(x))))[0]",
    ),
    "string_agg": Aggregate("listagg({c}, {p})"),
    "sum": Aggregate("sum({c})"),
    "median": Aggregate("median({c})", _at(_CONT.replace("{p}", "0.5D"))),
    "mode": Aggregate("mode() WITHIN GROUP (ORDER BY {c})", f"transform(array({_FRAME}), s -> {_MODE})[0]"),
    "quantile_cont": Aggregate("percentile({c}, {p})", _at(_CONT)),
    "quantile_disc": Aggregate("percentile_disc({p}) WITHIN GROUP (ORDER BY {c})", _at(_DISC)),
    "stddev_pop": Aggregate("stddev_pop({c})"),
    "stddev_samp": Aggregate("stddev_samp({c})"),
    "var_pop": Aggregate("var_pop({c})"),
    "var_samp": Aggregate("var_samp({c})"),
}

ALIASES = {"mean": "avg", "quantile": "quantile_disc", "stddev": "stddev_samp", "std": "stddev_samp", "variance": "var_samp", "var": "var_samp"}

#: Analytic functions that only make sense over a window; {n}: the first argument.
ANALYTIC = {
    "row_number": "row_number()", "rank": "rank()", "dense_rank": "dense_rank()", "percent_rank": "percent_rank()", "cume_dist": "cume_dist()",
    "n_tile": "ntile({n})", "lag": "lag({c}, {n}, {default}){nulls}", "lead": "lead({c}, {n}, {default}){nulls}",
    "first_value": "first_value({c})", "last_value": "last_value({c})", "nth_value": "nth_value({c}, {n}){nulls}",
}

#: What ranking functions give without an order, where all rows are peers.
_UNORDERED = {"rank": "1", "dense_rank": "1", "percent_rank": "0.0D", "cume_dist": "1.0D"}


def aggregate_text(name: str, column: str, p: object = None, q: object = None, over: str = "") -> str:
    """SQL of aggregate ``name``, plain or over a window."""
    agg = AGGREGATES[ALIASES.get(name, name)]
    fill: Callable[[str], str] = lambda t: t.replace("{c}", column).replace("{p}", _literal(p)).replace("{q}", _literal(q))
    if not over:
        return fill(agg.plain)
    if agg.framed is not None:
        return fill(agg.framed).replace("{over}", window(over))
    return f"{fill(agg.plain)} {window(over)}"


def analytic_text(name: str, over: str, column: str = "", n: object = 1, default: str = "NULL", ignore_nulls: bool = False) -> str:
    """SQL of a ranking or offset function."""
    if not has_order(over):
        if name in _UNORDERED:
            return _UNORDERED[name]
        body = over.strip().removeprefix("over").strip()[1:-1]
        over = f"over ({body} order by 1)" if name in ("row_number", "n_tile", "lag", "lead", "nth_value") else over
    call = ANALYTIC[name].format(c=column, n=n, default=default, nulls=" IGNORE NULLS" if ignore_nulls else "")
    return f"{call} {window(over)}"


def _literal(x: object) -> str:
    if isinstance(x, str):
        return x
    return f"{x}D" if isinstance(x, float) else "NULL" if x is None else str(x)
