"""Calls of the relational dialect's functions as Spark SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from ..sources.formats import java_pattern
from ..types import NAMES

#: Functions whose name alone differs.
FUNCTIONS = {
    "list_value": "array", "list_pack": "array", "list_contains": "array_contains", "list_has": "array_contains", "array_has": "array_contains", "list_distinct": "array_distinct",
    "list_concat": "concat", "list_cat": "concat", "array_cat": "concat", "list_max": "array_max", "list_min": "array_min", "list_transform": "transform", "list_apply": "transform",
    "array_transform": "transform", "apply": "transform", "list_filter": "filter", "array_filter": "filter", "list_intersect": "array_intersect",
    "list_has_any": "arrays_overlap", "array_has_any": "arrays_overlap", "list_append": "array_append", "list_reverse": "reverse", "array_reverse": "reverse", "list_flatten": "flatten",
    "len": "length", "strlen": "octet_length", "suffix": "endswith",
    "prefix": "startswith", "starts_with": "startswith", "ends_with": "endswith", "epoch_ms": "unix_millis", "epoch_us": "unix_micros", "array_length": "size",
    "ord": "ascii", "unicode": "ascii", "today": "current_date", "get_current_timestamp": "current_timestamp", "current_localtimestamp": "localtimestamp",
    "dayofmonth": "day", "string_split_regex": "split", "str_split_regex": "split", "regexp_split_to_array": "split", "array_to_string": "array_join", "list_string": "array_join",
    "editdist3": "levenshtein", "approx_quantile": "percentile_approx", "to_hex": "hex", "from_hex": "unhex", "countif": "count_if",
    "fdiv": "try_divide", "random": "rand", "strpos": "instr", "from_base64": "unbase64", "to_base64": "base64",
    "json_extract_string": "get_json_object", "list_element": "try_element_at", "list_extract": "try_element_at", "array_extract": "try_element_at", "map_extract_value": "try_element_at",
    "kahan_sum": "sum", "sumkahan": "sum", "fsum": "sum", "favg": "avg", "make_timestamp": "make_timestamp_ntz", "log": "log10",
}


@dataclass
class Call:
    """A call with its arguments as Spark SQL; the order, filter and window that belong to it."""

    name: str
    args: list[str]
    distinct: bool = False
    keys: list[tuple[str, bool, bool]] = field(default_factory=list)  # expression, descending, NULLs first
    filter: str = ""
    tail: str = ""
    named: dict[str, str] = field(default_factory=dict)

    def plain(self, name: str) -> str:
        order = f" ORDER BY {order_text(self.keys)}" if self.keys and "OVER" not in self.tail else ""
        return f"{name}({'DISTINCT ' if self.distinct else ''}{', '.join(self.args)}{order}){self.filter}{self.tail}"

    def agg(self, text: str) -> str:
        """``text`` is one Spark aggregate, to which filter and window belong."""
        return f"{text}{self.filter}{self.tail}"


def order_text(keys: list[tuple[str, bool, bool]]) -> str:
    return ", ".join(f"{e}{' DESC' if down else ''} NULLS {'FIRST' if first else 'LAST'}" for e, down, first in keys)


def string_value(literal: str) -> str:
    """The text that a quoted literal of the dialect or of Spark stands for."""
    return literal[1:-1].replace("''", "'").replace("\\\\", "\\")


def _is_literal(text: str) -> bool:
    return len(text) > 1 and text[0] == "'" == text[-1] and "'" not in text[1:-1].replace("''", "")


def _string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --------------------------------------------------------------------------- aggregates


def _before(keys: list[tuple[str, bool, bool]], n: str = "k") -> str:
    """The body of a comparator of structs with fields k0, k1, ... for ``array_sort``."""
    out = "0"
    for i, (_, down, first) in reversed(list(enumerate(keys))):
        a, b = f"l.{n}{i}", f"r.{n}{i}"
        low, null = ("1", "-1") if down else ("-1", "1"), ("-1", "1") if first else ("1", "-1")
        out = f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN {out} WHEN {a} IS NULL THEN {null[0]} WHEN {b} IS NULL THEN {null[1]} WHEN {a} < {b} THEN {low[0]} WHEN {a} > {b} THEN {low[1]} ELSE {out} END"
    return out


def _values(c: Call) -> str:
    """All values as a list, NULLs too, in the call's order."""
    x = c.args[0]
    if c.distinct:
        made = f"array_distinct(transform(collect_list(struct({x} AS v)){c.filter}{c.tail}, e -> e.v))"
        return f"sort_array({made}, false)" if c.keys and c.keys[0][1] else f"array_sort({made})"
    fields = "".join(f", {e} AS k{i}" for i, (e, _, _) in enumerate(c.keys))
    made = f"collect_list(struct({x} AS v{fields})){c.filter}{c.tail}"
    if c.keys:
        made = f"array_sort({made}, (l, r) -> {_before(c.keys)})"
    return f"transform({made}, e -> e.v)"


def _joined(c: Call) -> str:
    sep = c.args[1] if len(c.args) > 1 else "','"
    x = f"CAST({c.args[0]} AS STRING)"
    if "OVER" in c.tail:
        return f"array_join(collect_list({x}){c.filter}{c.tail}, {sep})"
    order = f" WITHIN GROUP (ORDER BY {order_text(c.keys)})" if c.keys else ""
    if c.distinct and c.keys:
        order = f" WITHIN GROUP (ORDER BY {x}{' DESC' if c.keys[0][1] else ''})"
    return f"listagg({'DISTINCT ' if c.distinct else ''}{x}, {sep}){order}{c.filter}{c.tail}"


def _edge(c: Call, last: bool) -> str:
    """``first`` and ``last``: by the order inside the call, or as rows come."""
    if "OVER" in c.tail or not c.keys:
        return c.agg(f"{'last' if last else 'first'}({c.args[0]})")
    if len({(down, first) for _, down, first in c.keys}) == 1:
        _, down, first = c.keys[0]
        # NULLs last: the test is true for NULLs when the least counts, false when the greatest does
        by = "struct(" + ", ".join(f"({e} IS {'NOT ' if down != first else ''}NULL), {e}" for e, _, _ in c.keys) + ")"
        return c.agg(f"{'max_by' if down != last else 'min_by'}({c.args[0]}, {by})")
    return f"try_element_at({_values(c)}, {-1 if last else 1})"


def _disc(c: Call) -> str:
    q = c.args[1] if len(c.args) > 1 else "0.5"
    one = lambda p: c.agg(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c.args[0]})")
    if q.startswith("array("):
        return f"array({', '.join(one(p.strip()) for p in q[6:-1].split(','))})"
    return one(q)


def _moments(c: Call, name: str) -> str:
    x, n = c.args[0], c.agg(f"count({c.args[0]})")
    g = c.agg(f"{name}({x})")
    if name == "skewness":
        return f"CASE WHEN {n} > 2 THEN {g} * sqrt(double({n}) * ({n} - 1)) / ({n} - 2) END"
    return f"CASE WHEN {n} > 3 THEN (double({n}) - 1) / (({n} - 2) * double({n} - 3)) * (({n} + 1) * {g} + 6) END"


def _histogram(c: Call) -> str:
    s = f"array_sort({c.agg(f'collect_list({c.args[0]})')})"
    ends = f"filter(sequence(1, size({s})), i -> i = size({s}) OR {s}[i - 1] <> {s}[greatest(0, least(i, size({s}) - 1))])"
    return f"CASE WHEN size({s}) > 0 THEN map_from_entries(transform({ends}, (e, j) -> struct({s}[e - 1] AS key, bigint(e - IF(j = 0, 0, {ends}[greatest(j - 1, 0)])) AS value))) END"


def _by(name: str) -> Callable[[Call], str]:
    """The value where another is greatest or least; rows where the value is NULL don't count."""

    def made(c: Call) -> str:
        if len(c.args) > 2:
            keys = [(c.args[1], name == "max_by", False)]
            return f"slice({_values(Call('list', c.args[:1], False, keys, c.filter, c.tail))}, 1, {c.args[2]})"
        return c.agg(f"{name}({c.args[0]}, CASE WHEN {c.args[0]} IS NOT NULL THEN {c.args[1]} END)")

    return made


AGGREGATES: dict[str, Callable[[Call], str]] = {
    **{n: _by("max_by") for n in ("arg_max", "argmax", "max_by")},
    **{n: _by("min_by") for n in ("arg_min", "argmin", "min_by")},
    "list": _values,
    "array_agg": _values,
    "string_agg": _joined,
    "group_concat": _joined,
    "listagg": lambda c: _joined(c) if not c.tail.startswith(" WITHIN") else c.plain("listagg"),
    "first": lambda c: _edge(c, False),
    "arbitrary": lambda c: _edge(c, False),
    "last": lambda c: _edge(c, True),
    "any_value": lambda c: c.agg(f"any_value({c.args[0]}, true)"),
    "quantile_disc": _disc,
    "quantile": _disc,
    "quantile_cont": lambda c: c.agg(f"percentile({c.args[0]}, {c.args[1]})"),
    "mode": lambda c: c.agg(f"mode({c.args[0]}, true)") if c.args else c.plain("mode"),
    "histogram": _histogram,
    "product": lambda c: f"aggregate({c.agg(f'collect_list(double({c.args[0]}))')}, CAST(NULL AS DOUBLE), (a, x) -> coalesce(a, 1D) * x)",
    "geomean": lambda c: f"exp({c.agg(f'avg(ln({c.args[0]}))')})",
    "geometric_mean": lambda c: f"exp({c.agg(f'avg(ln({c.args[0]}))')})",
    "skewness": lambda c: _moments(c, "skewness"),
    "kurtosis": lambda c: _moments(c, "kurtosis"),
    "kurtosis_pop": lambda c: c.agg(f"kurtosis({c.args[0]})"),
    "sem": lambda c: f"({c.agg(f'stddev_samp({c.args[0]})')} / sqrt({c.agg(f'count({c.args[0]})')}))",
    "count": lambda c: c.plain("count") if c.args else c.agg("count(*)"),
    "count_star": lambda c: c.agg("count(*)"),
    "max": lambda c: c.plain("max") if len(c.args) == 1 else f"slice({_values(Call('list', c.args[:1], False, [(c.args[0], True, False)], c.filter, c.tail))}, 1, {c.args[1]})",
    "min": lambda c: c.plain("min") if len(c.args) == 1 else f"slice({_values(Call('list', c.args[:1], False, [(c.args[0], False, False)], c.filter, c.tail))}, 1, {c.args[1]})",
}


# --------------------------------------------------------------------------- scalars


def _concat(c: Call) -> str:
    if any(a.startswith(("array(", "transform(", "filter(", "split(", "sequence(")) for a in c.args):
        return f"concat({', '.join(c.args)})"
    return f"concat({', '.join(a if _is_literal(a) else f'''coalesce(CAST({a} AS STRING), '')''' for a in c.args)})"


def _regexp_replace(c: Call) -> str:
    s, pattern, new = c.args[:3]
    options = string_value(c.args[3]) if len(c.args) > 3 else ""
    flags = "".join(f for f in "is" if f in options)
    if flags:
        pattern = f"concat('(?{flags})', {pattern})"
    if _is_literal(new):  # \1 is $1 in Java, and $ means itself
        out, raw, i = "", string_value(new), 0
        while i < len(raw):
            if raw[i] == "\\" and i + 1 < len(raw):
                out += f"${raw[i + 1]}" if raw[i + 1].isdigit() else raw[i : i + 2]
                i += 2
                continue
            out += "\\$" if raw[i] == "$" else raw[i]
            i += 1
        new = _string(out)
    if "g" in options:
        return f"regexp_replace({s}, {pattern}, {new})"
    # the first match only: what stands before it, its replacement, and the rest
    at, hit = f"regexp_instr({s}, {pattern})", f"regexp_extract({s}, {pattern}, 0)"
    return f"CASE WHEN {at} = 0 THEN {s} ELSE concat(substr({s}, 1, {at} - 1), regexp_replace({hit}, {pattern}, {new}), substr({s}, {at} + length({hit}))) END"


def _regexp_extract(c: Call) -> str:
    return f"regexp_extract({c.args[0]}, {c.args[1]}, {c.args[2] if len(c.args) > 2 else 0})"


def _split(c: Call) -> str:
    return f"split({c.args[0]}, concat('\\\\Q', {c.args[1]}, '\\\\E'))"


def _format(literal: str) -> str:
    return _string(java_pattern(string_value(literal))) if _is_literal(literal) else literal


_SECONDS = {"hour": 3600, "minute": 60, "second": 1}
_MONTHS = {"year": 12, "quarter": 3, "month": 1, "decade": 120, "century": 1200}


def _unit(text: str) -> str:
    unit = string_value(text).lower().rstrip("s") if _is_literal(text) else text.lower()
    return {"yr": "year", "y": "year", "mon": "month", "d": "day", "h": "hour", "hr": "hour", "min": "minute", "m": "minute", "sec": "second", "w": "week"}.get(unit, unit)


def _date_diff(c: Call) -> str:
    """How many borders of the unit lie between."""
    if len(c.args) == 2:
        return f"bigint(datediff({c.args[0]}, {c.args[1]}))"
    unit, a, b = _unit(c.args[0]), c.args[1], c.args[2]
    if unit == "day":
        return f"bigint(datediff({b}, {a}))"
    if unit == "week":
        return f"bigint(datediff({b}, {a}) div 7)"
    if unit in _MONTHS:
        n = _MONTHS[unit]
        month = lambda x: f"(year({x}) * 12 + month({x}) - 1) div {n}"
        return f"bigint({month(b)} - {month(a)})"
    if unit in _SECONDS:
        count = lambda x: f"floor(unix_micros(CAST({x} AS TIMESTAMP)) / {1_000_000 * _SECONDS[unit]})"
        return f"bigint({count(b)} - {count(a)})"
    per = 1 if unit.startswith("microsecond") else 1000
    return f"bigint(unix_micros(CAST({b} AS TIMESTAMP)) div {per} - unix_micros(CAST({a} AS TIMESTAMP)) div {per})"


def _date_sub(c: Call) -> str:
    """How many whole units lie between."""
    if len(c.args) < 3:
        return c.plain("date_sub")
    return f"timestampdiff({_unit(c.args[0]).upper()}, {c.args[1]}, {c.args[2]})"


def _part(c: Call) -> str:
    unit, x = _unit(c.args[0]), c.args[1]
    made = {
        "dow": f"(dayofweek({x}) - 1)", "dayofweek": f"(dayofweek({x}) - 1)", "weekday": f"(dayofweek({x}) - 1)", "isodow": f"(weekday({x}) + 1)", "doy": f"dayofyear({x})",
        "dayofyear": f"dayofyear({x})", "epoch": f"(unix_micros(CAST({x} AS TIMESTAMP)) / 1000000D)", "decade": f"(year({x}) div 10)", "century": f"((year({x}) - 1) div 100 + 1)",
        "millennium": f"((year({x}) - 1) div 1000 + 1)", "isoyear": f"extract(YEAROFWEEK FROM {x})", "second": f"second({x})", "yearweek": f"(extract(YEAROFWEEK FROM {x}) * 100 + weekofyear({x}))",
    }
    return made["epoch"] if unit == "epoch" else f"bigint({made.get(unit, f'date_part({_string(unit)}, {x})')})"


def _between(inclusive: bool) -> Callable[[Call], str]:
    def made(c: Call) -> str:
        a, b, step = ("0", c.args[0], "1") if len(c.args) == 1 else (*c.args[:2], c.args[2] if len(c.args) > 2 else "1")
        a, b, step = (f"bigint({x})" if x.lstrip("-").isdigit() else x for x in (a, b, step))
        if not inclusive:
            test = f"IF({step} > 0, x < {b}, x > {b})" if step.startswith("bigint(") else f"x < {b}"
            series = f"filter(sequence({a}, {b}, {step}), x -> {test})"
        else:
            series = f"sequence({a}, {b}, {step})"
        if step.startswith("bigint("):
            return f"CASE WHEN ({b} - {a}) * {step} >= 0 THEN {series} ELSE CAST(array() AS ARRAY<BIGINT>) END"
        return series

    return made


def _length(c: Call) -> str:
    listed = c.args[0].startswith(("array(", "transform(", "filter(", "split(", "sequence(", "array_", "slice(", "flatten(", "CAST(array"))
    return f"{'size' if listed else 'length'}({c.args[0]})"


def _list_aggregate(c: Call, kind: str | None = None) -> str:
    kind, x = kind or string_value(c.args[1]).lower(), f"filter({c.args[0]}, x -> x IS NOT NULL)"
    if kind in ("min", "max"):
        return f"array_{kind}({c.args[0]})"
    if kind == "count":
        return f"bigint(size({x}))"
    if kind in ("sum", "avg", "mean"):
        total = f"aggregate({x}, CAST(NULL AS DOUBLE), (a, v) -> coalesce(a, 0D) + v)"
        return total if kind == "sum" else f"({total} / size({x}))"
    if kind == "product":
        return f"aggregate({x}, CAST(NULL AS DOUBLE), (a, v) -> coalesce(a, 1D) * v)"
    if kind in ("first", "any_value"):
        return f"try_element_at({x}, 1)"
    if kind == "last":
        return f"try_element_at({x}, -1)"
    if kind == "string_agg":
        return f"array_join({x}, {c.args[2] if len(c.args) > 2 else ''','''})"
    if kind in ("bool_and", "bool_or"):
        return f"{'forall' if kind == 'bool_and' else 'exists'}({x}, v -> v)"
    raise ValueError(f"no aggregate {kind} over a list")


def _struct(c: Call) -> str:
    return f"named_struct({', '.join(f'''{_string(k)}, {v}''' for k, v in c.named.items())})"


def _braces(c: Call) -> str:
    if not _is_literal(c.args[0]):
        return c.plain("format_string")
    return f"format_string({_string(string_value(c.args[0]).replace('%', '%%').replace('{}', '%s'))}, {', '.join(f'CAST({a} AS STRING)' for a in c.args[1:])})"


def _trunc(c: Call) -> str:
    unit = _unit(c.args[0]).upper()
    whole = f"date_trunc('{unit}', {c.args[1]})"
    if unit in ("DECADE", "CENTURY"):
        n = 10 if unit == "DECADE" else 100
        whole = f"make_date(year({c.args[1]}) - year({c.args[1]}) % {n}, 1, 1)"
    return f"CAST({whole} AS TIMESTAMP_NTZ)"


_one: Callable[[str], Callable[[Call], str]] = lambda text: lambda c: text.replace("{0}", c.args[0]).replace("{1}", c.args[1] if len(c.args) > 1 else "").replace("{2}", c.args[2] if len(c.args) > 2 else "")

SCALARS: dict[str, Callable[[Call], str]] = {
    "concat": _concat,
    "regexp_replace": _regexp_replace,
    "regexp_extract": _regexp_extract,
    "regexp_matches": _one("regexp_like({0}, {1})"),
    "regexp_full_match": _one("regexp_like({0}, concat('^(?:', {1}, ')$'))"),
    "string_split": _split,
    "str_split": _split,
    "string_to_array": _split,
    "dayofweek": _one("bigint(dayofweek({0}) - 1)"),
    "weekday": _one("bigint(dayofweek({0}) - 1)"),
    "isodow": _one("bigint(weekday({0}) + 1)"),
    "dayname": _one("date_format({0}, 'EEEE')"),
    "monthname": _one("date_format({0}, 'MMMM')"),
    "yearweek": lambda c: _part(Call("date_part", ["'yearweek'", c.args[0]])),
    "date_diff": _date_diff,
    "datediff": _date_diff,
    "date_sub": _date_sub,
    "datesub": _date_sub,
    "date_part": _part,
    "datepart": _part,
    "date_trunc": _trunc,
    "datetrunc": _trunc,
    "strftime": lambda c: f"date_format({c.args[0]}, {_format(c.args[1])})",
    "strptime": lambda c: f"to_timestamp_ntz({c.args[0]}, {_format(c.args[1])})",
    "try_strptime": lambda c: f"try_to_timestamp({c.args[0]}, {_format(c.args[1])})",
    "epoch": _one("(unix_micros(CAST({0} AS TIMESTAMP)) / 1000000D)"),
    "epoch_ms": lambda c: f"unix_millis(CAST({c.args[0]} AS TIMESTAMP))",
    "epoch_us": lambda c: f"unix_micros(CAST({c.args[0]} AS TIMESTAMP))",
    "range": _between(False),
    "generate_series": _between(True),
    "length": _length,
    "len": _length,
    "array_length": _one("size({0})"),
    "list_length": _one("size({0})"),
    "list_sum": lambda c: _list_aggregate(c, "sum"),
    "list_avg": lambda c: _list_aggregate(c, "avg"),
    "list_product": lambda c: _list_aggregate(c, "product"),
    "list_count": lambda c: _list_aggregate(c, "count"),
    "list_first": lambda c: _list_aggregate(c, "first"),
    "list_last": lambda c: _list_aggregate(c, "last"),
    "list_any_value": lambda c: _list_aggregate(c, "any_value"),
    "list_bool_and": lambda c: _list_aggregate(c, "bool_and"),
    "list_bool_or": lambda c: _list_aggregate(c, "bool_or"),
    "list_string_agg": lambda c: _list_aggregate(Call("", [c.args[0], "", *c.args[1:]]), "string_agg"),
    "list_aggregate": _list_aggregate,
    "list_aggr": _list_aggregate,
    "array_aggregate": _list_aggregate,
    "list_reduce": lambda c: _reduced(c),
    "array_reduce": lambda c: _reduced(c),
    "list_unique": _one("bigint(size(array_distinct(array_compact({0}))))"),
    "list_sort": lambda c: _sorted(c),
    "array_sort": lambda c: c.plain("array_sort") if "->" in "".join(c.args) else _sorted(c),
    "list_reverse_sort": _one("sort_array({0}, false)"),
    "array_reverse_sort": _one("sort_array({0}, false)"),
    "list_position": _one("nullif(array_position({0}, {1}), 0)"),
    "list_indexof": _one("nullif(array_position({0}, {1}), 0)"),
    "list_prepend": _one("array_prepend({1}, {0})"),
    "array_push_front": _one("array_prepend({0}, {1})"),
    "array_push_back": _one("array_append({0}, {1})"),
    "list_has_all": _one("(size(array_except({1}, {0})) = 0)"),
    "list_slice": _one("slice({0}, {1}, greatest(least({2}, size({0})) - {1} + 1, 0))"),
    "array_slice": _one("slice({0}, {1}, greatest(least({2}, size({0})) - {1} + 1, 0))"),
    "list_zip": lambda c: f"arrays_zip({', '.join(c.args)})",
    "unnest": _one("explode({0})"),
    "struct_pack": _struct,
    "struct_extract": _one("{0}[{1}]"),
    "row": lambda c: f"struct({', '.join(c.args)})",
    "map_extract": _one("array_compact(array(try_element_at({0}, {1})))"),
    "element_at": _one("try_element_at({0}, {1})"),
    "cardinality": _one("bigint(size({0}))"),
    "format": _braces,
    "printf": lambda c: c.plain("format_string"),
    "typeof": lambda c: _type_of(c),
    "sha256": _one("sha2({0}, 256)"),
    "trunc": lambda c: _trunc_number(c),
    "xor": _one("({0} ^ {1})"),
    "even": _one("(sign({0}) * ceil(abs({0}) / 2) * 2)"),
    "to_years": _one("make_ym_interval({0}, 0)"),
    "to_months": _one("make_ym_interval(0, {0})"),
    "to_days": _one("make_dt_interval({0})"),
    "to_hours": _one("make_dt_interval(0, {0})"),
    "to_minutes": _one("make_dt_interval(0, 0, {0})"),
    "to_seconds": _one("make_dt_interval(0, 0, 0, {0})"),
    "jaccard": lambda c: f"(double(size(array_intersect(split({c.args[0]}, ''), split({c.args[1]}, '')))) / size(array_union(split({c.args[0]}, ''), split({c.args[1]}, ''))))",
    "isfinite": _one("NOT (isnan({0}) OR abs({0}) = double('Infinity'))"),
    "isinf": _one("(abs({0}) = double('Infinity'))"),
}


def _reduced(c: Call) -> str:
    """Without a start the first element is it."""
    x, f = c.args[:2]
    if len(c.args) > 2:
        return f"reduce({x}, {c.args[2]}, {f})"
    return f"reduce(slice({x}, 2, greatest(size({x}) - 1, 0)), {x}[0], {f})"


def _type_of(c: Call) -> str:
    x = f"typeof({c.args[0]})"
    cases = " ".join(f"WHEN {_string(k)} THEN {_string(v)}" for k, v in NAMES.items())
    return f"CASE {x} {cases} ELSE upper({x}) END"


def _sorted(c: Call) -> str:
    down = len(c.args) > 1 and "desc" in c.args[1].lower()
    first = len(c.args) > 2 and "first" in c.args[2].lower()
    if down != first:
        return f"sort_array({c.args[0]}, {'false' if down else 'true'})" if down or first else f"array_sort({c.args[0]})"
    return f"array_sort({c.args[0]}, (l, r) -> {_before([('', down, first)]).replace('l.k0', 'l').replace('r.k0', 'r')})" if down or first else f"array_sort({c.args[0]})"


def _trunc_number(c: Call) -> str:
    if len(c.args) > 1 and _is_literal(c.args[1]):
        return c.plain("trunc")
    x = c.args[0]
    return f"CASE WHEN {x} < 0 THEN ceil({x}) ELSE floor({x}) END"
