"""Rewrites of the relational dialect into Spark SQL.

Text becomes a tree of tokens and bracketed groups. From the inside out, each level is rewritten:
first its expressions (literals of lists, structs and maps, subscripts, comprehensions, casts,
calls, powers, the null order of ORDER BY), then, where a level is a query, its clauses
(DISTINCT ON, REPLACE, QUALIFY, aliases in WHERE, PIVOT, UNPIVOT, functions and files in FROM).
What Spark parses by itself (FROM-first, GROUP BY ALL, lateral aliases, recursive CTEs, ...) is
left alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..types import SPARK_NAMES
from .calls import AGGREGATES, FUNCTIONS, SCALARS, Call, string_value
from .lexer import Token, find_top, solid, split_top, text, tokens

_FILES = {"parquet": "parquet", "csv": "csv", "tsv": "csv", "json": "json", "ndjson": "json", "jsonl": "json", "orc": "orc", "txt": "text"}
_READERS = {"read_parquet": "parquet", "parquet_scan": "parquet", "read_csv": "csv", "read_csv_auto": "csv", "read_json": "json", "read_json_auto": "json", "read_ndjson": "json"}
_QUERY = frozenset(("SELECT", "WITH", "FROM", "PIVOT", "UNPIVOT", "VALUES"))
#: Bare words after which a bracket begins a literal and a parenthesis is no call.
_WORDS = frozenset(
    """ALL AND ANY AS ASC BETWEEN BY CASE CROSS DESC DISTINCT ELSE END EXCEPT EXISTS FILTER FIRST FROM FULL GROUP HAVING IN INNER INTERSECT INTO IS JOIN LAST LATERAL LEFT LIKE
    LIMIT NATURAL NOT NULLS OFFSET ON OR ORDER OUTER OVER PARTITION QUALIFY RIGHT SELECT SEMI ANTI SET SOME TABLE THEN TO UNION USING VALUES WHEN WHERE WINDOW WITH WITHIN WITHOUT ILIKE ROLLUP CUBE SETS PIVOT UNPIVOT""".split()
)
#: Words that are calls when a parenthesis follows all the same.
_CALLS = frozenset(("LEFT", "RIGHT", "FIRST", "LAST"))
_ORDER_END = frozenset(("LIMIT", "OFFSET", "ROWS", "RANGE", "GROUPS", "FETCH", "UNION", "INTERSECT", "EXCEPT", "QUALIFY", "WINDOW"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class Group:
    """What stands in brackets."""

    open: str
    items: list[Node]

    kind = "group"
    word = ""

    @property
    def text(self) -> str:
        return self.open + render(self.items) + {"(": ")", "[": "]", "{": "}"}[self.open]


Node = Token | Group


@dataclass
class Context:
    """The session, which PIVOT, REPLACE and files need, and the tables made for one statement."""

    spark: SparkSession | None = None
    frames: dict[str, DataFrame] = field(default_factory=dict)
    names_id: bool = False  # the statement names a column id, as Spark's range gives it
    shown: Callable[[str], DataFrame] | None = None  # the result of a DESCRIBE or SUMMARIZE
    seed: int | None = None  # of random()


def parse(parts: list[Token]) -> list[Node]:
    stack: list[list[Node]] = [[]]
    opened: list[str] = []
    for t in parts:
        if t.kind == "op" and t.text in "([{":
            stack.append([])
            opened.append(t.text)
        elif t.kind == "op" and t.text in ")]}" and opened:
            items = stack.pop()
            stack[-1].append(Group(opened.pop(), items))
        else:
            stack[-1].append(t)
    if opened:
        raise ValueError("a bracket is not closed")
    return stack[0]


def render(nodes: list[Node]) -> str:
    return "".join(n.text for n in nodes)


def _solid(nodes: list[Node]) -> list[Node]:
    return [n for n in nodes if n.kind != "space"]


def _split(nodes: list[Node], on: str = ",") -> list[list[Node]]:
    out: list[list[Node]] = [[]]
    names = False  # between LAMBDA and its colon
    for n in nodes:
        names = n.word == "LAMBDA" or names and n.text != ":"
        if n.kind != "group" and n.word == on and not names:
            out.append([])
        else:
            out[-1].append(n)
    return out if len(out) > 1 or _solid(out[0]) else []


def _next(nodes: list[Node], i: int) -> int:
    """Index of the next node that is no space, or the length."""
    i += 1
    while i < len(nodes) and nodes[i].kind == "space":
        i += 1
    return i


def rewrite(sql: str, spark: SparkSession | None = None, frames: dict[str, DataFrame] | None = None, shown: Callable[[str], DataFrame] | None = None, seed: int | None = None) -> str:
    """Spark SQL for one statement or expression of the dialect.

    ``spark`` finds the values of a PIVOT and the columns of a REPLACE; ``frames`` takes the
    tables that readers in FROM stand for, by the name they get in the text; ``shown`` runs a
    DESCRIBE or SUMMARIZE in FROM; ``seed`` is that of ``random()``.
    """
    parts = tokens(sql.strip().rstrip(";"))
    context = Context(spark, {} if frames is None else frames, any(t.word == "ID" for t in parts), shown, seed)
    return _level(parse(parts), context)


def _level(nodes: list[Node], context: Context) -> str:
    """One level: a query or expressions."""
    flat = _solid(nodes)
    first = flat[0].word if flat else ""
    if first == "WITH":
        return _with(nodes, context)
    if first == "PIVOT":
        return _pivot(tokens(render(_expressions(nodes, context, False))), context.spark)
    if first == "UNPIVOT":
        return _unpivot(tokens(render(_expressions(nodes, context, False))))
    done = tokens(render(_expressions(nodes, context, first in _QUERY)))
    if first not in _QUERY and not any(t.word == "SELECT" for t in done):
        return text(done)
    return _arms(done, context)


def _with(nodes: list[Node], context: Context) -> str:
    """``WITH a AS (...), ... query``: the query on its own; the tables are groups."""
    at = 0
    for i, n in enumerate(nodes):
        if n.kind != "group" and n.word in _QUERY - {"WITH"}:
            at = i
            break
    return render(_expressions(nodes[:at], context, True)) + _level(nodes[at:], context)


# --------------------------------------------------------------------------- expressions


def _expressions(nodes: list[Node], context: Context, query: bool) -> list[Node]:
    """Literals, subscripts, casts, calls, powers and orders of one level."""
    out: list[Node] = []
    clause = ""
    i = 0
    while i < len(nodes):
        n = nodes[i]
        before = next((x for x in reversed(out) if x.kind != "space"), Token("op", ""))
        after = nodes[_next(nodes, i)] if _next(nodes, i) < len(nodes) else Token("op", "")
        if n.kind == "group":
            out.append(_group(n, before, out, context))
        elif n.kind == "string":
            if query and clause == "FROM" and before.word in ("FROM", "JOIN", ",") and (made := _file(n, context)):
                n = made
            elif before.word.lower() == "e" and before.kind == "name" and nodes[i - 1] is before:
                out.pop()  # an escape string is Spark's plain one
            else:
                n = Token("string", _literal(n.text))
            out.append(n)
        elif n.kind == "op" and n.text == "::":
            end, kind = _type(nodes, _next(nodes, i))
            out += [n, Token("name", kind)]
            i = end
            continue
        elif n.kind == "op" and n.text == "//":
            out.append(Token("op", " div "))
        elif n.kind == "name":
            if query and n.word in ("SELECT", "FROM", "WHERE", "GROUP", "HAVING", "ORDER", "QUALIFY", "LIMIT", "WINDOW"):
                clause = n.word
            if n.text[0] == '"':
                n = Token("name", quoted(n.text[1:-1].replace('""', '"')))
            if isinstance(after, Group) and after.open == "(" and (n.word not in _WORDS or n.word in _CALLS) and before.word not in (".", "AS", "TABLE", "INTO", "VIEW") and not (before.text == "*" and n.word in ("EXCLUDE", "EXCEPT")) and not (n.word == "REPLACE" and any(x.kind == "name" and x.word == "AS" for x in after.items)):
                if query and clause == "FROM" and before.word in ("FROM", "JOIN", ",", "LATERAL"):
                    i, made = _table_function(nodes, i, context)
                else:
                    i, made = _call(nodes, i, context)
                out.append(made)
                continue
            if query and n.word == "PIVOT" and clause == "FROM" and isinstance(after, Group) and any(x.kind == "name" and x.word == "GROUP" for x in after.items):
                i = _next(nodes, i)
                at = next(j for j, x in enumerate(after.items) if x.kind == "name" and x.word == "FOR")
                words = f"PIVOT {_primary(out)} USING {render(after.items[:at])} ON {render(after.items[at + 1 :])}"
                out.append(Token("expr", f"({_level(parse(tokens(words)), context)})"))
            elif n.word in ("EXCLUDE", "EXCEPT") and before.text == "*":
                out.append(Token("name", "EXCEPT"))
                if after.kind == "name":
                    i = _next(nodes, i)
                    out += [Token("space", " "), Token("expr", f"({_name(nodes[i])})")]
            elif n.word == "MAP" and isinstance(after, Group) and after.open == "{":
                i = _next(nodes, i)
                pairs = [_pair(p, context) for p in _split(after.items)]
                out.append(Token("expr", f"map({', '.join(f'{k}, {v}' for k, v in pairs)})"))
            elif n.word == "ARRAY" and isinstance(after, Group) and after.open == "[":
                pass
            elif n.word == "LAMBDA" and after.kind == "name":
                i, made = _lambda(nodes, i, context)
                out.append(made)
                continue
            else:
                out.append(n)
        else:
            out.append(n)
        i += 1
    return _ordered(_operators(out))


def _name(n: Node) -> str:
    return quoted(n.text[1:-1].replace('""', '"')) if n.text[0] == '"' else n.text


def _literal(t: str) -> str:
    """A string with a backslash as such, which Spark would take for an escape."""
    return t.replace("\\", "\\\\")


def _inside(nodes: list[Node], context: Context) -> str:
    return _level(nodes, context).strip()


def _pair(nodes: list[Node], context: Context) -> tuple[str, str]:
    """``key: value``."""
    at = next(i for i, n in enumerate(nodes) if n.kind == "op" and n.text == ":")
    return _inside(nodes[:at], context), _inside(nodes[at + 1 :], context)


def _group(n: Group, before: Node, out: list[Node], context: Context) -> Node:
    if n.open == "(":
        flat = _solid(n.items)
        if flat and flat[0].word in ("DESCRIBE", "SUMMARIZE") and context.shown is not None:
            name = f"__read_{len(context.frames)}"
            context.frames[name] = context.shown(render(n.items).strip())
            return Token("expr", name)
        return Group("(", tokens(_level(n.items, context)))
    if n.open == "{":
        pairs = []
        for p in _split(n.items):
            key, value = _pair(p, context)
            pairs.append((key if key.startswith("'") else "'" + key.strip("`") + "'", value))
        return Token("expr", f"named_struct({', '.join(f'{k}, {v}' for k, v in pairs)})")
    subscript = before.kind in ("group", "expr", "string") or before.kind == "name" and before.word not in _WORDS
    if not subscript:
        return _list(n, context)
    base = _primary(out)
    items = _solid(n.items)
    cut = next((i for i, x in enumerate(n.items) if x.kind == "op" and x.text == ":"), -1)
    if cut >= 0:
        low, high = _inside(n.items[:cut], context) or "1", _inside(n.items[cut + 1 :], context)
        high = f"least({high}, size({base}))" if high else f"size({base})"
        return Token("expr", f"slice({base}, {low}, greatest({high} - {low} + 1, 0))")
    if len(items) == 1 and items[0].kind == "string":
        return Token("expr", f"{base}[{_literal(items[0].text)}]")
    place = _inside(n.items, context)
    if not place.lstrip("-").isdigit() and not base.startswith("map("):
        place = f"nullif({place}, 0)"  # a list has no element 0
    return Token("expr", f"try_element_at({base}, {place})")


def _primary(out: list[Node]) -> str:
    """Takes the last operand off ``out``: a name with dots, a literal, a group or a call."""
    while out and out[-1].kind == "space":
        out.pop()
    taken = [out.pop()]
    while len(out) > 1 and out[-1].kind == "op" and out[-1].text == ".":
        taken += [out.pop(), out.pop()]
    return render(taken[::-1])


def _list(n: Group, context: Context) -> Node:
    words = [x.word if x.kind != "group" else "" for x in n.items]
    if "FOR" in words:  # [e for x in list if test]
        at = words.index("FOR")
        inside = words.index("IN", at)
        test = words.index("IF", inside) if "IF" in words[inside:] else len(words)
        name, source = render(n.items[at + 1 : inside]).strip(), _inside(n.items[inside + 1 : test], context)
        if test < len(words):
            source = f"filter({source}, {name} -> {_inside(n.items[test + 1 :], context)})"
        return Token("expr", f"transform({source}, {name} -> {_inside(n.items[:at], context)})")
    return Token("expr", f"array({', '.join(_inside(p, context) for p in _split(n.items))})")


def _lambda(nodes: list[Node], i: int, context: Context) -> tuple[int, Node]:
    """``lambda x, y: e`` up to the end of this argument, which is the level's."""
    at = next(j for j in range(i, len(nodes)) if nodes[j].kind == "op" and nodes[j].text == ":")
    names = render(nodes[i + 1 : at]).strip()
    names = names if "," not in names else f"({names})"
    return len(nodes), Token("expr", f"{names} -> {_inside(nodes[at + 1 :], context)}")


def _type(nodes: list[Node], i: int) -> tuple[int, str]:
    """The type that begins at ``i``, in Spark's words, and the index after it."""
    from ..types import data_type

    end = i + 1
    if end < len(nodes) and isinstance(nodes[end], Group) and nodes[end].open == "(":
        end += 1
    while (j := end) < len(nodes) and isinstance(nodes[j], Group) and nodes[j].open == "[":
        end += 1
    words = [n.word for n in nodes[i:] if n.kind != "space"][:4]
    if words[:2] == ["DOUBLE", "PRECISION"]:
        return _next(nodes, i) + 1, "DOUBLE"
    if words[:4] == ["TIMESTAMP", "WITH", "TIME", "ZONE"]:
        for _ in range(3):
            i = _next(nodes, i)
        return i + 1, "TIMESTAMP"
    given = render(nodes[i:end]).strip().strip('"`')
    if end == i + 1:
        return end, SPARK_NAMES.get(given.upper(), given)
    try:
        return end, data_type(given).simpleString()
    except Exception:  # a type only Spark knows
        return end, given


def _call(nodes: list[Node], i: int, context: Context) -> tuple[int, Node]:
    """A function with what belongs to it: WITHIN GROUP, IGNORE NULLS, FILTER, OVER."""
    name = nodes[i].text.strip('`"').lower()
    i = _next(nodes, i)
    items = nodes[i].items
    i += 1
    if name in ("cast", "try_cast"):
        at = max(j for j, n in enumerate(items) if n.kind == "name" and n.word == "AS")
        _, kind = _type(items, _next(items, at))
        return i, Token("expr", f"{name}({_inside(items[:at], context)} AS {kind})")
    tail, filter_ = "", ""
    while (j := _next(nodes, i - 1)) < len(nodes):
        word, follow = nodes[j].word if nodes[j].kind == "name" else "", _next(nodes, j)
        group = nodes[follow] if follow < len(nodes) else None
        if word in ("IGNORE", "RESPECT") and group is not None and group.word == "NULLS":
            tail += f" {word} NULLS"
        elif word == "WITHIN":
            follow = _next(nodes, follow)
            tail += f" WITHIN GROUP {_group(nodes[follow], Token('op', ''), [], context).text}"
        elif word == "FILTER" and isinstance(group, Group):
            inner = _solid(group.items)
            test = group.items if inner[0].word != "WHERE" else group.items[_next(group.items, -1) + 1 :]
            filter_ = f" FILTER (WHERE {_inside(test, context)})"
        elif word == "OVER":
            tail += f" OVER {_group(group, Token('op', ''), [], context).text if isinstance(group, Group) else group.text}"
        else:
            break
        i = follow + 1
    if name == "extract":
        at = next(j for j, n in enumerate(items) if n.kind == "name" and n.word == "FROM")
        name, items = "date_part", [Token("string", "'" + render(items[:at]).strip().strip("'") + "'"), Token("op", ","), *items[at + 1 :]]
    elif name == "position" and any(n.word == "IN" for n in items if n.kind == "name"):
        at = next(j for j, n in enumerate(items) if n.kind == "name" and n.word == "IN")
        name, items = "instr", [*items[at + 1 :], Token("op", ","), *items[:at]]
    elif name in ("trim", "substring", "overlay") and any(n.kind == "name" and n.word in ("FROM", "PLACING", "BOTH", "LEADING", "TRAILING") for n in items):
        return i, Token("expr", f"{name}({_inside(items, context)}){tail}")
    if _solid(items) and _solid(items)[0].word in _QUERY:
        return i, Token("expr", f"{name}({_inside(items, context)}){tail}")
    words = [n.word if n.kind == "name" else "" for n in items if n.kind != "space"]
    if words[-1:] == ["NULLS"] and words[-2:-1] in (["IGNORE"], ["RESPECT"]):
        tail = f" {words[-2]} NULLS{tail}"
        items = items[: max(j for j, n in enumerate(items) if n.kind == "name" and n.word == words[-2])]
    order: list[Node] = []
    at = next((j for j, n in enumerate(items) if n.kind == "name" and n.word == "ORDER" and items[_next(items, j) :] and items[_next(items, j)].word == "BY"), -1)
    if at >= 0:
        order, items = items[_next(items, at) + 1 :], items[:at]
    distinct = bool(_solid(items)) and _solid(items)[0].word == "DISTINCT"
    if distinct:
        items = items[_next(items, -1) + 1 :]
    args, named = [], {}
    for a in _split(items):
        flat = _solid(a)
        if len(flat) > 2 and flat[0].kind == "name" and flat[1].text in (":=", "=>") or len(flat) > 2 and flat[0].kind == "name" and flat[1].text == "=" and name in _READERS:
            cut = next(j for j, n in enumerate(a) if n.text == flat[1].text)
            named[flat[0].text.strip('"`')] = _inside(a[cut + 1 :], context)
            args.append(named[flat[0].text.strip('"`')])
        else:
            args.append(_inside(a, context))
    keys = [_key(p, context) for p in _split(order)]
    if name == "random" and not args and context.seed is not None:
        args = [str(context.seed)]
    call = Call(name, args, distinct, keys, filter_, tail, named)
    if name in AGGREGATES:
        return i, Token("expr", AGGREGATES[name](call))
    if name in SCALARS:
        return i, Token("expr", SCALARS[name](call))
    return i, Token("expr", call.plain(FUNCTIONS.get(name, _callable(name))))


def _callable(name: str) -> str:
    return name if name.replace("_", "").isalnum() else quoted(name)


def _key(item: list[Node], context: Context) -> tuple[str, bool, bool]:
    """An item of an order: expression, descending, NULLs first."""
    words = [n.word if n.kind == "name" else "" for n in item]
    end = min((words.index(w) for w in ("ASC", "DESC", "NULLS") if w in words), default=len(item))
    return _inside(item[:end], context), "DESC" in words, "NULLS" in words and "FIRST" in words


def _operators(nodes: list[Node]) -> list[Node]:
    """``a ** b``, ``a ^ b``, ``a ~ b`` and SIMILAR TO as calls."""
    out: list[Node] = []
    i = 0
    while i < len(nodes):
        n = nodes[i]
        power = n.kind == "op" and n.text in ("**", "^")
        match = n.kind == "op" and n.text == "~" and out and next((x for x in reversed(out) if x.kind != "space"), n).kind in ("name", "expr", "group", "string")
        similar = n.kind == "name" and n.word == "SIMILAR" and _next(nodes, i) < len(nodes) and nodes[_next(nodes, i)].word == "TO"
        if not (power or match or similar):
            out.append(n)
            i += 1
            continue
        negated = False
        while similar and out and (out[-1].kind == "space" or out[-1].word == "NOT"):
            negated |= out.pop().word == "NOT"
        left = _primary(out)
        i = _next(nodes, _next(nodes, i) if similar else i)
        right = []
        while i < len(nodes) and nodes[i].kind == "op" and nodes[i].text in "+-":
            right.append(nodes[i])
            i += 1
        right.append(nodes[i])
        i += 1
        while i + 1 < len(nodes) and nodes[i].kind == "op" and nodes[i].text == ".":
            right += nodes[i : i + 2]
            i += 2
        pattern = f"concat('^(?:', {render(right)}, ')$')" if similar else render(right)
        made = f"power({left}, {render(right)})" if power else f"{'NOT ' if negated else ''}regexp_like({left}, {pattern})"
        out.append(Token("expr", made))
    return out


def _ordered(nodes: list[Node]) -> list[Node]:
    """ORDER BY with NULLs last, whatever the direction, where nothing else is said."""
    out: list[Node] = []
    i = 0
    while i < len(nodes):
        n = nodes[i]
        out.append(n)
        j = _next(nodes, i)
        i += 1
        if n.kind == "name" and n.word == "ORDER" and j < len(nodes) and nodes[j].word == "BY":
            end = j + 1
            while end < len(nodes) and not (nodes[end].kind == "name" and nodes[end].word in _ORDER_END):
                end += 1
            items = []
            for item in _split(nodes[j + 1 : end]):
                said = any(x.kind == "name" and x.word == "NULLS" for x in item)
                items.append(render(item).strip() + ("" if said else " NULLS LAST"))
            out.append(Token("expr", f" BY {', '.join(items)} "))
            i = end
    return out


# --------------------------------------------------------------------------- tables


def _file(t: Token, context: Context) -> Token | None:
    path = t.text[1:-1].replace("''", "'")
    ends = path.removesuffix(".gz").rsplit(".", 1)
    kind = _FILES.get(ends[1].lower()) if len(ends) == 2 else None
    if kind is None:
        return None
    if kind in ("csv", "json") and context.spark is not None:
        return Token("name", _read(kind, path, {}, context))
    return Token("name", f"{kind}.{quoted(path)}")


def _read(kind: str, path: object, options: dict, context: Context) -> str:
    from ..sources import readers

    name = f"__read_{len(context.frames)}"
    context.frames[name] = getattr(readers, f"read_{kind}")(context.spark, path, **options)
    return name


def _table_function(nodes: list[Node], i: int, context: Context) -> tuple[int, Node]:
    """A function in FROM: series, unnest, readers; others are Spark's."""
    name = nodes[i].text.strip('`"').lower()
    i = _next(nodes, i)
    items = nodes[i].items
    i += 1
    if name in _READERS and context.spark is not None:
        path, options = None, {}
        for a in _split(items):
            flat = _solid(a)
            if len(flat) > 2 and flat[1].text in ("=", ":=", "=>"):
                cut = next(j for j, n in enumerate(a) if n.text == flat[1].text)
                options[flat[0].text.lower()] = _value(a[cut + 1 :])
            else:
                path = _value(a)
        return i, Token("expr", _read(_READERS[name], path, options, context))
    if name == "repeat_row":
        *values, last = _split(items)
        at = next(j for j, n in enumerate(last) if n.text in (":=", "=", "=>"))
        row = ", ".join(f"{_inside(v, context)} AS column{k}" for k, v in enumerate(values))
        return i, Token("expr", f"(SELECT {row} FROM range({_inside(last[at + 1 :], context)}))")
    args = [_inside(p, context) for p in _split(items)]
    if name == "unnest":
        return i, Token("expr", f"(SELECT explode({args[0]}) AS unnest)")
    if name in ("range", "generate_series"):
        plain = name == "range" and all(a.lstrip("-").isdigit() for a in args)
        if plain and context.names_id:
            return i, Token("expr", f"range({', '.join(args)})")
        source = f"(SELECT id AS range FROM range({', '.join(args)}))" if plain else f"(SELECT explode({SCALARS[name](Call(name, args))}) AS {name})"
        return i, Token("expr", source)
    return i, Token("expr", f"{name}({', '.join(args)})")


def arguments(text_: str) -> list | dict:
    """The literals of an argument list, by position or, all of them, by name."""
    items = [_solid(p) for p in _split(parse(tokens(text_)))]
    if items and all(len(p) > 2 and p[1].text in (":=", "=>") for p in items):
        return {p[0].text: _value(p[2:]) for p in items}
    return [_value(p) for p in items]


def _value(nodes: list[Node]) -> object:
    """A literal in Python: text, number, truth, list or map."""
    flat = _solid(nodes)
    if len(flat) == 1 and flat[0].kind == "string":
        return string_value(flat[0].text)
    if len(flat) == 1 and isinstance(flat[0], Group) and flat[0].open == "[":
        return [_value(p) for p in _split(flat[0].items)]
    if len(flat) == 1 and isinstance(flat[0], Group):
        out = {}
        for p in _split(flat[0].items):
            at = next(j for j, n in enumerate(p) if n.text in (":", "="))
            key = _solid(p[:at])[0]
            out[string_value(key.text) if key.kind == "string" else key.text.strip('"')] = _value(p[at + 1 :])
        return out
    said = render(nodes).strip()
    if said.lower() in ("true", "false"):
        return said.lower() == "true"
    return None if said.lower() == "null" else float(said) if "." in said else int(said)


# --------------------------------------------------------------------------- clauses of a query


def _arms(parts: list[Token], context: Context) -> str:
    """Each side of UNION, INTERSECT and EXCEPT on its own."""
    out, arm, depth = "", [], 0
    flat = [i for i, t in enumerate(parts) if t.kind != "space"]
    before = {i: parts[flat[n - 1]] if n else None for n, i in enumerate(flat)}
    for i, t in enumerate(parts):
        depth += (t.kind == "op" and t.text in "([{") - (t.kind == "op" and t.text in ")]}")
        if depth == 0 and t.kind == "name" and t.word in ("UNION", "INTERSECT", "EXCEPT") and before[i] is not None and before[i].text != "*":
            out, arm = out + _select(arm, context) + t.text, []
        else:
            arm.append(t)
    return out + _select(arm, context)


def _select(parts: list[Token], context: Context) -> str:
    if find_top(parts, "SELECT") < 0:
        return text(parts)
    parts = _star_replace(parts, context)
    parts = _distinct_on(parts)
    parts = _qualify(parts)
    return text(_where_alias(parts, context))


def _closing(parts: list[Token], at: int) -> int:
    """Index of the parenthesis that closes the one at ``at``."""
    depth = 0
    for i in range(at, len(parts)):
        depth += (parts[i].kind == "op" and parts[i].text == "(") - (parts[i].kind == "op" and parts[i].text == ")")
        if depth == 0:
            return i
    raise ValueError("a bracket is not closed")


def _star_replace(parts: list[Token], context: Context) -> list[Token]:
    """``* [EXCEPT (c)] REPLACE (e AS c)``: the columns of the source with ``e`` in its place."""

    def after(i: int) -> int:
        return next((j for j in range(i + 1, len(parts)) if parts[j].kind != "space"), len(parts) - 1)

    for star, t in enumerate(parts):
        if t.kind != "op" or t.text != "*":
            continue
        at, gone = after(star), set()
        if parts[at].word == "EXCEPT" and parts[after(at)].text == "(":
            end = _closing(parts, after(at))
            gone = {text(c).strip().strip("`").lower() for c in split_top(parts[after(at) + 1 : end], ",")}
            at = after(end)
        if parts[at].word != "REPLACE" or parts[after(at)].text != "(":
            continue
        end, new = _closing(parts, after(at)), {}
        for item in split_top(parts[after(at) + 1 : end], ","):
            cut = max(j for j, x in enumerate(item) if x.word == "AS")
            new[text(item[cut + 1 :]).strip().strip("`").lower()] = text(item[:cut]).strip()
        if context.spark is None:
            raise ValueError("a session is needed to find the columns of REPLACE")
        names = _columns(f"SELECT * {_source(parts)}", context)
        items = [f"{new[c.lower()]} AS {quoted(c)}" if c.lower() in new else quoted(c) for c in names if c.lower() not in gone]
        return _star_replace([*parts[:star], *tokens(", ".join(items)), *parts[end + 1 :]], context)
    return parts


def _source(parts: list[Token]) -> str:
    """The FROM clause of a SELECT."""
    source = find_top(parts, "FROM")
    stop = find_top(parts, "WHERE", "GROUP", "HAVING", "QUALIFY", "ORDER", "LIMIT", "WINDOW", start=source)
    return text(parts[source : stop if stop >= 0 else len(parts)])


def _columns(sql: str, context: Context) -> list[str]:
    """Columns of a query, some of whose tables may be readers'."""
    used = {k: v for k, v in context.frames.items() if k in sql}
    for k, v in used.items():
        v.createOrReplaceTempView(k)
    try:
        return context.spark.sql(sql).columns
    finally:
        for k in used:
            context.spark.catalog.dropTempView(k)


def _distinct_on(parts: list[Token]) -> list[Token]:
    """``DISTINCT ON (k) ...``: the first row of each ``k`` in the query's order."""
    select = find_top(parts, "SELECT")
    flat = [i for i in range(select + 1, len(parts)) if parts[i].kind != "space"]
    if len(flat) < 3 or parts[flat[0]].word != "DISTINCT" or parts[flat[1]].word != "ON":
        return parts
    end = _closing(parts, flat[2])
    keys = text(parts[flat[2] + 1 : end])
    order, limit = find_top(parts, "ORDER", start=end), find_top(parts, "LIMIT", "OFFSET", start=end)
    limit = len(parts) if limit < 0 else limit
    stop = order if order >= 0 else limit
    source = find_top(parts, "FROM", start=end)
    by = text(parts[order:limit]) if order >= 0 else f"ORDER BY {keys}"
    inner = f"SELECT {text(parts[end + 1 : source])}, row_number() OVER (PARTITION BY {keys} {by}) AS __place {text(parts[source:stop])}"
    tail = text(parts[order:] if order >= 0 else parts[limit:])
    return [*parts[:select], *tokens(f"SELECT * EXCEPT (__place) FROM ({inner}) WHERE __place = 1 {tail}")]


def _aliases(parts: list[Token], select: int, source: int, plain: bool = False) -> dict[str, list[Token]]:
    """Aliases of items that are more than a column (``plain``: of any item), with their expressions."""
    out: dict[str, list[Token]] = {}
    for item in split_top(parts[select + 1 : source], ","):
        flat = solid(item)
        if len(flat) < 3 or flat[-2].word != "AS" or flat[-1].kind != "name":
            continue
        if plain or len(flat) > 3 and any(t.kind in ("op", "number") and t.text not in ".," for t in flat[:-2]):
            at = max(i for i, t in enumerate(item) if t.word == "AS")
            out[flat[-1].word] = item[:at]
    return out


def _put(parts: list[Token], aliases: dict[str, list[Token]], used: set[str]) -> list[Token]:
    out: list[Token] = []
    for t in parts:
        out += tokens(f"({text(aliases[t.word]).strip()})") if t.kind == "name" and t.word in aliases and t.word not in used else [t]
    return out


def _qualify(parts: list[Token]) -> list[Token]:
    """``... QUALIFY p`` as a filter on a subquery that has ``p`` as a column."""
    at = find_top(parts, "QUALIFY")
    if at < 0:
        return parts
    select = find_top(parts, "SELECT")
    source = find_top(parts, "FROM", start=select)
    source = at if source < 0 else source
    end = find_top(parts, "ORDER", "LIMIT", "OFFSET", "WINDOW", start=at)
    end = len(parts) if end < 0 else end
    items = parts[select + 1 : source]
    distinct = bool(solid(items)) and solid(items)[0].word == "DISTINCT"
    if distinct:
        items = items[next(i for i, t in enumerate(items) if t.word == "DISTINCT") + 1 :]
    test = _put(parts[at + 1 : end], _aliases([*parts[:select], parts[select], *items], select, select + 1 + len(items)), set())
    named = ""
    if end < len(parts) and parts[end].word == "WINDOW":
        stop = find_top(parts, "ORDER", "LIMIT", "OFFSET", start=end)
        stop = len(parts) if stop < 0 else stop
        named, end = text(parts[end:stop]), stop
    inner = [*items, Token("op", ", ("), *test, Token("op", ") AS __qualify "), *parts[source:at], *tokens(f" {named}")]
    return [*parts[:select], *tokens(f"SELECT {'DISTINCT ' if distinct else ''}* EXCEPT (__qualify) FROM (SELECT {text(inner)}) WHERE __qualify "), *parts[end:]]


def _where_alias(parts: list[Token], context: Context) -> list[Token]:
    """``SELECT e AS a FROM t WHERE a < 1``: the alias's expression in its place in WHERE.

    A column of the source with the same name keeps its meaning; for an alias of a plain column
    the source is asked.
    """
    select, source, where = find_top(parts, "SELECT"), find_top(parts, "FROM"), find_top(parts, "WHERE")
    if not 0 <= select < source < where:
        return parts
    end = find_top(parts, "GROUP", "HAVING", "ORDER", "LIMIT", "WINDOW", "UNION", start=where)
    end = len(parts) if end < 0 else end
    asked = {t.word for t in parts[where + 1 : end] if t.kind == "name"}
    aliases = _aliases(parts, select, source)
    plain = {k: v for k, v in _aliases(parts, select, source, plain=True).items() if k not in aliases and k in asked and [t.word for t in solid(v)] != [k]}
    if plain and context.spark is not None:
        try:
            own = {c.upper() for c in _columns(f"SELECT * {_source(parts)}", context)}
        except Exception:  # a table of the query's own WITH: its columns aren't known here
            own = set(plain)
        aliases |= {k: v for k, v in plain.items() if k not in own}
    if not aliases:
        return parts
    used = {t.word for t in solid(parts[:select] + parts[source:where])}
    return [*parts[: where + 1], *_put(parts[where + 1 : end], aliases, used), *parts[end:]]


def _clauses(parts: list[Token], words: tuple[str, ...]) -> dict[str, list[Token]]:
    """What follows each of ``words`` up to the next one."""
    places = sorted((i, w) for w in words if (i := find_top(parts, w)) >= 0)
    ends = [i for i, _ in places[1:]] + [len(parts)]
    return {w: parts[i + 1 : e] for (i, w), e in zip(places, ends, strict=True)}


def _pivot(parts: list[Token], spark: SparkSession | None) -> str:
    """``PIVOT t ON c [IN (...)] USING agg [GROUP BY g]`` as Spark's PIVOT clause."""
    got = _clauses(parts, ("PIVOT", "ON", "USING", "GROUP", "ORDER", "LIMIT"))
    source, on, using = text(got["PIVOT"]).strip(), got["ON"], text(got.get("USING", [])).strip() or "count(*)"
    groups = [text(g).strip() for g in split_top([t for t in got["GROUP"] if t.word != "BY"], ",")] if "GROUP" in got else []
    if (at := find_top(on, "IN")) >= 0:
        column, values = text(on[:at]).strip(), text(on[at + 1 :]).strip()[1:-1]
    else:
        column = text(on).strip()
        if spark is None:
            raise ValueError("a session is needed to find the values of PIVOT")
        found = [r[0] for r in spark.sql(f"SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL ORDER BY 1").collect()]
        values = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v) for v in found)
    used = [t.text for t in tokens(using) if t.kind == "name" and t.word not in ("AS",)][1:]
    columns = ", ".join(dict.fromkeys([*groups, column, *used])) if groups else "*"
    tail = "".join(f" {w} {text(got[w]).strip()}" for w in ("ORDER", "LIMIT") if w in got)
    return f"SELECT * FROM (SELECT {columns} FROM {source}) PIVOT ({using} FOR {column} IN ({values})){tail}"


def _unpivot(parts: list[Token]) -> str:
    """``UNPIVOT t ON a, b INTO NAME n VALUE v`` as Spark's UNPIVOT clause."""
    got = _clauses(parts, ("UNPIVOT", "ON", "INTO", "ORDER", "LIMIT"))
    into = [t.text for t in solid(got.get("INTO", tokens("NAME name VALUE value")))]
    tail = "".join(f" {w} {text(got[w]).strip()}" for w in ("ORDER", "LIMIT") if w in got)
    return f"SELECT * FROM {text(got['UNPIVOT']).strip()} UNPIVOT ({into[3]} FOR {into[1]} IN ({text(got['ON']).strip()})){tail}"


# --------------------------------------------------------------------------- parameters


def marked(sql: str) -> str:
    """``$1`` and ``?`` as ``?``, ``$name`` as ``:name``."""
    out = []
    for t in tokens(sql):
        if t.kind == "param" and t.text != "?":
            t = Token("param", "?" if t.text[1:].isdigit() else f":{t.text[1:]}")
        out.append(t)
    return text(out)


def parameter_order(sql: str) -> list[int]:
    """Positions of numbered parameters in the order of their marks, from 0."""
    found, plain = [], 0
    for t in tokens(sql):
        if t.kind == "param" and t.text == "?":
            found.append(plain)
            plain += 1
        elif t.kind == "param" and t.text[1:].isdigit():
            found.append(int(t.text[1:]) - 1)
    return found


# --------------------------------------------------------------------------- orders and windows


def order_items(items: str) -> str:
    """``ORDER BY`` items with the relational default: NULLs last, whatever the direction."""
    out = []
    for item in split_top(tokens(items), ","):
        words = [t.word for t in solid(item)]
        out.append(text(item).strip() + ("" if "NULLS" in words else " NULLS LAST"))
    return ", ".join(out)


def window(spec: str) -> str:
    """``over (...)`` with the relational null order, and an order where Spark asks for one."""
    body = spec.strip()
    if body[:4].lower() == "over":
        body = body[4:].strip()
    if body.startswith("(") and body.endswith(")"):
        body = body[1:-1]
    parts = tokens(body)
    at = find_top(parts, "ORDER")
    if at < 0:
        return f"OVER ({body.strip()})"
    frame = find_top(parts, "ROWS", "RANGE", start=at)
    frame = len(parts) if frame < 0 else frame
    items = text(parts[at + 1 : frame]).strip()[2:]
    return f"OVER ({text(parts[:at])}ORDER BY {order_items(items)} {text(parts[frame:])})".replace(" )", ")")


def has_order(spec: str) -> bool:
    return find_top(tokens(spec.strip().removeprefix("over").strip().strip("()")), "ORDER") >= 0
