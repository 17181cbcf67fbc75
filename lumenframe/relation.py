"""Lazy relational algebra: an immutable wrapper of a DataFrame."""

from __future__ import annotations

import functools
import itertools
import re
import time
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expressions import Expression, column_of
from .operators.aggregates import AGGREGATES, ALIASES, aggregate_text, analytic_text
from .plans.dialect import order_items, quoted, rewrite
from .plans.lexer import find_top, solid, split_top, text, tokens
from .sources import writers
from .types import data_type, type_name

_NUMBER = itertools.count(1)
_JOINS = {
    "inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right", "outer": "full", "full": "full", "fullouter": "full",
    "semi": "left_semi", "leftsemi": "left_semi", "anti": "left_anti", "leftanti": "left_anti", "cross": "cross",
}


class Relation:
    """A query that has not run yet; every operator gives a new one."""

    def __init__(self, df: DataFrame, alias: str | None = None, kind: str = "QUERY_RELATION", table: str | None = None, sql: str | None = None) -> None:
        self.dataframe = df
        self.alias = alias or f"unnamed_relation_{next(_NUMBER):x}"
        self.type = kind
        self._table = table
        self._sql = sql
        self._rows: Iterator | None = None
        self._batches: Iterator[pa.RecordBatch] | None = None

    def _new(self, df: DataFrame) -> Relation:
        return Relation(df)

    @property
    def _spark(self):  # noqa: ANN202
        return self.dataframe.sparkSession

    @property
    def _named(self) -> DataFrame:
        return self.dataframe.alias(self.alias)

    # ------------------------------------------------------------------ schema

    @property
    def columns(self) -> list[str]:
        return self.dataframe.columns

    @property
    def types(self) -> list[T.DataType]:
        return [f.dataType for f in self.dataframe.schema]

    dtypes = types

    @property
    def description(self) -> list[tuple]:
        return [(f.name, f.dataType.simpleString(), None, None, None, None, f.nullable) for f in self.dataframe.schema]

    @property
    def shape(self) -> tuple[int, int]:
        return len(self), len(self.columns)

    def __len__(self) -> int:
        return self.dataframe.count()

    def __contains__(self, name: str) -> bool:
        return name.lower() in (c.lower() for c in self.columns)

    def set_alias(self, alias: str) -> Relation:
        return Relation(self.dataframe, alias, self.type, self._table, self._sql)

    def sql_query(self) -> str:
        """The text this relation was made from, or its optimised plan where there is none."""
        return self._sql or self.explain()

    def __getitem__(self, name: str) -> Relation:
        if name in self:
            return self._new(self.dataframe.select(F.col(quoted(name))))
        if len(self.columns) == 1 and isinstance(self.types[0], T.StructType):  # into a struct
            return self._new(self.dataframe.select(F.col(quoted(self.columns[0]))[name].alias(name)))
        raise AttributeError(f"no column {name}")

    def __getattr__(self, name: str) -> Relation:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    # ------------------------------------------------------------------ projection, filter, order

    def _columns(self, exprs: tuple) -> list[Column]:
        if len(exprs) == 1 and isinstance(exprs[0], str):
            return [F.expr(text(p).strip()) if text(p).strip() != "*" else F.col("*") for p in split_top(tokens(rewrite(exprs[0])), ",")]
        out = []
        for e in exprs:
            if isinstance(e, Expression) and e.exclude is not None:
                gone = {n.lower() for n in e.exclude}
                out += [F.col(quoted(c)) for c in self.columns if c.lower() not in gone]
            else:
                out.append(column_of(e))
        return out

    def select(self, *exprs: Any, groups: str = "") -> Relation:
        """A projection; with ``groups`` an aggregation by them."""
        if groups:
            df = self._named
            return self._new(_grouped(df, groups).agg(*self._columns(exprs)).drop("__all"))
        return self._new(self._named.select(*self._columns(exprs)))

    project = select

    def select_types(self, kinds: list) -> Relation:
        if not kinds:
            raise ValueError("no types given")
        wanted = [data_type(k) for k in kinds]
        names = [f.name for f in self.dataframe.schema if f.dataType in wanted]
        if not names:
            raise ValueError("no column has one of these types")
        return self._new(self.dataframe.select(*map(quoted, names)))

    select_dtypes = select_types

    def filter(self, condition: Any) -> Relation:
        return self._new(self._named.where(F.expr(rewrite(condition)) if isinstance(condition, str) else column_of(condition)))

    def order(self, items: str) -> Relation:
        """By SQL items, NULLs last unless said otherwise; ``all`` orders by every column."""
        if items.strip().lower() == "all":
            items = ", ".join(map(quoted, self.columns))
        return self._new(self._named.orderBy(*[_sort_item(i) for i in split_top(tokens(order_items(rewrite(items))), ",")]))

    def sort(self, *exprs: Any) -> Relation:
        return self._new(self._named.orderBy(*[(e if isinstance(e, Expression) else Expression(column_of(e))).sort_column for e in exprs]))

    def limit(self, n: int, offset: int = 0) -> Relation:
        return self._new((self.dataframe.offset(offset) if offset else self.dataframe).limit(n))

    def distinct(self) -> Relation:
        return self._new(self.dataframe.distinct())

    def unique(self, columns: str) -> Relation:
        return self.select(columns).distinct()

    # ------------------------------------------------------------------ aggregation

    def aggregate(self, exprs: Any, group_expr: str = "") -> Relation:
        """Aggregates and bare columns; without ``group_expr`` the bare columns are the groups.

        ``group_expr`` may hold CUBE, ROLLUP and GROUPING SETS.
        """
        items = [text(p).strip() for p in split_top(tokens(rewrite(exprs)), ",")] if isinstance(exprs, str) else [column_of(e) for e in (exprs if isinstance(exprs, (list, tuple)) else [exprs])]
        if group_expr:
            if isinstance(items[0], str):
                return self._sql_on(f"SELECT {', '.join(items)} FROM {{}} GROUP BY {rewrite(group_expr)}")
            return self._new(self._named.groupBy(*[F.expr(text(g).strip()) for g in split_top(tokens(rewrite(group_expr)), ",")]).agg(*items))
        if isinstance(items[0], str):
            return self._sql_on(f"SELECT {', '.join(items)} FROM {{}} GROUP BY ALL")
        return self._new(self._named.groupBy().agg(*items))

    def apply(self, function_name: str, function_aggr: str, group_expr: str = "", function_parameter: str = "", projected_columns: str = "") -> Relation:
        """Aggregate ``function_name`` of each comma-separated column."""
        return self._aggregate(function_name, function_aggr, group_expr, "", projected_columns, function_parameter or None)

    def _aggregate(self, name: str, expression: str, groups: str = "", window_spec: str = "", projected_columns: str = "", p: Any = None, q: Any = None) -> Relation:
        if groups and window_spec:
            raise ValueError("groups and window_spec exclude each other")
        names = [_plain(c) for c in split_top(tokens(expression), ",")] if expression.strip() not in ("", "*") else ["*"]
        if name in ("histogram", "product") and not window_spec and names != ["*"]:
            return self._by_counts(name, names, groups, projected_columns)
        if (known := ALIASES.get(name, name)) in AGGREGATES:
            made = [f"{aggregate_text(known, c, p, q, window_spec)} AS {quoted(_label(name, c))}" for c in names]
        else:
            made = [f"{rewrite(f'{name}({c}' + (f', {p}' if p is not None else '') + ')')} AS {quoted(_label(name, c))}" for c in names]
        head = [x for x in (projected_columns.strip(),) if x]
        if window_spec or not groups:
            return self._sql_on(f"SELECT {', '.join(head + made)} FROM {{}}" + ("" if window_spec or not head else " GROUP BY ALL"))
        head = head or []
        return self._sql_on(f"SELECT {', '.join(head + made)} FROM {{}} GROUP BY {rewrite(groups)}")

    def _by_counts(self, name: str, columns: list[str], groups: str, projected_columns: str) -> Relation:
        """Plain histogram and product: counted or multiplied before rows move, and no list of values."""
        keys = [F.expr(text(g).strip()).alias(f"__k{i}") for i, g in enumerate(split_top(tokens(rewrite(groups)), ",") if groups else [])]
        out, joined = None, [f"__k{i}" for i in range(len(keys))]
        for i, c in enumerate(columns):
            if name == "product":
                one = self._named.groupBy(*keys).agg(F.product(F.expr(c).cast("double")).alias(f"__v{i}"))
            else:
                counts = self._named.select(*keys, F.expr(c).alias("__x")).groupBy(*joined, "__x").agg(F.count("__x").alias("__n"))
                entry = F.when(F.col("__x").isNotNull(), F.struct(F.col("__x").alias("key"), F.col("__n").alias("value")))
                entries = F.array_sort(F.collect_list(entry))
                one = counts.groupBy(*joined).agg(F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias(f"__v{i}"))
            out = one if out is None else _beside(out, one, joined)
        heads = [text(h).strip() for h in split_top(tokens(rewrite(projected_columns)), ",")] if projected_columns.strip() else []
        plain = {text(g).strip(): k for g, k in zip(split_top(tokens(rewrite(groups)), ",") if groups else [], joined, strict=True)}
        missing = [h for h in heads if h not in plain]
        if missing:
            raise ValueError(f"not among the groups: {', '.join(missing)}")
        return self._new(out.select(*[F.col(plain[h]).alias(h.strip("`")) for h in heads], *[F.col(f"__v{i}").alias(_label(name, c)) for i, c in enumerate(columns)]))

    def _sql_on(self, sql: str) -> Relation:
        return self._new(self._spark.sql(sql.replace("{}", "{__rel}"), __rel=self.dataframe) if "{" not in sql.replace("{}", "") else self._through_view(sql))

    def _through_view(self, sql: str) -> DataFrame:
        name = f"__relation_{next(_NUMBER)}"
        self.dataframe.createOrReplaceTempView(name)
        try:
            return self._spark.sql(sql.replace("{}", name))
        finally:  # the text is analysed by now
            self._spark.catalog.dropTempView(name)

    def value_counts(self, expression: str, groups: str = "") -> Relation:
        head = f"{groups}, " if groups else ""
        return self._sql_on(f"SELECT {head}{expression}, count({expression}) AS {quoted(f'count({expression})')} FROM {{}} GROUP BY {head}{expression}")

    def describe(self) -> Relation:
        """count, mean, stddev, min, max and median of each column, as text."""
        kinds = {f.name: f.dataType for f in self.dataframe.schema}
        number = {c for c, k in kinds.items() if isinstance(k, T.NumericType)}
        stats = {
            "count": lambda c: F.count(c), "mean": lambda c: F.avg(c) if c in number else F.lit(None), "stddev": lambda c: F.stddev_samp(c) if c in number else F.lit(None),
            "min": F.min, "max": F.max, "median": lambda c: F.median(c) if c in number else F.lit(None),
        }
        rows = F.array(*[F.struct(F.lit(s).alias("aggr"), *[f(c).cast("string").alias(c) for c in kinds]) for s, f in stats.items()])
        return self._new(self.dataframe.agg(rows.alias("x")).select(F.inline("x")))

    def summarize(self) -> Relation:
        """One row per column: name, type, min, max, approximate distinct values, average, standard
        deviation, quartiles, count and percentage of NULLs."""
        rows = []
        for f in self.dataframe.schema:
            c, number = F.col(quoted(f.name)), isinstance(f.dataType, T.NumericType)
            some = lambda x, number=number: (x if number else F.lit(None)).cast("string")
            nulls = F.when(F.count("*") > 0, F.round(100 * (F.count("*") - F.count(c)) / F.count("*"), 2).cast("decimal(9,2)"))
            plain = not isinstance(f.dataType, (T.MapType, T.VariantType))
            rows.append(F.struct(
                F.lit(f.name).alias("column_name"), F.lit(type_name(f.dataType)).alias("column_type"), (F.min(c) if plain else F.lit(None)).cast("string").alias("min"), (F.max(c) if plain else F.lit(None)).cast("string").alias("max"),
                (F.approx_count_distinct(c) if plain else F.lit(None).cast("long")).alias("approx_unique"), some(F.avg(c)).alias("avg"), some(F.stddev_samp(c) if number else c).alias("std"),
                *[some(F.percentile_approx(c, q) if number else c).alias(n) for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))], F.count("*").alias("count"), nulls.alias("null_percentage"),
            ))
        return self._new(self.dataframe.agg(F.array(*rows).alias("x")).select(F.inline("x")))

    # ------------------------------------------------------------------ joins and sets

    def join(self, other: Relation, condition: Any, how: str = "inner") -> Relation:
        """``condition``: SQL, one common column, a list of columns, or an expression."""
        kind = _JOINS[how.lower().replace("_", "").replace(" ", "")]
        if self.alias.lower() == other.alias.lower():
            raise ValueError("both relations have the same alias; use set_alias")
        left, right = self._named, other._named
        if isinstance(condition, str) and re.fullmatch(r"\s*[\w]+\s*", condition) and condition.strip() in self and condition.strip() in other:
            condition = [condition.strip()]
        if isinstance(condition, (list, tuple)):
            return self._new(left.join(right, [c if isinstance(c, str) else c.get_name() for c in condition], kind))
        on = F.expr(rewrite(condition)) if isinstance(condition, str) else column_of(condition)
        return self._new(left.join(right, on, kind))

    def cross(self, other: Relation) -> Relation:
        return self._new(self._named.crossJoin(other._named))

    def union(self, other: Relation) -> Relation:
        return self._new(self.dataframe.union(other.dataframe))

    def except_(self, other: Relation) -> Relation:
        return self._new(self.dataframe.exceptAll(other.dataframe))

    def intersect(self, other: Relation) -> Relation:
        return self._new(self.dataframe.intersectAll(other.dataframe))

    # ------------------------------------------------------------------ SQL, functions, plans

    def query(self, virtual_table_name: str, sql_query: str) -> Relation:
        """One SELECT over this relation under a name, which hides a table and is gone after it."""
        old = next((t for t in self._spark.catalog.listTables(pattern=virtual_table_name) if t.isTemporary), None)
        kept = self._spark.table(virtual_table_name) if old is not None else None
        self.dataframe.createOrReplaceTempView(virtual_table_name)
        try:
            return self._new(self._spark.sql(rewrite(sql_query, self._spark)))
        finally:
            if kept is not None:
                kept.createOrReplaceTempView(virtual_table_name)
            else:
                self._spark.catalog.dropTempView(virtual_table_name)

    def map(self, map_function: Callable[[pd.DataFrame], pd.DataFrame], schema: Any = None) -> Relation:
        """``map_function`` on pandas frames; without ``schema`` its types come from an empty frame."""
        if schema is None:
            empty = pd.DataFrame({f.name: pd.Series(dtype=_pandas_type(f.dataType)) for f in self.dataframe.schema})
            made = map_function(empty)
            if not isinstance(made, pd.DataFrame):
                raise TypeError("the function must return a DataFrame")
            schema = T.StructType([T.StructField(str(c), data_type(made[c].dtype.type) if made[c].dtype != object else T.StringType()) for c in made.columns])
        elif isinstance(schema, dict):
            schema = T.StructType([T.StructField(n, data_type(t)) for n, t in schema.items()])
        names = [f.name for f in schema] if isinstance(schema, T.StructType) else None

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = map_function(frame)
                if names is not None and list(out.columns) != names:
                    raise ValueError(f"the function returned columns {list(out.columns)}, not {names}")
                yield out

        return self._new(self.dataframe.mapInPandas(run, schema))

    def explain(self, type: str = "standard", format: str | None = None) -> str:  # noqa: A002
        """The plan; ``analyze`` runs the query and says how many rows each operator gave."""
        kind = str(type).lower()
        if kind == "analyze":
            return self._analyzed()
        return self._spark._jvm.PythonSQLUtils.explainString(self.dataframe._jdf.queryExecution(), {"standard": "formatted"}.get(kind, kind))

    def _analyzed(self) -> str:
        run = self.dataframe._jdf.queryExecution()
        began = time.perf_counter()
        total = run.toRdd().count()
        out = [f"{total} rows in {time.perf_counter() - began:.3f} s"]

        def add(node: Any, depth: int) -> None:
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                return add(node.executedPlan(), depth)
            if name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage", "ResultQueryStage"):
                return add(node.plan(), depth)
            rows = node.metrics().get("numOutputRows")
            if name not in ("InputAdapter",) and not name.startswith("WholeStageCodegen"):
                out.append("  " * depth + node.simpleString(200) + (f" [{rows.get().value()} rows]" if rows.isDefined() else ""))
                depth += 1
            children = node.children()
            for i in range(children.size()):
                add(children.apply(i), depth)
            return None

        add(run.executedPlan(), 0)
        return "\n".join(out)

    # ------------------------------------------------------------------ tables and files

    def create(self, table_name: str) -> None:
        self.dataframe.write.saveAsTable(table_name)

    to_table = create

    def create_view(self, view_name: str, replace: bool = True) -> Relation:
        (self.dataframe.createOrReplaceTempView if replace else self.dataframe.createTempView)(view_name)
        return Relation(self._spark.table(view_name), view_name, "VIEW_RELATION", view_name)

    to_view = create_view

    def insert_into(self, table_name: str) -> None:
        self.dataframe.write.insertInto(table_name)

    def insert(self, values: list | tuple) -> None:
        """One row for the table behind this relation."""
        if self._table is None:
            raise ValueError("only a table relation takes rows")
        self._spark.createDataFrame([tuple(values)], self.dataframe.schema).write.insertInto(self._table)

    def update(self, set: dict[str, Any], condition: Any = None) -> None:  # noqa: A002
        """Rewrites the table behind this relation with new values where ``condition`` holds."""
        if self._table is None:
            raise ValueError("only a table relation can be updated")
        test = F.lit(True) if condition is None else F.expr(condition) if isinstance(condition, str) else column_of(condition)
        out = self.dataframe
        old = {c: F.col(quoted(c)) for c in out.columns}
        new = {c.lower(): (F.lit(v) if not isinstance(v, Expression) else v.column) for c, v in set.items()}
        out = out.select(*[F.when(test, new[c.lower()]).otherwise(x).cast(out.schema[c].dataType).alias(c) if c.lower() in new else x for c, x in old.items()])
        writers.replace_table(out, self._table)

    def to_parquet(self, file_name: str, **options: Any) -> None:
        writers.write_parquet(self.dataframe, file_name, **options)

    write_parquet = to_parquet

    def to_csv(self, file_name: str, **options: Any) -> None:
        writers.write_csv(self.dataframe, file_name, **options)

    write_csv = to_csv

    def to_json(self, file_name: str, **options: Any) -> None:
        writers.write_json(self.dataframe, file_name, **options)

    # ------------------------------------------------------------------ results

    def execute(self) -> Relation:
        """Runs the query; its rows are kept for what follows."""
        self.dataframe = self.dataframe.persist()
        self.dataframe.count()
        return self

    def close(self) -> None:
        self.dataframe.unpersist()
        self._rows = self._batches = None

    def _iterate(self) -> Iterator:
        if self._rows is None:
            self._rows = (tuple(r) for r in self.dataframe.toLocalIterator(prefetchPartitions=True))
        return self._rows

    def fetchone(self) -> tuple | None:
        return next(self._iterate(), None)

    def fetchmany(self, size: int = 1) -> list[tuple]:
        return list(itertools.islice(self._iterate(), size))

    def fetchall(self) -> list[tuple]:
        """What is left of the rows; the next call starts anew."""
        if self._rows is not None:
            left, self._rows = list(self._rows), None
            return left
        return [tuple(r) for r in self.dataframe.collect()]

    def fetchnumpy(self) -> dict[str, np.ndarray]:
        """A masked array for each column with NULLs, a plain one for others."""
        out = {}
        for name, col in zip(self.columns, self.to_arrow_table().columns, strict=True):
            values = col.to_pandas().to_numpy()
            out[name] = np.ma.masked_array(values, mask=col.is_null().to_numpy()) if col.null_count else values
        return out

    def df(self, date_as_object: bool = False) -> pd.DataFrame:
        out = self.dataframe.toPandas()
        if not date_as_object:
            for f in self.dataframe.schema:
                if isinstance(f.dataType, T.DateType):
                    out[f.name] = pd.to_datetime(out[f.name])
        return out

    fetchdf = to_df = df

    def fetch_df_chunk(self, vectors_per_chunk: int = 1, date_as_object: bool = False) -> pd.DataFrame:
        """The next rows, 2048 for each vector."""
        rows = self.fetchmany(2048 * vectors_per_chunk)
        return pd.DataFrame(rows, columns=self.columns)

    def to_arrow_table(self, batch_size: int = 1_000_000) -> pa.Table:
        return self.dataframe.toArrow()

    fetch_arrow_table = arrow_table = to_arrow_table

    def to_arrow_reader(self, batch_size: int = 1_000_000) -> pa.RecordBatchReader:
        """The rows as they are read: the driver holds one partition at a time."""

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as out:
                    out.write_batch(b)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["data"])

        def unpacked() -> Iterator[pa.RecordBatch]:
            for row in self.dataframe.mapInArrow(packed, "data binary").toLocalIterator(prefetchPartitions=True):
                for b in pa.ipc.open_stream(row.data):
                    for i in range(0, b.num_rows, batch_size):
                        yield b.slice(i, batch_size)

        batches = unpacked()
        first = next(batches, None)
        if first is None:
            return self.dataframe.limit(0).toArrow().to_reader()
        return pa.RecordBatchReader.from_batches(first.schema, itertools.chain([first], batches))

    fetch_record_batch = fetch_arrow_reader = arrow = record_batch = to_arrow_reader

    def __arrow_c_stream__(self, requested_schema: Any = None) -> Any:
        return self.to_arrow_table().__arrow_c_stream__(requested_schema)

    def pl(self, batch_size: int = 1_000_000, *, lazy: bool = False) -> Any:
        import polars

        out = polars.from_arrow(self.to_arrow_table())
        return out.lazy() if lazy else out

    def torch(self) -> dict[str, Any]:
        import torch

        return {k: torch.from_numpy(np.asarray(v)) for k, v in self.fetchnumpy().items()}

    def tf(self) -> dict[str, Any]:
        import tensorflow

        return {k: tensorflow.convert_to_tensor(np.asarray(v)) for k, v in self.fetchnumpy().items()}

    def show(self, max_width: int | None = None, max_rows: int | None = None, max_col_width: int | None = None, null_value: str | None = None, render_mode: Any = None) -> None:
        self.dataframe.show(max_rows or 40, truncate=max_col_width or 20)

    def __repr__(self) -> str:
        return f"Relation {self.alias}: {self.dataframe.schema.simpleString()}"


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Two aggregates by the same keys, side by side; a NULL key meets its like."""
    if not keys:
        return left.crossJoin(right)  # one row each
    other = right.toDF(*[f"__r{c}" if c in keys else c for c in right.columns])
    on = functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"__r{k}"]) for k in keys])
    return left.join(other, on).drop(*[f"__r{k}" for k in keys])


def _plain(parts: list) -> str:
    """One column or expression, re-quoted; anything that could end the expression is refused."""
    item = text(parts).strip()
    if any(t.text == ";" or t.text.startswith("--") or t.word in ("SELECT", "FROM") for t in parts if t.kind != "string") or not item:
        raise ValueError(f"not a column: {item}")
    return quoted(item) if re.fullmatch(r"[^\W\d]\w*", item) else rewrite(item)


def _label(name: str, column: str) -> str:
    return f"{name}({column.strip('`')})" if column != "*" else f"{name}_star()" if name == "count" else f"{name}(*)"


def _sort_item(parts: list) -> Column:
    words = [t.word for t in solid(parts)]
    end = min((i for i in (find_top(parts, "ASC"), find_top(parts, "DESC"), find_top(parts, "NULLS")) if i >= 0), default=len(parts))
    e = Expression(F.expr(text(parts[:end]).strip()))
    e = e.desc() if "DESC" in words else e.asc()
    return (e.nulls_first() if words[-1] == "FIRST" else e.nulls_last()).sort_column


def _grouped(df: DataFrame, groups: str):  # noqa: ANN202
    return df.groupBy(*[F.expr(text(g).strip()) for g in split_top(tokens(rewrite(groups)), ",")])


def _pandas_type(kind: T.DataType) -> str:
    return {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "float64", "float": "float32", "boolean": "bool"}.get(kind.simpleString(), "object")


# Named aggregates and analytic functions are methods made from one rule each.


def _simple(name: str) -> Callable:
    def method(self: Relation, expression: str = "", groups: str = "", window_spec: str = "", projected_columns: str = "") -> Relation:
        return self._aggregate(name, expression, groups, window_spec, projected_columns)

    method.__doc__ = f"``{name}`` of each comma-separated column, by ``groups`` or over ``window_spec``."
    return method


for _n in ("any_value", "avg", "mean", "bit_and", "bit_or", "bit_xor", "bool_and", "bool_or", "count", "favg", "fsum", "first", "last", "geomean", "histogram", "list", "max", "min", "product", "sum", "median", "mode", "stddev_pop", "stddev_samp", "stddev", "std", "var_pop", "var_samp", "variance", "var"):
    setattr(Relation, _n, _simple(_n))


def _two(name: str) -> Callable:
    def method(self: Relation, arg_column: str, value_column: str, groups: str = "", window_spec: str = "", projected_columns: str = "") -> Relation:
        return self._aggregate(name, arg_column, groups, window_spec, projected_columns, None, value_column)

    return method


Relation.arg_max, Relation.arg_min = _two("arg_max"), _two("arg_min")


def _string_agg(self: Relation, expression: str, sep: str = ",", groups: str = "", window_spec: str = "", projected_columns: str = "") -> Relation:
    return self._aggregate("string_agg", expression, groups, window_spec, projected_columns, "'" + sep.replace("'", "''") + "'")


def _bitstring_agg(self: Relation, expression: str, min: int | None = None, max: int | None = None, groups: str = "", window_spec: str = "", projected_columns: str = "") -> Relation:  # noqa: A002
    """A text with a 1 for each value from ``min`` to ``max`` that is there; both default to the column's."""
    if min is None or max is None:
        low, high = self.dataframe.agg(F.min(F.expr(expression)), F.max(F.expr(expression))).first()
        min, max = low if min is None else min, high if max is None else max
    return self._aggregate("bitstring_agg", expression, groups, window_spec, projected_columns, min, max)


def _quantile(name: str) -> Callable:
    def method(self: Relation, expression: str, q: float | list[float] = 0.5, groups: str = "", window_spec: str = "", projected_columns: str = "") -> Relation:
        if isinstance(q, (list, tuple)):
            label = f"{name}({expression})"
            one = [aggregate_text(name, expression, float(x), None, window_spec) for x in q]
            head = f"{projected_columns}, " if projected_columns else ""
            tail = f" GROUP BY {groups}" if groups else ""
            return self._sql_on(f"SELECT {head}array({', '.join(one)}) AS {quoted(label)} FROM {{}}{tail}")
        return self._aggregate(name, expression, groups, window_spec, projected_columns, float(q))

    return method


Relation.string_agg, Relation.bitstring_agg = _string_agg, _bitstring_agg
Relation.quantile_cont, Relation.quantile_disc, Relation.quantile = _quantile("quantile_cont"), _quantile("quantile_disc"), _quantile("quantile_disc")


def _analytic(name: str, has_column: bool, has_n: bool) -> Callable:
    def over(self: Relation, label: str, call: str, projected_columns: str) -> Relation:
        head = f"{projected_columns}, " if projected_columns else ""
        return self._sql_on(f"SELECT {head}{call} AS {quoted(label)} FROM {{}}")

    if name in ("lag", "lead"):

        def method(self: Relation, expression: str, window_spec: str, offset: int = 1, default_value: str = "NULL", ignore_nulls: bool = False, projected_columns: str = "") -> Relation:
            return over(self, f"{name}({expression})", analytic_text(name, window_spec, expression, offset, str(default_value), ignore_nulls), projected_columns)

    elif name == "nth_value":

        def method(self: Relation, expression: str, window_spec: str, offset: int, ignore_nulls: bool = False, projected_columns: str = "") -> Relation:
            return over(self, f"nth_value({expression})", analytic_text(name, window_spec, expression, offset, "NULL", ignore_nulls), projected_columns)

    elif has_column:

        def method(self: Relation, expression: str, window_spec: str = "over ()", projected_columns: str = "") -> Relation:
            return over(self, f"{name}({expression})", analytic_text(name, window_spec, expression), projected_columns)

    elif has_n:

        def method(self: Relation, window_spec: str, num_buckets: int, projected_columns: str = "") -> Relation:
            return over(self, "ntile()", analytic_text(name, window_spec, n=num_buckets), projected_columns)

    else:

        def method(self: Relation, window_spec: str, projected_columns: str = "") -> Relation:
            return over(self, f"{name}()", analytic_text(name, window_spec), projected_columns)

    return method


for _n in ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "n_tile", "lag", "lead", "first_value", "last_value", "nth_value"):
    setattr(Relation, _n, _analytic(_n, _n in ("first_value", "last_value"), _n == "n_tile"))
Relation.rank_dense = Relation.dense_rank
