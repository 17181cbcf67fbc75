"""Connections: SQL text, readers, registered objects and functions over a Spark session."""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from . import types as _types
from . import udf as _udf
from .plans.dialect import arguments, marked, parameter_order, quoted, rewrite
from .plans.lexer import find_top, solid, statements, tokens
from .relation import Relation
from .sources import interchange, readers, writers
from .sources.paths import scratch


class Connection:
    """One session with one current result; ``cursor`` gives another one over the same tables."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._result: Relation | None = None
        self._functions: dict[str, Any] = {}
        self._options = {"python_enable_replacements": True, "python_scan_all_frames": False}
        self._profiling = False
        self._statements: dict[str, str] = {}
        self._seed: int | None = None

    # ------------------------------------------------------------------ sessions

    def cursor(self) -> Connection:
        return Connection(self.spark.newSession())

    duplicate = cursor

    def close(self) -> None:
        self._result = None

    def interrupt(self) -> None:
        self.spark.sparkContext.cancelAllJobs()

    def query_progress(self) -> float:
        """Share of finished tasks of running jobs, in percent; -1 if none runs."""
        tracker = self.spark.sparkContext.statusTracker()
        stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
        total = sum(s.numTasks for s in stages)
        return 100.0 * sum(s.numCompletedTasks for s in stages) / total if total else -1.0

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()

    # ------------------------------------------------------------------ SQL

    def extract_statements(self, query: str) -> list[str]:
        return statements(query)

    def sql(self, query: str, *, alias: str | None = None, params: Any = None) -> Relation | None:
        """The last statement as a relation if it is a SELECT; others are run."""
        last = None
        parts = statements(query)
        for i, s in enumerate(parts):
            last = self._one(s, params if i == len(parts) - 1 else None, depth=2)
        if last is None or not last.columns:
            return None
        return last.set_alias(alias) if alias else last

    query = from_query = sql

    def execute(self, query: str, parameters: Any = None) -> Connection:
        parts = statements(query)
        for i, s in enumerate(parts):
            self._result = self._one(s, parameters if i == len(parts) - 1 else None, depth=2)
        return self

    def executemany(self, query: str, parameters: list) -> Connection:
        """Once for each set of parameters; rows of an INSERT go in together."""
        m = re.fullmatch(r"(?is)\s*insert\s+into\s+([\w.`]+)\s+values\s*\(\s*(?:\?|\$\d+)(?:\s*,\s*(?:\?|\$\d+))*\s*\)\s*;?\s*", query)
        if m and parameters and not isinstance(parameters[0], dict):
            order = parameter_order(query)
            rows = [tuple(p[i] for i in order) for p in parameters]
            self.spark.createDataFrame(rows, self.spark.table(m[1]).schema).write.insertInto(m[1])
            return self
        for p in parameters:
            self.execute(query, p)
        return self

    def _one(self, sql: str, params: Any, depth: int) -> Relation:
        parts = tokens(sql)
        words = [t.word for t in solid(parts)[:3]]
        if words[0] in ("UPDATE", "DELETE") and (done := self._changed(parts, words[0])):
            return done
        if words[0] == "COPY":
            return self._copied(sql)
        if words[0] in ("PREPARE", "EXECUTE", "DEALLOCATE"):
            return self._prepared(sql, words[0], depth)
        if words[0] == "INSERT" and (at := find_top(parts, "RETURNING")) >= 0:
            return self._inserted(parts, at, params, depth)
        if m := re.fullmatch(r"(?is)\s*select\s+setseed\s*\(\s*(-?[\d.]+)\s*\)\s*", sql):
            self._seed = int(float(m[1]) * (1 << 31))
            return Relation(self.spark.sql("SELECT CAST(NULL AS STRING) AS setseed"), sql=sql)
        args = None
        if params is not None:
            order = parameter_order(sql)
            args = dict(params) if isinstance(params, dict) else [list(params)[i] for i in order] if order else list(params)
            sql = marked(sql)
        if words[0] in ("SUMMARIZE", "DESCRIBE", "DESC", "EXPLAIN"):
            return self._shown(parts, args, depth + 1)
        frames: dict[str, DataFrame] = {}
        text_ = rewrite(sql, self.spark, frames, lambda q: self._shown(tokens(q), None, depth + 2).dataframe, self._seed)
        for name, frame in frames.items():  # readers in FROM, known by these names while Spark reads the text
            frame.createOrReplaceTempView(name)
        if self._options["python_enable_replacements"]:
            self._replace(text_, depth + 1)
        df = self.spark.sql(text_, args=args) if args is not None else self.spark.sql(text_)
        if words[0] != "CREATE":  # a view goes on needing them
            for name in frames:
                self.spark.catalog.dropTempView(name)
        return Relation(df, sql=sql)

    def _prepared(self, sql: str, verb: str, depth: int) -> Relation:
        """PREPARE name AS statement; EXECUTE name(literals); DEALLOCATE name."""
        nothing = Relation(self.spark.sql("SELECT 1 AS x WHERE false").drop("x"))
        if verb == "PREPARE":
            m = re.fullmatch(r"(?is)\s*prepare\s+(\w+)\s+as\s+(.*)", sql)
            self._statements[m[1].lower()] = m[2]
            return nothing
        m = re.fullmatch(r"(?is)\s*(?:execute|deallocate)\s+(\w+)\s*(?:\((.*)\))?\s*", sql)
        if m is None or m[1].lower() not in self._statements:
            raise ValueError(f"no prepared statement: {sql}")
        if verb == "DEALLOCATE":
            del self._statements[m[1].lower()]
            return nothing
        return self._one(self._statements[m[1].lower()], arguments(m[2]) if m[2] else None, depth + 1)

    def _inserted(self, parts: list, at: int, params: Any, depth: int) -> Relation:
        """INSERT ... RETURNING: the rows are written once, inserted, and given back."""
        from pyspark.sql import functions as F

        from .plans.lexer import text

        m = re.fullmatch(r"(?is)\s*insert\s+into\s+([\w.`\"]+)\s*(?:\(([^()]*)\))?\s*((?:values|select|with|from)\b.*)", text(parts[:at]))
        if not m:
            raise ValueError(f"can't read: {text(parts)}")
        schema = self.spark.table(m[1]).schema
        names = [c.strip().strip('"`') for c in m[2].split(",")] if m[2] else schema.names
        rows = self._one(m[3], params, depth + 1).dataframe.toDF(*names)
        own = {n.lower(): n for n in names}
        rows = rows.select(*[(F.col(quoted(own[f.name.lower()])) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        path = scratch(self.spark, "insert")
        rows.write.parquet(path)
        rows = self.spark.read.schema(schema).parquet(path)
        rows.write.insertInto(m[1])
        return Relation(rows).project(text(parts[at + 1 :]).strip())

    def _shown(self, parts: list, args: Any, depth: int) -> Relation:
        """DESCRIBE and SUMMARIZE of a table or query, and EXPLAIN, as relations."""
        from .plans.lexer import text

        flat = solid(parts)
        verb = flat[0].word
        at = parts.index(flat[0]) + 1
        analyze = verb == "EXPLAIN" and flat[1].word == "ANALYZE"
        if analyze:
            at = parts.index(flat[1]) + 1
        rest = text(parts[at:]).strip()
        query = rest if tokens(rest)[0].word in ("SELECT", "WITH", "FROM", "VALUES", "PIVOT", "UNPIVOT") else f"SELECT * FROM {rest}"
        rel = self._one(query, args, depth)
        if verb == "SUMMARIZE":
            return rel.summarize()
        if verb == "EXPLAIN":
            plan = rel.explain("analyze" if analyze else "standard")
            return Relation(self.spark.createDataFrame([("analyzed_plan" if analyze else "physical_plan", plan)], "explain_key string, explain_value string"))
        rows = [(f.name, _types.type_name(f.dataType), "YES", None, None, None) for f in rel.dataframe.schema]
        return Relation(self.spark.createDataFrame(rows, "column_name string, column_type string, `null` string, key string, `default` string, extra string"))

    def _changed(self, parts: list, verb: str) -> Relation | None:
        """UPDATE and DELETE on plain tables, by writing the table anew."""
        from .plans.lexer import split_top, text

        where = find_top(parts, "WHERE")
        test = rewrite(text(parts[where + 1 :])) if where >= 0 else "true"
        if verb == "DELETE":
            name = text(parts[find_top(parts, "FROM") + 1 : where if where >= 0 else len(parts)]).strip()
            rel = self.table(name)
            writers.replace_table(rel.dataframe.where(f"NOT coalesce(({test}), false)"), name)
            return rel
        set_ = find_top(parts, "SET")
        name = text(parts[find_top(parts, "UPDATE") + 1 : set_]).strip()
        rel = self.table(name)
        new = {}
        for item in split_top(parts[set_ + 1 : where if where >= 0 else len(parts)], ","):
            column, value = text(item).split("=", 1)
            from .expressions import SQLExpression

            new[column.strip()] = SQLExpression(value.strip())
        rel.update(new, test)
        return rel

    def _copied(self, sql: str) -> Relation:
        """``COPY t|(query) TO 'path' (FORMAT ..., HEADER, DELIMITER ..., PARTITION_BY (...))``."""
        m = re.fullmatch(r"(?is)\s*copy\s+(\(.*\)|[\w.\"`]+)\s+to\s+'([^']+)'\s*(?:\((.*)\))?\s*", sql)
        if not m:
            raise ValueError(f"can't read: {sql}")
        source, path, rest = m[1], m[2], m[3] or ""
        options = {k.lower(): (v1 or v2 or v3 or "true").strip() for k, v1, v2, v3 in re.findall(r"(\w+)(?:\s+'([^']*)'|\s*\(([^)]*)\)|\s+([\w.]+))?", rest)}
        kind = options.get("format", path.rsplit(".", 1)[-1]).lower()
        rel = self._one(source[1:-1] if source.startswith("(") else f"SELECT * FROM {source}", None, depth=3)
        by = [x.strip() for x in options["partition_by"].split(",")] if "partition_by" in options else None
        again = options.get("overwrite_or_ignore", options.get("overwrite", "true")).lower() != "false"
        if kind == "parquet":
            rel.to_parquet(path, compression=options.get("compression"), partition_by=by, overwrite=again)
        elif kind == "json":
            rel.to_json(path, partition_by=by, overwrite=again)
        else:
            rel.to_csv(path, sep=options.get("delimiter", options.get("sep")), header=options.get("header", "true").lower() == "true", partition_by=by, overwrite=again)
        return rel

    def _replace(self, sql: str, depth: int) -> None:
        """Names that are no tables become views of the caller's variables of that name."""
        try:
            wanted = self.get_table_names(sql)
        except Exception:  # not a query: nothing to replace
            return
        frames = []
        frame = inspect.currentframe()
        for _ in range(depth):
            frame = frame.f_back if frame else None
        while frame is not None:
            frames.append(frame)
            if not self._options["python_scan_all_frames"]:
                break
            frame = frame.f_back
        for name in wanted:
            if "." in name or self.spark.catalog.tableExists(name) and name not in self._replaced:
                continue
            for f in frames:
                found = f.f_locals.get(name, f.f_globals.get(name))
                if found is not None and interchange.can_scan(found):
                    df = interchange.from_object(self.spark, found)
                    if df.sparkSession is not self.spark and df.sparkSession._jsparkSession != self.spark._jsparkSession:
                        raise ValueError(f"{name} belongs to another connection")
                    df.createOrReplaceTempView(name)
                    self._replaced.add(name)
                    break

    @property
    def _replaced(self) -> set[str]:
        return self.__dict__.setdefault("_replaced_names", set())

    def get_table_names(self, query: str, *, qualified: bool = False) -> set[str]:
        """Tables that a query reads, without its own CTEs."""
        plan = self.spark._jsparkSession.sessionState().sqlParser().parsePlan(rewrite(query, self.spark))
        names = set(re.findall(r"'UnresolvedRelation \[([^\]]+)\]", plan.toString()))
        ctes = {m.lower() for m in re.findall(r"(?i)(?:\bwith\s+(?:recursive\s+)?|,\s*)([\w]+)\s+as\s*\(", query)}
        found = {".".join(x.strip() for x in n.split(",")) for n in names}
        found = {n for n in found if n.lower() not in ctes}
        return found if qualified else {n.split(".")[-1] for n in found}

    # ------------------------------------------------------------------ results of execute

    def _current(self) -> Relation:
        if self._result is None:
            raise RuntimeError("no open result")
        return self._result

    def __getattr__(self, name: str) -> Any:
        if name in ("fetchone", "fetchmany", "fetchall", "fetchnumpy", "fetchdf", "fetch_df_chunk", "df", "pl", "torch", "tf", "fetch_arrow_table", "arrow_table", "to_arrow_table", "fetch_record_batch", "to_arrow_reader", "arrow", "description"):
            return getattr(self._current(), name)
        if name == "fetch_df":
            return self._current().df
        raise AttributeError(name)

    @property
    def rowcount(self) -> int:
        return -1

    # ------------------------------------------------------------------ sources

    def table(self, name: str) -> Relation:
        return Relation(self.spark.table(name), name.split(".")[-1], "TABLE_RELATION", name)

    def view(self, name: str) -> Relation:
        return Relation(self.spark.table(name), name, "VIEW_RELATION", name)

    def values(self, *args: Any) -> Relation:
        return Relation(interchange.from_values(self.spark, *args), kind="VALUE_LIST_RELATION")

    def table_function(self, name: str, parameters: list | None = None) -> Relation:
        args = ", ".join("'" + p.replace("'", "''") + "'" if isinstance(p, str) else str(p) for p in parameters or ())
        if name in ("generate_series", "unnest"):  # the end of a series is in it
            inner = f"sequence({args})" if name == "generate_series" else args
            return Relation(self.spark.sql(f"SELECT explode({inner}) AS {name}"))
        return Relation(self.spark.sql(f"SELECT * FROM {name}({args})"))

    def empty(self, columns: dict[str, Any]) -> Relation:
        return Relation(self.spark.createDataFrame([], _types.struct_type(columns)))

    def read_csv(self, path: Any, **options: Any) -> Relation:
        return Relation(readers.read_csv(self.spark, path, **options), kind="READ_CSV_RELATION")

    from_csv_auto = read_csv

    def read_json(self, path: Any, **options: Any) -> Relation:
        return Relation(readers.read_json(self.spark, path, **options))

    def read_parquet(self, path: Any, binary_as_string: bool = False, **options: Any) -> Relation:
        return Relation(readers.read_parquet(self.spark, path, binary_as_string, **options))

    from_parquet = read_parquet

    def from_df(self, frame: Any) -> Relation:
        return Relation(interchange.from_object(self.spark, frame))

    def from_arrow(self, arrow_object: Any) -> Relation:
        return Relation(interchange.from_object(self.spark, arrow_object))

    def register(self, view_name: str, python_object: Any) -> Connection:
        interchange.from_object(self.spark, python_object).createOrReplaceTempView(view_name)
        return self

    def unregister(self, view_name: str) -> Connection:
        self.spark.catalog.dropTempView(view_name)
        return self

    def append(self, table_name: str, frame: Any, *, by_name: bool = False) -> Connection:
        df = interchange.from_object(self.spark, frame)
        if by_name:
            missing = [f for f in self.spark.table(table_name).schema if f.name.lower() not in {c.lower() for c in df.columns}]
            from pyspark.sql import functions as F

            df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
            df = df.select(*map(quoted, self.spark.table(table_name).columns))
        df.write.insertInto(table_name)
        return self

    # ------------------------------------------------------------------ functions and types

    def create_function(
        self, name: str, function: Callable, parameters: list | None = None, return_type: Any = None, *, type: str = "native",  # noqa: A002
        null_handling: str = "default", exception_handling: str = "default", side_effects: bool = False,
    ) -> Connection:
        if name in self._functions:
            raise ValueError(f"function {name} exists already")
        made = _udf.build(function, parameters, return_type, kind=str(type), null_handling=str(null_handling), exception_handling=str(exception_handling), side_effects=side_effects)
        self._functions[name] = self.spark.udf.register(name, made)
        return self

    def remove_function(self, name: str) -> Connection:
        if name not in self._functions:
            raise ValueError(f"no function {name} was created here")
        del self._functions[name]
        self.spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {quoted(name)}")
        return self

    dtype = sqltype = type = staticmethod(_types.data_type)
    array_type, list_type, map_type = staticmethod(_types.array_type), staticmethod(_types.list_type), staticmethod(_types.map_type)
    struct_type, row_type, union_type = staticmethod(_types.struct_type), staticmethod(_types.row_type), staticmethod(_types.union_type)
    string_type, decimal_type = staticmethod(_types.string_type), staticmethod(_types.decimal_type)

    def enum_type(self, name: str, type: Any, values: list[str]) -> _types.EnumType:  # noqa: A002
        return _types.enum_type(name, values)

    # ------------------------------------------------------------------ file systems and extensions

    def register_filesystem(self, filesystem: Any) -> None:
        """An fsspec file system; files of its protocol are copied before a scan."""
        names = filesystem.protocol if isinstance(filesystem.protocol, (list, tuple)) else [filesystem.protocol]
        readers.FILESYSTEMS.update(dict.fromkeys(names, filesystem))

    def unregister_filesystem(self, name: str) -> None:
        if readers.FILESYSTEMS.pop(name, None) is None:
            raise ValueError(f"no file system {name} is registered")

    def list_filesystems(self) -> list[str]:
        return sorted(readers.FILESYSTEMS)

    def filesystem_is_registered(self, name: str) -> bool:
        return name in readers.FILESYSTEMS

    def install_extension(self, extension: str, **options: Any) -> None:
        """Spark takes packages when its session starts."""
        raise NotImplementedError(f"start the session with the package of {extension} in spark.jars.packages")

    load_extension = install_extension

    # ------------------------------------------------------------------ catalog

    def export_database(self, path: str) -> list[str]:
        """Every table of the current database as Parquet below ``path``."""
        names = [t.name for t in self.spark.catalog.listTables() if not t.isTemporary]
        for n in names:
            self.spark.table(n).write.mode("overwrite").parquet(f"{path}/{n}.parquet")
        return names

    def import_database(self, path: str, names: list[str]) -> None:
        for n in names:
            self.spark.read.parquet(f"{path}/{n}.parquet").write.saveAsTable(n)

    def _no_transactions(self) -> Connection:
        """Spark has no transactions over statements; each statement stands for itself."""
        return self

    begin = commit = checkpoint = _no_transactions

    def rollback(self) -> None:
        raise NotImplementedError("Spark can't undo finished statements")

    def set_option(self, name: str, value: Any) -> Connection:
        if name in self._options:
            self._options[name] = value
        else:
            self.spark.conf.set(name, value)
        return self

    def enable_profiling(self) -> None:
        self._profiling = True

    def disable_profiling(self) -> None:
        self._profiling = False

    def get_profiling_information(self, format: str = "json") -> str:  # noqa: A002
        """The plan of the current result with Spark's statistics."""
        if not self._profiling:
            raise RuntimeError("profiling is off")
        return self._current().explain("cost")


def connect(spark: SparkSession | None = None, **config: str) -> Connection:
    """A connection over ``spark``, the active session, or a new one."""
    if spark is None:
        builder = SparkSession.builder.appName("lumenframe").config("spark.sql.session.timeZone", "UTC")
        for k, v in config.items():
            builder = builder.config(k.replace("__", "."), v)
        spark = SparkSession.getActiveSession() or builder.getOrCreate()
    return Connection(spark)


_DEFAULT: list[Connection] = []


def default_connection() -> Connection:
    if not _DEFAULT:
        _DEFAULT.append(connect())
    return _DEFAULT[0]


def relation(df: DataFrame, alias: str | None = None) -> Relation:
    return Relation(df, alias)
