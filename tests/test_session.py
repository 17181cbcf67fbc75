"""Connections, dialect, files and functions."""

from __future__ import annotations

import datetime
import io

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import lumenframe as L
from lumenframe import functions as LF
from lumenframe import types as LT
from lumenframe.plans import dialect, lexer
from lumenframe.sources.formats import java_pattern


@pytest.fixture
def con(spark):
    return L.connect(spark)


def rows(r):
    return sorted(r.fetchall(), key=repr)


def test_lexer():
    sql = "select 'a;b' -- x;\n; /* ; */ select \"c;d\", $1;;"
    assert len(lexer.statements(sql)) == 2
    assert lexer.text(lexer.tokens(sql)) == sql


def test_rewrites():
    assert dialect.rewrite('select * exclude (a) from "t x"') == "select * EXCEPT (a) from `t x`"
    assert dialect.rewrite("select 'exclude', x::VARCHAR from t") == "select 'exclude', x::STRING from t"
    assert dialect.rewrite("from 'a/b.parquet'") == "from parquet.`a/b.parquet`"
    assert dialect.marked("select $2, $name, '$1', ?") == "select ?, :name, '$1', ?"
    assert dialect.parameter_order("select $2, $1, $2") == [1, 0, 1]
    assert dialect.window("over (partition by a order by b desc, c nulls first rows between 1 preceding and current row)") == "OVER (partition by a ORDER BY b desc NULLS LAST, c nulls first rows between 1 preceding and current row)"


def test_sql(con):
    con.execute("create or replace temp view t3 as select * from values (1, 'x'), (2, 'y'), (3, 'x') t(a, b)")
    assert rows(con.sql("PIVOT t3 ON b USING sum(a)")) == [(4, 2)]
    assert rows(con.sql("select a from t3 qualify row_number() over (partition by b order by a desc) = 1")) == [(2,), (3,)]
    assert rows(con.sql("select a * 2 as c from t3 where c > 2")) == [(4,), (6,)]
    assert rows(con.sql("select $2 - $1", params=[1, 5])) == [(4,)]
    assert rows(con.sql("select 1; select 2")) == [(2,)]
    assert con.get_table_names("with q as (select * from t3) select * from q, other") == {"t3", "other"}
    assert con.execute("select a from t3 order by a").fetchone() == (1,)


def test_objects_by_name(con):
    frame = pd.DataFrame({"x": [1, 2], "y": ["a", None]})
    table = pa.table({"z": [1.5]})
    array = np.array([[1, 2], [3, 4]])
    assert rows(con.sql("select x, y from frame")) == [(1, "a"), (2, None)]
    assert rows(con.from_arrow(table)) == [(1.5,)]
    assert rows(con.from_df(array)) == [(1, 3), (2, 4)]
    con.register("seen", frame)
    assert con.view("seen").shape == (2, 2)
    con.unregister("seen")
    con.set_option("python_enable_replacements", False)
    with pytest.raises(Exception, match="frame2"):
        frame2 = frame  # noqa: F841
        con.sql("select * from frame2")


def test_arrow_datasets(con, tmp_path):
    """Parquet datasets become Spark scans; others are read as they are."""
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"k": [1, 2], "v": ["a", None]}), tmp_path / "a.parquet")
    files = ds.dataset(tmp_path / "a.parquet")
    assert rows(con.sql("select v, k from files where k > 1")) == [(None, 2)]
    assert "Scan parquet" in con.from_arrow(files).filter("k > 1").explain()
    (tmp_path / "b.csv").write_text("k\n7\n")
    assert rows(con.from_arrow(ds.dataset(tmp_path / "b.csv", format="csv"))) == [(7,)]
    assert rows(con.from_arrow(files.scanner(columns=["k"]))) == [(1,), (2,)]


def test_tables(con):
    con.execute("drop table if exists tab")
    con.values((1, "a"), (2, "b")).project("cast(col0 as int) as k, col1 as v").create("tab")
    con.table("tab").insert([3, "c"])
    con.executemany("insert into tab values (?, ?)", [[4, "d"], [5, "e"]])
    con.append("tab", pd.DataFrame({"v": ["f"], "k": [6]}).astype({"k": "int32"}), by_name=True)
    con.execute("update tab set v = upper(v) where k < 3")
    con.execute("delete from tab where k = 4")
    assert rows(con.table("tab")) == [(1, "A"), (2, "B"), (3, "c"), (5, "e"), (6, "f")]
    con.execute("drop table tab")


def test_files(con, tmp_path):
    r = con.values((1, "a|b", datetime.date(2020, 1, 2)), (2, None, None)).project("col0 AS k, col1 AS s, col2 AS d")
    r.to_csv(f"{tmp_path}/c", sep=";", date_format="%d/%m/%Y")
    back = con.read_csv(f"{tmp_path}/c", sep=";", header=True, date_format="%d/%m/%Y", columns={"k": "BIGINT", "s": "VARCHAR", "d": "DATE"})
    assert rows(back) == rows(r)
    r.to_parquet(f"{tmp_path}/p", partition_by=["k"], compression="zstd")
    assert rows(con.read_parquet(f"{tmp_path}/p").project("cast(k as bigint), s, d")) == rows(r)
    r.to_json(f"{tmp_path}/j")
    assert rows(con.read_json(f"{tmp_path}/j", columns={"k": "BIGINT", "s": "VARCHAR", "d": "DATE"})) == rows(r)
    con.execute(f"COPY (select 1 as x) TO '{tmp_path}/x.parquet' (FORMAT parquet)")
    assert rows(con.sql(f"from '{tmp_path}/x.parquet'")) == [(1,)]
    assert rows(con.read_csv(io.StringIO("a,b\n1,x\n2,y\n"))) == [(1, "x"), (2, "y")]
    (tmp_path / "n.csv").write_text("a;b\n1.234,5;x\nNA;y\n")
    assert rows(con.read_csv(f"{tmp_path}/n.csv", decimal=",", thousands=".", na_values=["NA"])) == [(1234.5, "x"), (None, "y")]
    (tmp_path / "skip.csv").write_text("junk\nmore\na,b\n1,2\n")
    assert rows(con.read_csv(f"{tmp_path}/skip.csv", skiprows=2, header=True)) == [(1, 2)]
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(con.read_json(f"{tmp_path}/a.json", format="array")) == [(1,), (2,)]


def test_functions(con):
    con.create_function("f1", lambda x: x + 1, ["BIGINT"], "BIGINT")
    assert rows(con.sql("select f1(id) from range(2)")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="exists"):
        con.create_function("f1", lambda x: x, ["BIGINT"], "BIGINT")
    con.remove_function("f1")
    con.create_function("bad", lambda x: None, ["BIGINT"], "BIGINT")
    with pytest.raises(Exception, match="NULL"):
        con.sql("select bad(id) from range(2)").fetchall()

    def typed(x: int) -> str:
        return str(x)

    con.create_function("typed", typed)
    assert rows(con.sql("select typed(id) from range(1)")) == [("0",)]
    for n in ("bad", "typed"):
        con.remove_function(n)


def test_types(spark):
    assert LT.data_type("INTEGER[]").simpleString() == "array<int>"
    assert LT.data_type("STRUCT(a INTEGER, b VARCHAR)").simpleString() == "struct<a:int,b:string>"
    assert LT.data_type("MAP(VARCHAR, HUGEINT)").simpleString() == "map<string,decimal(38,0)>"
    assert LT.data_type(list[int]).simpleString() == "array<bigint>" and LT.data_type(int | None).simpleString() == "bigint"
    assert LT.union_type({"a": int, "b": str}).simpleString() == "struct<tag:string,a:bigint,b:string>"
    mood = LT.enum_type("mood", ["sad", "ok"])
    df = spark.createDataFrame([("ok",), ("sad",)], "m string")
    assert [r[0] for r in df.orderBy(mood.position(df.m)).select(mood.check(df.m)).collect()] == ["sad", "ok"]
    with pytest.raises(Exception, match="range"):
        spark.sql("select 300 as id").select(LT.check_range(F.col("id"), "UTINYINT")).collect()


def test_expressions(spark):
    r = L.relation(spark.sql("select * from values (5, 2), (null, 1) t(a, b)"))
    a, b = L.ColumnExpression("a"), L.ColumnExpression("b")
    got = r.select((a / b).alias("d"), (a // b).alias("i"), (a % b).alias("m"), (a / 0).alias("z"), (1 - a).alias("r"), a.isnull().alias("n")).fetchall()
    assert got == [(2.5, 2, 1, None, -4, False), (None, None, None, None, None, True)]
    assert r.select(L.CaseExpression(a == 5, "x").otherwise("y")).fetchall() == [("x",), ("y",)]
    assert r.select(L.StarExpression(exclude=["a"])).columns == ["b"]


def test_divergent_functions(spark):
    df = spark.sql("select * from values (1, 'x'), (2, 'x'), (4, null) t(c, s)")
    got = df.agg(LF.skewness("c"), LF.mode("s"), LF.collect_list("s"), LF.any_value("s")).first()
    assert round(got[0], 4) == 0.9352 and got[1] == "x" and got[3] == "x"
    assert len(got[2]) == 3 and got[2].count(None) == 1
    day = spark.sql("select date'2015-04-08' as a, date'2015-05-10' as b")
    assert day.select(LF.date_diff("b", "a")).first()[0] == -32
    for name in LF.__all__:
        assert callable(getattr(LF, name))


def test_patterns():
    assert java_pattern("%d/%m/%Y %H:%M") == "dd/MM/yyyy HH:mm"
    assert java_pattern("%Y year") == "yyyy' year'"
    assert java_pattern("yyyy") == "yyyy"


class _Memory:
    """A file system as fsspec has them."""

    protocol = "mem"
    files = {"mem://a/x.csv": b"a,b\n1,x\n"}

    def glob(self, pattern):
        return [f for f in self.files if f == pattern]

    def open(self, path, mode):
        return io.BytesIO(self.files[path])


def test_file_systems(con):
    con.register_filesystem(_Memory())
    assert con.list_filesystems() == ["mem"] and con.filesystem_is_registered("mem")
    assert rows(con.read_csv("mem://a/x.csv")) == [(1, "x")]
    con.unregister_filesystem("mem")
    with pytest.raises(ValueError, match="registered"):
        con.unregister_filesystem("mem")
    with pytest.raises(NotImplementedError):
        con.load_extension("x")
