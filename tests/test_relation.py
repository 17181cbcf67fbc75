"""Goldens of the relational surface."""

from __future__ import annotations

import numpy as np
import pytest

import lumenframe as L


@pytest.fixture(scope="module")
def agg(spark):
    rows = [(1, 1, 2, 0.54, "h"), (1, 1, 1, 0.21, "e"), (1, 2, 3, 0.001, "l"), (2, 10, 4, 0.04, "l"), (2, 11, -1, 10.45, "o"), (3, -1, 0, 13.32, ","), (3, 5, -2, 9.87, "wor"), (3, None, 10, 6.56, "ld")]
    return L.relation(spark.createDataFrame(rows, "id int, v int, t int, f float, s string"), "agg")


RUN = "over (partition by id order by t asc rows between unbounded preceding and current row)"


def grouped(rel, name, *args, **more):
    return getattr(rel, name)(*args, groups="id", projected_columns="id", **more).order("id").fetchall()


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("bit_and", [0, 10, 5]), ("bit_or", [3, 11, -1]), ("bit_xor", [2, 1, -6]), ("count", [3, 2, 2]), ("max", [2, 11, 5]), ("min", [1, 10, -1]), ("sum", [4, 21, 4]),
        ("product", [2.0, 110.0, -5.0]), ("median", [1.0, 10.5, 2.0]), ("list", [[1, 1, 2], [10, 11], [-1, 5, None]]),
        ("histogram", [{1: 2, 2: 1}, {10: 1, 11: 1}, {-1: 1, 5: 1}]), ("mode", [1, 10, -1]),
    ],
)
def test_grouped(agg, name, want):
    got = grouped(agg, name, "v")
    if name == "list":
        got = [(i, sorted(x, key=lambda y: (y is None, y))) for i, x in got]
    assert got == list(zip([1, 2, 3], want, strict=True))


def test_grouped_with_parameters(agg):
    assert [round(x, 2) for _, x in grouped(agg, "geomean", "f")] == [0.05, 0.65, 9.52]
    assert grouped(agg, "bitstring_agg", "v", min=-1, max=11) == [(1, "0011000000000"), (2, "0000000000011"), (3, "1000001000000")]
    assert grouped(agg, "arg_max", "t", "v") == [(1, 3), (2, -1), (3, -2)]
    assert grouped(agg, "quantile_disc", "v", q=0.2) == [(1, 1.0), (2, 10.0), (3, -1.0)]
    assert [(i, [round(y, 3) for y in x]) for i, x in grouped(agg, "quantile_cont", "v", q=[0.2, 0.5])] == [(1, [1.0, 1.0]), (2, [10.2, 10.5]), (3, [0.2, 2.0])]
    assert sorted(grouped(agg, "string_agg", "s", sep="/")[1][1].split("/")) == ["l", "o"]
    assert agg.value_counts("v").order("v").fetchall() == [(-1, 1), (1, 2), (2, 1), (5, 1), (10, 1), (11, 1), (None, 0)]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("median", [1.0, 1.0, 1.0, 11.0, 10.5, 5.0, 2.0, 2.0]), ("mode", [1, 1, 1, 11, 11, 5, 5, 5]), ("sum", [1, 2, 4, 11, 21, 5, 4, 4]),
        ("list", [[1], [1, 1], [1, 1, 2], [11], [11, 10], [5], [5, -1], [5, -1, None]]), ("product", [1.0, 1.0, 2.0, 11.0, 110.0, 5.0, -5.0, -5.0]),
    ],
)
def test_running(agg, name, want):
    got = getattr(agg, name)("v", window_spec=RUN, projected_columns="id, t").order("id, t").fetchall()
    assert [x[2] for x in got] == want


def test_analytic(agg):
    over = "over (partition by id order by v)"
    assert [r[2] for r in agg.row_number(over, "id, v").order("id, v").fetchall()] == [1, 2, 3, 1, 2, 1, 2, 3]
    assert [r[2] for r in agg.rank(over, "id, v").order("id, v").fetchall()] == [1, 1, 3, 1, 2, 1, 2, 3]
    assert {r[0] for r in agg.rank("over ()").fetchall()} == {1} and {r[0] for r in agg.percent_rank("over ()").fetchall()} == {0.0}
    assert sorted(r[0] for r in agg.row_number("over ()").fetchall()) == list(range(1, 9))
    assert [r[2] for r in agg.lag("v", "over (partition by id order by t asc)", 1, "-1", projected_columns="id, t").order("id, t").fetchall()] == [-1, 1, 1, -1, 11, -1, 5, -1]
    full = "over (partition by id order by t asc rows between unbounded preceding and unbounded following)"
    assert [r[1] for r in agg.nth_value("v", full, 2, projected_columns="id").order("id").fetchall()] == [1, 1, 1, 10, 10, -1, -1, -1]


def test_order_puts_nulls_last(spark):
    r = L.relation(spark.sql("select * from values (2), (null), (1) t(a)"))
    assert r.order("a").fetchall() == [(1,), (2,), (None,)]
    assert r.order("a desc").fetchall() == [(2,), (1,), (None,)]
    assert r.sort(L.ColumnExpression("a").desc().nulls_first()).fetchall() == [(None,), (2,), (1,)]
    assert r.order("all").fetchall() == [(1,), (2,), (None,)]


@pytest.mark.parametrize(
    ("how", "want"),
    [
        ("inner", [(1, 1, 1, 4), (3, 2, 3, 5)]), ("left", [(1, 1, 1, 4), (2, 1, None, None), (3, 2, 3, 5)]), ("right", [(1, 1, 1, 4), (3, 2, 3, 5)]),
        ("outer", [(1, 1, 1, 4), (2, 1, None, None), (3, 2, 3, 5)]), ("semi", [(1, 1), (3, 2)]), ("anti", [(2, 1)]),
    ],
)
def test_joins(spark, how, want):
    a = L.relation(spark.sql("select * from values (1,1),(2,1),(3,2) t(a,b)"), "ta")
    b = L.relation(spark.sql("select * from values (1,4),(3,5) t(a,b)"), "tb")
    assert sorted(a.join(b, "ta.a = tb.a", how).fetchall(), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="alias"):
        a.join(b.set_alias("TA"), "a")


def test_sets_keep_duplicates(spark):
    a, b = (L.relation(spark.sql(f"select * from values {v} t(x)")) for v in ("(1),(1),(1),(2)", "(1),(2),(2)"))
    assert sorted(a.union(b).fetchall()) == [(1,)] * 4 + [(2,)] * 3
    assert sorted(a.except_(b).fetchall()) == [(1,), (1,)]
    assert sorted(a.intersect(b).fetchall()) == [(1,), (2,)]


def test_results(spark):
    r = L.relation(spark.sql("select * from values (1,'a'),(2,null) t(x,y)"))
    assert r.fetchone() == (1, "a") and r.fetchmany(5) == [(2, None)] and r.fetchone() is None
    assert r.shape == (2, 2) and "X" in r and "z" not in r and r.columns == ["x", "y"]
    assert r.to_arrow_table().num_rows == 2 and r.df().x.tolist() == [1, 2]
    out = r.fetchnumpy()
    assert out["x"].tolist() == [1, 2] and np.ma.is_masked(out["y"])
    assert sum(b.num_rows for b in r.to_arrow_reader(1)) == 2
    assert r["x"].columns == ["x"]
    assert r.limit(1, offset=1).fetchall() == [(2, None)]
    with pytest.raises(AttributeError):
        r.nothing


def test_injection_is_refused(agg):
    with pytest.raises(ValueError, match="not a column"):
        agg.sum("v; drop table x")
    with pytest.raises(ValueError, match="exclude"):
        agg.sum("v", groups="id", window_spec=RUN)


def test_map(spark):
    r = L.relation(spark.range(5))
    assert r.map(lambda d: d.assign(y=d.id * 2)).fetchall() == [(i, 2 * i) for i in range(5)]
    with pytest.raises(Exception, match="columns"):
        r.map(lambda d: d, schema={"other": "BIGINT"}).fetchall()
