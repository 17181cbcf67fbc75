"""Statements of the relational dialect and what they give, over columns with NULLs."""

from __future__ import annotations

import pytest
from pyspark.sql import Row

import lumenframe as L

# Results that the dialect has for these statements.
CASES = [
    ('select k from t order by k limit 1', [(1,)]),
    ('select k, s from t order by all', [(1, 'a'), (2, None), (3, 'a'), (3, 'c'), (None, 'b')]),
    ('select k from t order by k desc limit 2', [(3,), (3,)]),
    ('select k from (select k from t order by k limit 4) z', [(1,), (2,), (3,), (3,)]),
    ('select k, row_number() over (order by k, x) as r from t', [(1, 1), (2, 2), (3, 3), (3, 4), (None, 5)]),
    ("select concat('a', NULL), concat(s, k) from t", [('a', 'a1'), ('a', '2'), ('a', 'b'), ('a', 'a3'), ('a', 'c3')]),
    ("select regexp_replace('aaa','a','b'), regexp_replace('aaa','a','b','g'), regexp_replace('ab','(a)(b)','\\2\\1')", [('baa', 'bbb', 'ba')]),
    ("select string_split('a.b','.'), string_split_regex('a1b','[0-9]')", [(['a', 'b'], ['a', 'b'])]),
    ("select dayofweek(date '2024-01-07'), isodow(date '2024-01-07'), extract(dow from date '2024-01-07')", [(0, 7, 0)]),
    ('select [1,2,3][1], [1,2,3][-1], [1,2,3][5], [1,2,3][2:3], [1,2,3][:2]', [(1, 3, None, [2, 3], [1, 2])]),
    ("select {'a':1,'b':'x'}.b, {'a':1}['a'], map {'a':1,'b':2}['b']", [('x', 1, 2)]),
    ('select list(x order by x desc), list(k order by k) filter (where k > 1) from t', [([30, 20, 20, 10, None], [2, 3, 3])]),
    ("select string_agg(s order by k desc, s), string_agg(distinct s, '-' order by s) from t", [('a,c,a,b', 'a-b-c')]),
    ('select first(x order by y), last(s order by x nulls first, y), any_value(k order by k) from t', [(20, 'b', 1)]),
    ('select quantile_disc(x, 0.5), quantile_cont(x, 0.25), quantile_disc(x, [0.25, 0.75]) from t', [(20, 17.5, [10, 20])]),
    ("select date_diff('day', date '2020-01-01', date '2020-02-01'), date_diff('month', date '2020-01-31', date '2020-02-01'), date_sub('month', date '2020-01-31', date '2020-02-01')", [(31, 1, 0)]),
    ("select strftime(date '2020-01-02','%d/%m/%Y'), strftime(timestamp '2020-01-02 03:04:05', '%-d.%-m.%y at %I %p 100%%')", [('02/01/2020', '2.1.20 at 03 AM 100%')]),
    ('select [a*2 for a in [1,2,3] if a>1], 2**3, 2^3, 2**-1, 7 // 2', [([4, 6], 8.0, 8.0, 0.5, 3)]),
    ('select range(3), generate_series(1,3), range(0,10,3), range(5,2)', [([0, 1, 2], [1, 2, 3], [0, 3, 6, 9], [])]),
    ("select list_sum([1,2])::DOUBLE, list_slice([1,2,3],1,2), list_position([1,2],3), list_sort([3,1,null]), len([1,2]), len('abc')", [(3.0, [1, 2], None, [1, 3, None], 2, 3)]),
    ("select 'abc' similar to 'a.c', 'abc' ~ 'a.*', 'abc' not similar to 'b'", [(True, True, True)]),
    ('select unnest([1,2,3]) as u', [(1,), (2,), (3,)]),
    ('select z from unnest([1,2,3]) v(z) where z > 1', [(2,), (3,)]),
    ('select i*2 as j from range(2,5) v(i)', [(4,), (6,), (8,)]),
    ('select range from range(3)', [(0,), (1,), (2,)]),
    ('select k, s from t qualify row_number() over (partition by s order by k desc) = 1', [(3, 'a'), (3, 'c'), (2, None), (None, 'b')]),
    ('select k, s, row_number() over (partition by s order by k desc) as rn from t qualify rn = 1', [(2, None, 1), (None, 'b', 1), (3, 'a', 1), (3, 'c', 1)]),
    ('with a as (select k, s from t qualify row_number() over (partition by s order by k) = 1) select count(*) from a', [(4,)]),
    ('select k from t qualify row_number() over (order by k) = 1 union all select x from t qualify row_number() over (order by x) = 1', [(1,), (10,)]),
    ('select distinct on (s) s, k, x from t order by s, k desc', [('a', 3, None), ('b', None, 30), ('c', 3, 20), (None, 2, 20)]),
    ('select * replace (x + 1 as x) from t where k = 1', [(1, 'a', 11, 1.5)]),
    ('select * exclude (y) replace (k * 2 as k) from t where k = 1', [(2, 'a', 10)]),
    ("select * from (pivot (select s, k, x from t) on s in ('a','c') using sum(x) group by k) p where k = 3", [(3, None, 20)]),
    ("with p as (pivot (select s, k, x from t) on s in ('a','c') using sum(x) group by k) select * from p where k = 3", [(3, None, 20)]),
    ("select * from t pivot (sum(x) for s in ('a','c') group by k) where k = 3", [(3, None, 20)]),
    ("select column_name, column_type from (describe select 1 as a, 'x' as b, [1] as c, date '2020-01-01' as d)", [('a', 'INTEGER'), ('b', 'VARCHAR'), ('c', 'INTEGER[]'), ('d', 'DATE')]),
    ('select column_name, min, max, count from (summarize select k, s from t)', [('k', '1', '3', 5), ('s', 'a', 'c', 5)]),
    ('select k as a, a + 1 as b from t where a > 2', [(3, 4), (3, 4)]),
    ("select 'it''s', 'a\\b', '\\d'", [("it's", 'a\\b', '\\d')]),
    ("select typeof(1), typeof('a'), typeof(true)", [('INTEGER', 'VARCHAR', 'BOOLEAN')]),
    ('select first_value(x ignore nulls) over (order by k, s rows between unbounded preceding and unbounded following) as f from t', [(10,), (10,), (10,), (10,), (10,)]),
    ('select list(distinct s order by s) from t', [(['a', 'b', 'c', None],)]),
    ('select max(k, 2), min(k, 2), count() from t', [([3, 3], [1, 2], 5)]),
    ("select k // 2, k ** 2 from t where k is not distinct from 3 and s = 'a'", [(1, 9.0)]),
]


def plain(x):
    if isinstance(x, (Row, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, list):
        return [plain(y) for y in x]
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x


@pytest.fixture(scope="module")
def con(spark):
    spark.sql("SELECT * FROM VALUES (1, 'a', 10, 1.5D), (2, NULL, 20, NULL), (NULL, 'b', 30, 2.5D), (3, 'a', NULL, 0.5D), (3, 'c', 20, -1.0D) v(k, s, x, y)").createOrReplaceTempView("t")
    yield L.connect(spark)
    spark.catalog.dropTempView("t")


@pytest.mark.parametrize(("sql", "rows"), CASES, ids=range(len(CASES)))
def test_statement(con, sql, rows):
    got, want = [plain(r) for r in con.sql(sql).fetchall()], [plain(r) for r in rows]
    if " order by" not in sql.split(")")[-1]:
        got, want = sorted(got, key=repr), sorted(want, key=repr)
    assert got == want


def test_readers_in_from(con, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,\n")
    (tmp_path / "b.json").write_text('{"k": 3, "v": "y"}\n')
    assert sorted(con.sql(f"select k, v from read_csv('{tmp_path}/a.csv') union all select k, v from '{tmp_path}/b.json'").fetchall(), key=repr) == [(1, "x"), (2, None), (3, "y")]
    assert con.sql(f"select count(*) from read_csv('{tmp_path}/a.csv', header = false, all_varchar = true)").fetchall() == [(3,)]


def test_explain(con):
    key, plan = con.sql("explain analyze select k from t where k > 1").fetchone()
    assert key == "analyzed_plan" and plan.startswith("3 rows")
    assert con.sql("explain select k from t").fetchone()[0] == "physical_plan"


def test_prepared_statements(con):
    con.execute("prepare p as select k from t where k >= $1 and s = $2")
    assert con.execute("execute p(2, 'a')").fetchall() == [(3,)]
    con.execute("prepare q as select count(*) from t where k = $n")
    assert con.execute("execute q(n := 3)").fetchall() == [(2,)]
    con.execute("deallocate p")
    with pytest.raises(ValueError, match="prepared"):
        con.execute("execute p(1, 'a')")


def test_insert_returning(con):
    con.execute("drop table if exists ret")
    con.execute("create table ret (a int, b string) using parquet")
    try:
        assert sorted(con.sql("insert into ret (b) select s from t where k = 3 returning b, a is null as n").fetchall()) == [("a", True), ("c", True)]
        assert con.sql("insert into ret values (1, 'x') returning *").fetchall() == [(1, "x")]
        assert con.sql("select count(*) from ret").fetchall() == [(3,)]
    finally:
        con.execute("drop table ret")


def test_seed_and_repeated_rows(con):
    con.execute("select setseed(0.25)")
    first = con.sql("select random() as r from range(3)").fetchall()
    con.execute("select setseed(0.25)")
    assert con.sql("select random() as r from range(3)").fetchall() == first
    assert con.sql("select * from repeat_row(1, 'x', num_rows := 2)").fetchall() == [(1, "x")] * 2
