from __future__ import annotations

import itertools
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import reference as R
from lumenframe.llm import mixing


def test_targets_by_hand():
    got = mixing.cycled_targets({"b": 100, "a": 100, None: 10})
    # total 315; a weighs 3, b 1, null 2: null stops at 20, a at 200, b gets the rest
    assert got == {"a": 200.0, "b": 95.0, None: 20.0}
    assert mixing.cycled_targets({}) == {}
    assert mixing.cycled_targets({"a": 0}) == {"a": 0.0}


def best_flow(patterns, quotas, repeat):
    """Largest total over all whole flows of tiny problems, and its least cost."""
    edges = [(p, s) for p, (members, _) in enumerate(patterns) for s in members]
    best = (0, 0)
    for f in itertools.product(*[range(min(repeat * patterns[p][1], quotas[s]) + 1) for p, s in edges]):
        into, out = defaultdict(int), defaultdict(int)
        for x, (p, s) in zip(f, edges, strict=True):
            into[s] += x
            out[p] += x
        if all(into[s] <= quotas[s] for s in quotas) and all(out[p] <= repeat * patterns[p][1] for p in out):
            cost = sum(max(0, out[p] - patterns[p][1]) for p in out)
            best = min(best, (-sum(f), cost))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.sampled_from("abc"), min_size=1, max_size=2), st.integers(0, 3)), min_size=1, max_size=3), st.lists(st.integers(0, 4), min_size=3, max_size=3))
def test_flow_is_largest_and_cheapest(patterns, quotas):
    patterns = [(tuple(sorted(m)), n) for m, n in patterns]
    quota = dict(zip("abc", quotas, strict=True))
    flow = mixing.route(patterns, quota, 2)
    total = sum(sum(f.values()) for f in flow)
    cost = sum(max(0, sum(f.values()) - n) for f, (_, n) in zip(flow, patterns, strict=True))
    assert all(sum(f.get(s, 0) for f in flow) <= quota[s] for s in quota)
    assert (-total, cost) == best_flow(patterns, quota, 2)


def test_mix_meets_targets_and_repeats(docs, texts):
    first = mixing.mix(docs, mixing.cycled_targets, F.array("source"))
    rows = first.collect()
    sizes = defaultdict(list)
    for i, t in texts:
        sizes[i].append(len(R.words(t)))
    assert sorted((r.id is None, r.id or 0, r["size"]) for r in rows) == sorted((i is None, i or 0, len(R.words(t))) for i, t in texts)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["size"] * r.repeats <= r.taken <= 2 * r["size"]
        s = r.members[0]
        taken[s] += r.taken
        target[s] = r.targets[0]
        size[s] += r["size"]
    assert all(r.source_sizes == [size[r.members[0]]] for r in rows)
    assert target == mixing.cycled_targets(dict(size))
    for s in target:
        assert abs(taken[s] - target[s]) <= 1
    again = mixing.mix(docs.repartition(3), mixing.cycled_targets, F.array("source")).collect()
    key = lambda r: (r.id is None, r.id or 0, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i % 3 == 0 else ["b"] if i % 3 == 1 else ["a", "b"]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    out = mixing.mix(docs, lambda sizes: {"a": 150.0, "b": 150.0}, F.col("of")).collect()
    assert sum(r.taken for r in out) == 300
    assert {r.repeats for r in out} == {1}


def test_repeated_rows_of_the_mix(docs):
    mixed = mixing.mix(docs, mixing.cycled_targets, F.array("source"))
    out = mixing.repeated(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == mixed.agg(F.sum("repeats")).first()[0]


@pytest.mark.parametrize("copies", [2, 4, 100])
def test_equal_rows_meet_the_target(spark, copies):
    docs = spark.createDataFrame([(1, "w " * 10, "a", i) for i in range(copies)], "doc_id long, text string, source string, more long").repartition(7)
    mixed = mixing.mix(docs, mixing.cycled_targets, F.array("source"))
    rows = mixed.collect()
    assert len(rows) == copies
    assert sum(r.taken for r in rows) == 15 * copies
    assert all(r.taken <= 20 for r in rows)
    out = mixing.repeated(docs, mixed)
    seen = [r.more for r in out.collect()]
    assert len(seen) == sum(r.repeats for r in rows)
    assert set(seen) == set(range(copies)) and max(seen.count(i) for i in seen) <= 2


def test_document_taken_in_part(spark):
    docs = spark.createDataFrame([(1, "a b\tc  d e", "x")], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, lambda sizes: {"x": 3.0}, F.array("source"))
    assert [(r.taken, r.repeats, r.part) for r in mixed.collect()] == [(3, 0, 3)]
    assert mixing.repeated(docs, mixed).collect() == []
    assert [tuple(r) for r in mixing.mixed(docs, lambda sizes: {"x": 3.0}, F.array("source")).collect()] == [(1, "a b\tc", "x")]


@pytest.mark.parametrize("parts", [1, 6])
def test_mixed_documents_are_those_of_the_mix(spark, docs, parts):
    """Each text as often as its rows are taken, whole rows and the cut one."""
    more = [(500, "x " * 7, None, "a"), (501, "y y", None, "b")]
    rows = spark.createDataFrame(more * 9, "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(rows, allowMissingColumns=True).repartition(parts)
    want, cut = defaultdict(int), 0
    taken = mixing.mix(docs, mixing.cycled_targets, F.array("source")).collect()
    for r in taken:
        want[r.id] += r.repeats
        cut += r.part > 0
    out = mixing.mixed(docs, mixing.cycled_targets, F.array("source"))
    assert out.columns == docs.columns
    got, words = defaultdict(int), 0
    for r in out.collect():
        got[r.doc_id] += 1
        words += len(R.words(r.text))
    assert words == sum(r.taken for r in taken)
    assert sum(got.values()) == sum(want.values()) + cut
    assert all(want[i] <= got[i] <= want[i] + 1 for i in want)


def test_many_patterns(spark, monkeypatch):
    """Plans that are not sent to every task."""
    monkeypatch.setattr(mixing, "SENT_PATTERNS", 3)
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), f"s{i % 20}") for i in range(200)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, mixing.cycled_targets, F.array("source"))
    for r in mixed.groupBy(F.col("members")[0].alias("s")).agg(F.sum("taken").alias("taken"), F.first("targets").alias("t")).collect():
        assert abs(r.taken - r.t[0]) <= 1
    assert mixing.repeated(docs, mixed).count() == mixed.agg(F.sum("repeats")).first()[0]


def test_empty_table(no_docs):
    mixed = mixing.mix(no_docs, mixing.cycled_targets, F.array("source"))
    assert mixed.collect() == []
    assert mixing.repeated(no_docs, mixed).collect() == []
    assert mixing.mixed(no_docs, mixing.cycled_targets, F.array("source")).collect() == []
