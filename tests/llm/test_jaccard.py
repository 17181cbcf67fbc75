from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import reference as R
from lumenframe.llm import jaccard as J
from lumenframe.llm.components import connected


def by_id(texts):
    seen = {}
    for i, t in texts:
        if i is not None:
            seen.setdefault(i, t)
    return list(seen.items())


@pytest.mark.parametrize(("k", "least"), [(3, 90), (5, 80), (1, 50)])
def test_components_equal_all_pairs(spark, docs, texts, k, least):
    rows = J.near_duplicates(docs, k, least).collect()
    assert len(rows) == len(texts)
    # the row without id has its own words, so it can't join anything
    want = R.components(by_id(texts), k, least)
    size = {i: len(R.shingles(t, k)) for i, t in by_id(texts)}
    for r in rows:
        if r.id is not None:
            assert (r.n, r.component_id) == (size[r.id], want[r.id]), r
        else:
            assert r.component_id is None


def test_many_near_copies_and_chains(spark, monkeypatch):
    """More sets than a block, of which one center reaches few."""
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "HOME", 4)
    monkeypatch.setattr(J, "LARGE", 5)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(80)]
    texts = []
    for i in range(60):
        base = list(base)
        base[rng.randrange(80)] = f"n{i}"
        texts.append((i, " ".join(base)))
    texts += [(100 + i, " ".join(rng.choice(words) for _ in range(60)) + " " + " ".join(words[:12])) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = {r.id: r.component_id for r in J.near_duplicates(docs, 3, 80).collect()}
    assert got == R.components(texts, 3, 80)


def test_filter_keeps_one_of_each_component(docs, texts):
    out = J.keep_smallest(docs, 3, 90)
    assert out.columns == docs.columns
    rows = out.collect()
    want = R.components(by_id(texts), 3, 90)
    bare = [i for i, t in texts if not R.words(t)]
    kept = sorted(r.doc_id for r in rows if r.doc_id is not None)
    assert kept == sorted({c for i, c in want.items() if i not in bare} | set(bare))
    assert sum(r.doc_id is None for r in rows) == 1


def test_empty_table(no_docs):
    assert J.near_duplicates(no_docs).collect() == []
    assert J.keep_smallest(no_docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.integers(1, 200), st.sampled_from([50, 80, 90]))
def test_bounds(n, m, least):
    like = J.Likeness(least)
    need = like.overlap(n, m)
    for x in range(min(n, m) + 1):
        assert (100 * x >= least * (n + m - x)) == (x >= need)
    if n <= m and need <= n:
        assert like.prefix(n) >= n - need + 1


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60), st.integers(0, 40))
def test_counts_bound_the_intersection(a, b, shared):
    b |= set(list(a)[:shared])
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    most = J._most(*(np.frombuffer(J._counts(s), np.uint8) for s in (x, y)))
    assert most >= J._intersection(x, y) == len(a & b)


def test_connected(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(None, 3), (5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
