from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from lumenframe.llm import exact


def groups(texts):
    by = defaultdict(list)
    for i, t in texts:
        by[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return by


def test_keeps_the_longest_then_smallest(docs, texts):
    rows = exact.exact_duplicates(docs).collect()
    by = groups(texts)
    assert len(rows) == len(texts)
    assert sum(r.kept for r in rows) == len(by)
    found = defaultdict(list)
    for r in rows:
        found[bytes(r.digest)].append(r)
    for norm, members in by.items():
        got = found[hashlib.sha256(norm.encode()).digest()]
        assert len(got) == len(members) == got[0].group_size
        assert {r.keep_id for r in got} == {min(members)[3]}
        assert [r.id for r in got if r.kept] == [min(members)[3]]


@pytest.mark.parametrize("fan_in", [2, 3, 100])
def test_tree_shape_does_not_matter(docs, fan_in):
    rows = exact.digests(docs)
    plain = rows.groupBy("digest").count().collect()
    merged = exact.merge_runs(rows, fan_in).collect()
    assert {bytes(r.digest): r["count"] for r in plain} == {bytes(r.digest): r.copies for r in merged}


def test_filter_keeps_columns_and_one_of_each(docs, texts):
    out = exact.keep_first(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(groups(texts))
    want = {min(m)[3] for m in groups(texts).values()}
    assert {r.doc_id for r in rows} == want


def test_empty_table(no_docs):
    assert exact.exact_duplicates(no_docs).collect() == []
    assert exact.keep_first(no_docs).collect() == []
