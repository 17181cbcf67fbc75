from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import reference as R
from lumenframe.llm import quality as Q


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#$é \x1c", max_size=120)), max_size=6))
def test_counts_equal_plain_ones(texts):
    got = Q.counted(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == R.quality_counts(t)


def test_grams_stay_inside_texts():
    texts = ["a b a", None, "", "b", "a b"]
    grams, at = Q.hashed_grams(pa.array(texts, pa.string()))
    assert np.diff(at).tolist() == [5, 0, 0, 1, 3]
    own = [sorted(grams[at[i] : at[i + 1]]) for i in range(5)]
    for i, t in enumerate(texts):
        alone, _ = Q.hashed_grams(pa.array([t], pa.string()))
        assert sorted(alone) == own[i]


def test_judge(spark, docs, texts):
    rows = Q.judge(docs, [i for i, _ in texts[:40] if i is not None]).collect()
    by = {}
    for i, t in texts:
        by.setdefault(i, t)
    assert len(rows) == len(texts)
    for r in rows:
        want = R.quality_counts(by[r.id])
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert r.base_failed == failed
        assert r.kept == (not failed and r.llr >= Q.THRESHOLD)


def test_ratio_equals_plain_counting(spark):
    rng = random.Random(5)
    good = [(i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(40))) for i in range(30)]
    junk = [(100 + i, " ".join(rng.choice("xx$$ yy## zz%%".split()) for _ in range(40))) for i in range(60)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string").repartition(4)
    target, raw = Q.corpus_counts(docs, [i for i, _ in good])
    every, _ = Q.hashed_grams(pa.array([t for _, t in good + junk]))
    some, _ = Q.hashed_grams(pa.array([t for _, t in good]))
    assert (raw == np.bincount(every, minlength=Q.BUCKETS)).all() and (target == np.bincount(some, minlength=Q.BUCKETS)).all()
    rows = {r.id: r for r in Q.judge(docs, [i for i, _ in good]).collect()}
    assert all(rows[i].kept or rows[i].base_failed for i, _ in good)
    assert max(rows[i].llr for i, _ in junk) < min(rows[i].llr for i, _ in good)


def test_nothing_trusted_and_no_rows(docs, no_docs):
    assert {r.llr for r in Q.judge(docs, []).collect()} == {0.0}
    assert Q.judge(no_docs, [1]).collect() == []


def test_trusted_ids(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, 1)], "doc_id long, quality int")
    assert sorted(Q.trusted_ids(labels, labels.quality == 1)) == [1, 3]


def test_small_and_large_corpora_get_the_same_verdicts(spark):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(40))) for i in range(30)]
    junk = [(100 + i, " ".join(rng.choice("xx yy zz vv".split()) for _ in range(40))) for i in range(60)]
    alone = [(200, " ".join(f"word{k}" for k in range(40)))]  # no other text has its words
    trusted = [i for i, _ in good]
    for times in (1, 4):
        docs = spark.createDataFrame((good + junk) * times + alone, "doc_id long, text string")
        rows = {r.id: r for r in Q.judge(docs, trusted).collect()}
        assert not any(r.base_failed for r in rows.values())
        assert [i for i, r in rows.items() if r.kept and i not in trusted] == [200]
        assert all(rows[i].kept for i in trusted)
