from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest

import reference as R
from lumenframe.llm import mixing

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as P  # noqa: E402

pytest.importorskip("public_tokenizers")


def test_stages(spark, tmp_path, docs, texts):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sf = str(tmp_path)
    now = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [now]
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, now, sf)
        out.write.parquet(f"{sf}/{k}")
        now = spark.read.parquet(f"{sf}/{k}")
        seen.append(now)
        if k < 4:
            assert now.columns == docs.columns, name
    ids = [sorted(r.doc_id if r.doc_id is not None else -1 for r in s.select("doc_id").collect()) for s in seen]
    lettered = [i if i is not None else -1 for i, t in texts if t and any(map(str.isalpha, t))]
    assert set(ids[1]) <= set(lettered)
    kept = dict(texts)
    one, two = Counter(ids[2]), Counter(ids[3])
    assert not two - one
    want = R.components([(i, kept[i]) for i in one if i != -1], 5, 80)
    assert {i for i in two if i != -1} == set(want.values())
    quotas = mixing.cycled_targets({})
    assert quotas == {} and max(Counter(ids[4]).values()) <= 2
    lengths = Counter()
    for r in seen[5].collect():
        lengths[r.doc_id] += r.length
    assert set(lengths) == {i if i != -1 else None for i in ids[4]}


def test_run_is_the_stages(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path))
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_empty_table(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
