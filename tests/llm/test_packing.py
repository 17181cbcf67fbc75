from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenframe.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZbéÉ1 23.,!<|>'s\u0301×ßİıΣσς\n\t\x85\xa0\x1c`~日ñͅǅ½LL_-"), max_size=24))
def test_ids_of_pieces_are_the_ids_of_the_text(tokenizer, text):
    for t in (text, text.replace("<|", "<|endoftext|>")):
        got = np.frombuffer(next(iter(packing.encode([t], PATH, 1))), "<u4").tolist()
        assert got == [*tokenizer.encode(t, add_special_tokens=False).ids, 1]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 3), min_size=1, max_size=5))
def test_fill_is_closest(counts):
    must = max(counts)
    got = packing.closest_fill(counts, must, 16)
    assert all(k <= counts[n] for n, k in got.items()) and got[must] >= 1
    sums = [sum(n * k for n, k in zip(counts, ks, strict=True)) for ks in itertools.product(*[range(c + 1) for c in counts.values()]) if ks[list(counts).index(must)]]
    assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= 16)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=8))
def test_layout_covers_each_token_once(counts):
    layout = packing.Layout(packing.plan_windows(counts, 32), 32)
    spans = defaultdict(list)
    for n, k in counts.items():
        stream, window = layout.places(n, np.arange(k))
        for at, w in zip(stream, window, strict=True):
            for _, size, seq, off in layout.cut(int(at), n) if at >= 0 else [(0, n, w // 32, w % 32)]:
                spans[seq].append((off, size))
    total = 0
    for parts in spans.values():
        end = 0
        for off, size in sorted(parts):
            assert off == end
            end += size
        assert end == 32 or end & (end - 1) == 0  # no sequence needs padding
        total += end
    assert total == sum(n * k for n, k in counts.items())
    assert sorted(spans) == list(range(len(spans)))


def check(rows, texts, tokenizer, capacity):
    docs = defaultdict(list)
    for r in rows:
        docs[r.id].append(r)
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    for i, all_ids in want.items():
        pieces = docs[i]
        assert sum(r.length for r in pieces) == sum(map(len, all_ids))
        for ids in all_ids[:1]:
            for r in pieces:
                assert r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert sorted(itertools.chain(*[range(r.start, r.start + r.length) for r in pieces])) == sorted(list(range(len(ids))) * len(all_ids))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for off, n in sorted(parts):
            assert off == end
            end += n
        assert end <= capacity and (end == capacity or end & (end - 1) == 0)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_round_trip(docs, texts, tokenizer, capacity):
    rows = packing.pack(docs, PATH, capacity=capacity).collect()
    check(rows, texts, tokenizer, capacity)


def test_equal_lengths_are_cut_without_padding(spark, tokenizer):
    texts = [(i, "the cat sat on the mat") for i in range(50)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), PATH, capacity=16).collect()
    check(rows, texts, tokenizer, 16)


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []


def test_many_lengths_have_few_patterns():
    rng = random.Random(1)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 2049)}
    patterns = packing.plan_windows(counts, 2048)
    assert len(patterns) < 20_000
    assert sum(p.total * p.times for p in patterns) == sum(n * k for n, k in counts.items())


def test_limits(no_docs):
    for capacity in (0, 3, 1000, 1 << 17):
        with pytest.raises(ValueError, match="power of two"):
            packing.pack(no_docs, "none", capacity=capacity)
    assert packing._narrow(np.array([1, 65535], "<u4").tobytes()) == np.array([1, 65535], "<u2").tobytes()
    with pytest.raises(ValueError, match="id"):
        packing._narrow(np.array([1, 65536], "<u4").tobytes())
