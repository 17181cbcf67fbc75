from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from lumenframe.llm import common as C


def test_blocks_do_not_change_hashes(monkeypatch):
    """Words longer than a block, at its edges, and many short ones."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abAB \né") for _ in range(n)) for n in (0, 1, 15, 16, 17, 200, 3000)] + ["x" * 100, " ", "a " * 40 + "y" * 33]
    whole = C.Words(*C.utf8(pa.array(texts))).hashes(lower=True)
    for size in (1, 3, 16):
        monkeypatch.setattr(C, "BLOCK_BYTES", size)
        monkeypatch.setattr(C, "_TABLES", [])
        assert np.array_equal(C.Words(*C.utf8(pa.array(texts))).hashes(lower=True), whole)


def test_a_very_long_text():
    """50 MB in one text: as many shingles as its words allow, equal windows with equal hashes."""
    unit = " ".join(f"word{i}" for i in range(1000)) + " "
    times = 50_000_000 // len(unit) + 1
    words = C.Words(*C.utf8(pa.array([unit * times])))
    grams, offsets = words.shingles(5, lower=True)
    assert len(grams) == offsets[-1] == 1000 * times - 4
    assert len(np.unique(grams)) == 1000
