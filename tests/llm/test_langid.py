from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from lumenframe.llm import langid as L

SYLLABLES = {"en": ["the", "ing", "and", "ly", "tion", "er"], "de": ["sch", "ung", "ein", "keit", "ü", "lich"], "fr": ["eau", "que", "é", "ment", "oi", "elle"]}


def text_of(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def labelled(seed, n):
    rng = random.Random(seed)
    return [(i, text_of(lang := rng.choice(list(SYLLABLES)), rng, rng.randint(8, 90)), lang) for i in range(n)]


def test_gradients():
    rng = np.random.default_rng(0)
    model = L.Model(["a", "b"])
    model.start()
    model.weights = {k: a.astype(np.float64) for k, a in model.weights.items()}
    x, y = rng.integers(0, L.SYMBOLS, (4, L.WINDOW)).astype(np.int32), np.array([0, 1, 1, 0])
    _, grads = model.step(x, y)
    for name in ("E", "W2", "W4", "b3", "V", "c"):
        w = model.weights[name].reshape(-1)
        for i in rng.integers(0, len(w), 4):
            old = w[i]
            w[i] = old + 1e-6
            up, _ = model.step(x, y)
            w[i] = old - 1e-6
            down, _ = model.step(x, y)
            w[i] = old
            assert abs((up - down) / 2e-6 - grads[name].reshape(-1)[i]) < 1e-5, name


def test_tables_equal_the_network():
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b", "c"])
    model.start()
    x = rng.integers(0, L.SYMBOLS, (5, L.WINDOW)).astype(np.int32)
    w = model.weights
    pooled = []
    for k in L.WIDTHS:
        e = w["E"][x]
        conv = np.stack([sum(e[:, t + o] @ w[f"W{k}"][o] for o in range(k)) for t in range(L.WINDOW - k + 1)], axis=1)
        pooled.append(np.maximum(conv.max(axis=1) + w[f"b{k}"], 0))
    z = np.concatenate(pooled, axis=1) @ w["V"] + w["c"]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(model.scorer().probabilities(x), p / p.sum(axis=1, keepdims=True), atol=1e-5)


def test_windows_cover_whole_texts():
    symbols = np.arange(1, 1001, dtype=np.int32)
    offsets = np.array([0, 0, 500, 501, 501, 1000])
    x, text = L.windows(symbols, offsets)
    for i in range(5):
        flat = x[text == i].reshape(-1)
        assert flat[flat > 0].tolist() == symbols[offsets[i] : offsets[i + 1]].tolist()


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(labelled(1, 300), "doc_id long, text string, lang string").repartition(3)
    model = L.train(docs)
    odd = [(900, None, "en"), (901, "", None), (902, "123 !? \n", "de"), (903, text_of("de", random.Random(3), 9000), "de"), (904, "日本", None)]
    fresh = spark.createDataFrame([*labelled(2, 200), *odd], "doc_id long, text string, lang string").withColumnRenamed("lang", "score")
    rows = L.identify(fresh.withColumnRenamed("score", "truth"), model).collect()
    ok = [r.lang_pred == r.truth for r in rows if r.doc_id < 900]
    assert np.mean(ok) > 0.97
    own = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id >= 900}
    assert own[900] == own[901] == own[902] == ("und", 0.0)
    assert own[903][0] == "de" and own[904][0] in SYLLABLES
    assert all(0 <= r.score <= 1 for r in rows)
    again = {r.doc_id: r.lang_pred for r in L.identify(fresh, L.train(docs.repartition(5))).collect()}
    assert again == {r.doc_id: r.lang_pred for r in rows}


def test_no_labels_one_label_and_no_rows(spark, docs, no_docs):
    assert L.train(no_docs) is None
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
    one = L.train(spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score) for r in L.identify(docs, one).collect()} == {("en", 1.0), ("und", 0.0)}
    assert L.identify(no_docs, one).collect() == []


def test_copies_leave_room_for_other_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_TEXTS", 20)
    monkeypatch.setattr(L, "MAX_TEXTS_EACH", 10)
    h = F.xxhash64("text", F.lit("aa"))
    drawn = spark.range(20_000).select(F.format_string("some text %d", "id").alias("text")).withColumn("h", h).where("pmod(h, 1 << 20) < 4000")
    text = drawn.orderBy("h").first().text  # of the first that are drawn
    rows = [(k, text, "aa") for k in range(1000)] + [(2000 + k, f"quite other {k}", "bb") for k in range(5)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]


def test_every_language_is_learned(spark):
    """More languages than any fixed number of places."""
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 12, f"l{i:03d}") for i in range(600)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 600
