"""Language identification: a byte convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import chunks, ship, utf8

#: Labelled texts that training takes at most, over all languages (but one of each language at
#: least, however many there are) and for each.
MAX_TEXTS = 4000
MAX_TEXTS_EACH = 600
#: Languages up to which their rates are sent to every task; more meet the texts by a join.
SENT_LANGUAGES = 100_000
#: Windows of a text that training takes at most.
MAX_WINDOWS = 6

WINDOW = 192  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
STEPS = 400
BATCH = 192
UNDETERMINED = "und"

# Symbols: 0 for all that isn't a letter in ASCII, 1-26 for A-Z and a-z, then the other bytes.
SYMBOL = np.zeros(256, dtype=np.int32)
SYMBOL[65:91] = SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:] = np.arange(27, 155)
SYMBOLS = 155


def windows(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into windows of WINDOW symbols, the last of each filled with 0; and their text."""
    n = -(-np.diff(offsets) // WINDOW)
    text = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    begin = offsets[:-1][text] + (np.arange(len(text)) - first[text]) * WINDOW
    at = begin[:, None] + np.arange(WINDOW)
    out = symbols[np.minimum(at, max(0, len(symbols) - 1))] if len(symbols) else np.zeros(at.shape, np.int32)
    out[at >= offsets[1:][text][:, None]] = 0
    return out, text


@dataclass
class Model:
    """Embedding, filters by width (width, EMBEDDING, FILTERS), their biases, the softmax layer."""

    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        w = self.weights
        w["E"] = rng.normal(0, 0.5, (SYMBOLS, EMBEDDING)).astype(np.float32)
        for k in WIDTHS:
            w[f"W{k}"] = rng.normal(0, (k * EMBEDDING) ** -0.5, (k, EMBEDDING, FILTERS)).astype(np.float32)
            w[f"b{k}"] = np.zeros(FILTERS, np.float32)
        w["V"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(self.languages))).astype(np.float32)
        w["c"] = np.zeros(len(self.languages), np.float32)

    def _tables(self, k: int) -> np.ndarray:
        """What each symbol adds to each filter at each place of the filter."""
        return np.einsum("se,kef->ksf", self.weights["E"], self.weights[f"W{k}"])

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for windows ``x`` (n, WINDOW) of languages ``y``."""
        w, n = self.weights, len(x)
        grads = {name: np.zeros_like(a) for name, a in w.items()}
        pooled, kept = [], []
        for k in WIDTHS:
            t = self._tables(k)
            conv = sum(t[o][x[:, o : WINDOW - k + 1 + o]] for o in range(k))
            at = conv.argmax(axis=1)
            top = np.take_along_axis(conv, at[:, None, :], 1)[:, 0] + w[f"b{k}"]
            pooled.append(np.maximum(top, 0))
            kept.append((at, top > 0))
        h = np.concatenate(pooled, axis=1)
        z = h @ w["V"] + w["c"]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(p[np.arange(n), y] + 1e-9).mean()
        p[np.arange(n), y] -= 1
        p /= n
        grads["V"], grads["c"] = h.T @ p, p.sum(axis=0)
        dh = p @ w["V"].T
        for i, k in enumerate(WIDTHS):
            at, on = kept[i]
            d = dh[:, i * FILTERS : (i + 1) * FILTERS] * on
            grads[f"b{k}"] = d.sum(axis=0)
            for o in range(k):
                seen = np.take_along_axis(x, at + o, axis=1)
                dt = np.zeros((SYMBOLS, FILTERS), np.float32)
                np.add.at(dt, (seen, np.arange(FILTERS)[None, :]), d)
                grads[f"W{k}"][o] = w["E"].T @ dt
                grads["E"] += dt @ w[f"W{k}"][o].T
        return float(loss), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.01, seed: int = 6) -> None:
        """Adam over random batches, each language drawn alike."""
        rng = np.random.default_rng(seed)
        self.start()
        groups = [np.flatnonzero(y == c) for c in range(len(self.languages))]
        groups = [g for g in groups if len(g)]
        m = {k: np.zeros_like(a) for k, a in self.weights.items()}
        v = {k: np.zeros_like(a) for k, a in self.weights.items()}
        for t in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
            _, grads = self.step(x[pick], y[pick])
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.weights[k] -= (rate * (1 - 0.8 * t / steps) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Probabilities of windows, by tables for pairs of symbols: five lookups for each byte."""

    def __init__(self, model: Model) -> None:
        w = model.weights
        t2, t3, t4 = (model._tables(k) for k in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(SYMBOLS * SYMBOLS, FILTERS)
        self.p2, self.p3, self.u3, self.p4, self.q4 = pair(t2[0], t2[1]), pair(t3[0], t3[1]), t3[2], pair(t4[0], t4[1]), pair(t4[2], t4[3])
        self.bias = np.concatenate([w[f"b{k}"] for k in WIDTHS])
        self.v, self.c = w["V"], w["c"]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.c)), np.float32)
        for a in range(0, len(x), 2048):
            out[a : a + 2048] = self._some(np.ascontiguousarray(x[a : a + 2048].T))
        return out

    def _some(self, s: np.ndarray) -> np.ndarray:
        n = s.shape[1]
        pairs = s[:-1] * SYMBOLS + s[1:]
        best = np.full((3, n, FILTERS), -np.inf, np.float32)
        a, b = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
        for t in range(WINDOW - 1):
            np.take(self.p2, pairs[t], axis=0, out=a, mode="clip")
            np.maximum(best[0], a, out=best[0])
            if t + 2 < WINDOW:
                np.take(self.p3, pairs[t], axis=0, out=a, mode="clip")
                np.take(self.u3, s[t + 2], axis=0, out=b, mode="clip")
                a += b
                np.maximum(best[1], a, out=best[1])
            if t + 3 < WINDOW:
                np.take(self.p4, pairs[t], axis=0, out=a, mode="clip")
                np.take(self.q4, pairs[t + 2], axis=0, out=b, mode="clip")
                a += b
                np.maximum(best[2], a, out=best[2])
        h = np.maximum(np.concatenate(list(best), axis=1) + self.bias, 0)
        z = h @ self.v + self.c
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", only: Column | None = None) -> Model | None:
    """A model of the languages in ``lang_col``; None if there is no labelled text with a letter.

    ``only``: which rows may be learned from. At most MAX_TEXTS_EACH texts of a language and
    MAX_TEXTS in all are taken, as many of each language; equal texts count once. They are drawn
    by a hash of text and language; rows whose text or language is null, or without a letter,
    are left out. Windows of a text are spread over the whole of it.
    """
    ship(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.where(only) if only is not None else rows
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col, lang_col).alias("h"))
    counts = rows.groupBy("lang").agg(F.count_distinct("h").alias("count")).collect()
    if not counts:
        return None
    each = max(1, min(MAX_TEXTS_EACH, MAX_TEXTS // len(counts)))
    # a few more than are needed by the hash; of a language with few texts, all
    rates = docs.sparkSession.createDataFrame([(r.lang, min(1.0, 1.3 * each / r["count"] + 8 / r["count"])) for r in counts], "lang string, rate double")
    rates = F.broadcast(rates) if len(counts) <= SENT_LANGUAGES else rates
    drawn = rows.join(rates, "lang").where((F.pmod("h", F.lit(1 << 20)) / float(1 << 20)) < F.col("rate")).dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = drawn.withColumn("place", place).where(F.col("place") <= each).select("lang", "h", "text")

    def some_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            out = []
            for t in b.column("text").to_pylist():
                data = SYMBOL[np.frombuffer(t.encode("utf-8", "replace"), np.uint8)]
                x, _ = windows(data, np.array([0, len(data)]))
                x = x[np.unique(np.linspace(0, len(x) - 1, MAX_WINDOWS).astype(int))]
                x = x[(x > 0).sum(axis=1) >= min(16, max(1, (x > 0).sum(axis=1).max()))]
                out.append(x.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array(out, pa.binary())], names=["lang", "h", "windows"])

    got = few.mapInArrow(some_windows, "lang string, h long, windows binary").collect()
    got.sort(key=lambda r: (r.h, r.lang))
    languages = sorted({r.lang for r in got})
    model = Model(languages)
    if len(languages) > 1:
        xs = [np.frombuffer(r.windows, np.uint8).reshape(-1, WINDOW).astype(np.int32) for r in got]
        ys = [languages.index(r.lang) for r, x in zip(got, xs, strict=True) for _ in range(len(x))]
        model.fit(np.concatenate(xs), np.array(ys))
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) added; columns of these names are replaced.

    The whole text is cut into windows; the score is the mean probability of the best language,
    windows weighted by their letters. A null text, one without a letter, and any text without a
    model get ``und`` and 0. Equal scores go to the first language by code point. Rows repeat as
    in ``docs``; nothing moves between tasks.
    """
    ship(docs.sparkSession)
    rows = docs.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    made: list[Scorer] = []

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made and model is not None and len(model.languages) > 1:
            made.append(model.scorer())
        for b in chunks(batches, text_col):
            lang, score = _predicted(b.column(text_col), model, made[0] if made else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return rows.mapInArrow(predict, schema)


def _predicted(texts: pa.Array, model: Model | None, scorer: Scorer | None) -> tuple[list[str], list[float]]:
    lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if model is None:
        return lang, score
    has = [t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
    if scorer is None:
        return [model.languages[0] if x else UNDETERMINED for x in has], [float(x) for x in has]
    data, offsets = utf8(texts)
    x, text = windows(SYMBOL[data], offsets)
    weight = (x > 0).sum(axis=1).astype(np.float64) + 1e-6
    total = np.zeros((len(texts), len(model.languages)))
    np.add.at(total, text, scorer.probabilities(x) * weight[:, None])
    total /= np.maximum(np.bincount(text, weight, len(texts)), 1e-12)[:, None]
    for i in np.flatnonzero(has):
        k = int(total[i].argmax())
        lang[i], score[i] = model.languages[k], float(min(1.0, total[i, k]))
    return lang, score
