"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

Features of a text are its words, word pairs and, for both, the shapes of the words (which kinds of characters a word
has and its last byte), hashed to ``DIMENSIONS`` places; a place counts how often its n-grams occur, divided by the
square root of the number of n-grams.  A score is the sigmoid of one sparse dot product.

Training reads at most ``max_rows`` labelled rows, those with the lowest hash of the id (a documented bound; scoring
covers every row).  They are dealt to ``SHARDS`` groups; each learns by FTRL-proximal in its own task, and the weights
are averaged.  Only the averaged weights, ``DIMENSIONS`` numbers at most, reach the driver.

Defined results: null, empty and white-space texts have no features and get the bias alone; with no usable label the
score is 0.5.  An id labelled both ways counts with its lower label; labels without id or value are left out; repeated
rows are scored each.  Only id and text are read, so other columns may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillsight.llm.words import mix, slices, text_bytes, word_spans
from tillsight.session import stage, tune

DIMENSIONS = 1 << 18
SHARDS = 4
MAX_ROWS = 20_000

_POWERS = mix(64, 2)
_PAIR, _SHAPE = mix(2, 3), mix(3, 4)
# Bits by kind of byte: lower-case, upper-case, digit, ASCII mark, other alphabets.
_KIND = np.full(256, 8, np.uint8)
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1], _KIND[128:] = 1, 2, 4, 16


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all n-grams, text after text, and where each text begins (one more entry at the end)."""
    starts, ends, first = word_spans(data, offsets)
    words = len(starts)
    if not words:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum()) - np.repeat(before, lengths)
    chars = data[at + np.repeat(starts, lengths)]
    with np.errstate(over="ignore"):
        surface = np.add.reduceat((chars.astype(np.uint64) + np.uint64(1)) * _POWERS[at & 63], before)
        surface ^= lengths.astype(np.uint64) << np.uint64(40)
        shape = np.bitwise_or.reduceat(_KIND[chars], before).astype(np.uint64) * np.uint64(256)
        tail = data[ends - 1]
        shape += np.where(_KIND[tail] == 8, tail, 0)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        pairs = np.flatnonzero(text[1:] == text[:-1]) if words > 1 else np.zeros(0, np.int64)
        grams = [surface * _PAIR[0], shape * _SHAPE[0] + _SHAPE[1],
                 (surface[pairs] * _PAIR[1] + surface[pairs + 1]) * _PAIR[0],
                 (shape[pairs] * _SHAPE[2] + shape[pairs + 1]) * _SHAPE[1] + _SHAPE[0]]
    of = [text, text, text[pairs], text[pairs]]
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    mixed = np.concatenate(grams)
    with np.errstate(over="ignore"):
        places = (((mixed ^ (mixed >> np.uint64(29))) * _PAIR[1]) >> shift).astype(np.int64)
    order = np.argsort(np.concatenate(of), kind="stable")
    per_text = sum(np.bincount(x, minlength=len(offsets) - 1) for x in of)
    return places[order], np.concatenate(([0], np.cumsum(per_text)))


def margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    places, begin = features(data, offsets)
    sums = np.concatenate(([0.0], np.cumsum(weights[places])))
    count = np.diff(begin)
    return bias + (sums[begin[1:]] - sums[begin[:-1]]) / np.sqrt(np.maximum(count, 1))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha: float = 0.3, beta: float = 1.0,
         l1: float = 0.02, l2: float = 1.0) -> np.ndarray:
    """Weights (the bias last) after FTRL-proximal updates, one example after the other."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for places, values, label in examples:
            zs, ns = z[places], n[places]
            w = weights(zs, ns)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha
            z[places], n[places] = zs + g - sigma * w, ns + g * g
    return weights(z, n)


def _learn(rows: pd.DataFrame, epochs: int) -> pd.DataFrame:
    examples = []
    for text, label in zip(rows["text"], rows["label"]):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        places, _ = features(raw, np.array([0, len(raw)]))
        found, counts = np.unique(places, return_counts=True)
        values = np.append(counts / np.sqrt(max(len(places), 1)), 1.0)
        examples.append((np.append(found, DIMENSIONS), values, int(label)))
    learned = ftrl(examples, epochs)
    at = np.flatnonzero(learned)
    return pd.DataFrame({"place": at, "weight": learned[at]})


class Model:
    """Averaged weights; ``bias`` is the last of them."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.bias = weights[:-1], float(weights[-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["t"]), 2 << 20):
            out.append(margins(*text_bytes(part.column(0)), self.weights, self.bias))
        return 1.0 / (1.0 + np.exp(-np.clip(np.concatenate(out), -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = MAX_ROWS, epochs: int = 3) -> Model:
    """Learn from at most ``max_rows`` labelled ids."""
    spark = docs.sparkSession
    tune(spark)
    labels = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = labels.groupBy("id").agg(F.min("label").alias("label")).orderBy(order, "id").limit(max_rows)
    # Bounded by max_rows; the texts are not shuffled for the join.
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(stage(chosen, "labels")), "id")
    dealt = joined.select(F.pmod(order, F.lit(SHARDS)).alias("shard"), "id", "text", "label")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        return _learn(rows.sort_values(["id", "label"], kind="stable"), epochs)

    learned = dealt.groupBy("shard").applyInPandas(learn, "place long, weight double")
    sums = learned.groupBy("place").agg(F.sum(F.col("weight").cast("decimal(38,18)")).cast("double").alias("weight"))
    weights = np.zeros(DIMENSIONS + 1)
    found = sums.toPandas()
    weights[found["place"].to_numpy(np.int64)] = found["weight"].to_numpy(float) / SHARDS
    return Model(weights)


def scorer(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Score column for the texts of ``docs``: 0 to 1, higher for better text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts))

    return score(docs[text_col])


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score reaches ``least``, unchanged."""
    return docs.filter(scorer(docs, model, text_col) >= least)
