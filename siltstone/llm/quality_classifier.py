"""Quality classifier: naive Bayes features in a linear hinge-loss model.

Features are indicators of byte n-grams (2 and 3 bytes, hashed for 3) and a few repetition marks. Each
indicator is scaled by the log ratio of its class-conditional frequencies, and a linear model is
fitted to the scaled indicators by dual coordinate descent. The margin becomes a score by a logistic
curve fitted to the training margins.

The fit uses a bounded sample of labelled rows (`max_rows`, documented parameter); every row is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import owners, raw, slices, span_hashes, spans

TWO = 1 << 16
THREE = 1 << 17
MARKS = 8
FEATURES = TWO + THREE + MARKS
MAX_ROWS = 6000
# Bytes of a text whose n-grams are gathered at once.
PIECE = 1 << 20


def features(data: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Sorted ids of the indicators set for one text; `repeated` are the ids of its repetition marks."""
    there = np.zeros(FEATURES, bool)
    there[repeated] = True
    for low in range(0, len(data), PIECE):
        part = data[low : low + PIECE + 2].astype(np.uint32)
        if len(part) >= 2:
            there[MARKS + (part[:-1] << 8 | part[1:])] = True
        if len(part) >= 3:
            three = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)
            there[MARKS + TWO + (three >> np.uint32(15))] = True
    return np.flatnonzero(there)


def batch_features(column: pa.Array) -> Iterator[np.ndarray]:
    """Indicator ids of every row; NULL texts count as empty, which sets mark 0 only."""
    data, offsets = raw(column)
    rows = len(offsets) - 1
    starts, ends = spans(data, offsets)
    hashes = span_hashes(data, starts, ends, lower=True)
    bounds = np.searchsorted(starts, offsets)
    owner = owners(bounds)
    n_words = np.diff(bounds)
    twice = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=rows)
    pairs = np.unique(np.stack([owner.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64) if len(hashes) else owner
    distinct = np.bincount(pairs, minlength=rows)
    for i in range(rows):
        marks = [0] if not n_words[i] else []
        if twice[i] * 50 > n_words[i]:
            marks.append(1)
        if twice[i] * 10 > n_words[i]:
            marks.append(2)
        # Distinct words among all: far fewer when lines come again.
        if n_words[i] >= 50:
            marks.append(3 + min(4, int(5 * distinct[i] / n_words[i])))
        yield features(data[offsets[i] : offsets[i + 1]], np.array(marks, np.int64))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, ids: np.ndarray) -> float:
        margin = float(self.weights[ids].sum()) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed share of an indicator in class 1 over that in class 0."""
    good, bad = np.full(FEATURES, alpha), np.full(FEATURES, alpha)
    for ids, label in zip(rows, labels):
        (good if label else bad)[ids] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float, epochs: int, seed: int = 11) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over scaled indicators with class-balanced costs; rows are scaled to unit length."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = max(min(labels.mean(), 1 - 1e-9), 1e-9)
    limit = np.where(labels == 1, cost * 0.5 / share, cost * 0.5 / (1 - share))
    values = [scale[ids].astype(np.float64) for ids in rows]
    squares = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    weights, bias = np.zeros(FEATURES), 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            ids, value = rows[i], values[i]
            slope = signs[i] * (weights[ids] @ value + bias) - 1.0
            new = min(max(alpha[i] - slope / squares[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[ids] += step * value
                bias += step
                alpha[i] = new
    return weights * scale, bias


def calibrate(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve over margins, by Newton steps with smoothed targets."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    spread = margins.std() or 1.0
    x = np.stack([margins / spread, np.ones(len(margins))])
    at = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        gradient = x @ (p - target)
        curve = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0] / spread), float(at[1])


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int, key: str, text: str, label: str) -> list[tuple[int, np.ndarray]]:
    """(label, indicator ids) of at most `max_rows` labelled rows, half of each class where there are enough.

    The rows are those with the smallest hash of key and label, so the choice doesn't depend on order.
    A key labelled both ways takes part with both labels. At most `max_rows` keys are broadcast.
    """
    known = labels.where(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    parts = []
    for value in (0, 1):
        own = known.where(F.col("__label") == value).groupBy("__key", "__label").agg(F.xxhash64(F.first("__key")).alias("__at"))
        parts.append(own.orderBy("__at", "__key").limit(max_rows // 2))
    sample = parts[0].unionByName(parts[1]).select("__key", "__label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = [x.astype("<i4").tobytes() for x in batch_features(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *batch.columns[3:], pa.array(ids, pa.binary())], names=["key", "label", "first", "second", "ids"])

    texts = docs.select(F.col(key).alias("__doc"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(sample), F.col("__doc") == F.col("__key")).select(
        F.col("__key").cast("string"), "__label", "text", F.xxhash64("__key").alias("first"), F.xxhash64("text").alias("second")
    )
    # Features are made where the texts are. A key that stands in several documents may bring more rows; the smallest by key
    # and text hash are kept.
    made = chosen.mapInArrow(run, "key string, label int, first long, second long, ids binary")
    found = made.orderBy("first", "second").limit(max_rows).collect()
    found.sort(key=lambda row: (row.key, row.label, bytes(row.ids)))
    return [(row.label, np.frombuffer(bytes(row.ids), "<i4")) for row in found]


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text", label: str = "quality", cost: float = 1.0, epochs: int = 12) -> Model:
    """Fit on at most `max_rows` rows of `labels` for which `usable` holds; NULL labels are left out.

    Without both classes the model is constant: 1 if there are rows of class 1 only, 0 for class 0 only,
    one half for none.
    """
    found = training_rows(docs, labels, usable, max_rows, key, text, label)
    classes = np.array([x for x, _ in found], np.int64)
    if len(set(classes.tolist())) < 2:
        shift = 0.0 if not len(classes) else 30.0 if classes[0] else -30.0
        return Model(np.zeros(FEATURES, np.float32), 0.0, 0.0, shift)
    rows = [ids for _, ids in found]
    ratios = log_ratios(rows, classes)
    # Every third row is kept from the first fit, so the curve is fitted to margins the model has not seen.
    kept = np.arange(len(rows)) % 3 != 0
    if len(set(classes[kept].tolist())) == 2 and len(set(classes[~kept].tolist())) == 2:
        own = [rows[i] for i in np.flatnonzero(kept)]
        weights, bias = dual_descent(own, classes[kept], log_ratios(own, classes[kept]), cost, epochs)
        margins = np.array([weights[rows[i]].sum() + bias for i in np.flatnonzero(~kept)])
        slope, shift = calibrate(margins, classes[~kept])
    else:
        slope, shift = 1.0, 0.0
    weights, bias = dual_descent(rows, classes, ratios, cost, epochs)
    return Model(weights.astype(np.float32), bias, slope, shift)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """key, score and predicted (score >= threshold) for every row; NULL and empty texts have a score too.

    The model has a fixed size, about 0.8 MB, and is broadcast. Repeated keys give a row each; a score equal to the threshold
    is predicted. Long texts are read in slices, their n-grams in pieces. An empty table gives no row. Other columns are not
    read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            scores = np.array([own.score(ids) for ids in batch_features(batch.column(1))], np.float64)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), predicted], names=[key, "score", "predicted"])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, score double, predicted int"
    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, schema)
