import random
import re

import numpy as np
import pyarrow as pa
from helpers import documents, invented
from pyspark.sql import functions as F

from siltstone.llm import quality_classifier as qc


def labelled(spark, count=160):
    rnd = random.Random(1)
    texts, labels = [], []
    for i, text in enumerate(invented(21, count, words=(20, 60), vocabulary=300)):
        bad = i % 4 == 0
        texts.append(" ".join(w + rnd.choice(["###", "%%%"]) for w in text.split()) if bad else text)
        labels.append((i, 0 if bad else 1))
    return texts, labels


def test_held_out_rows_are_told_apart(spark):
    texts, labels = labelled(spark)
    docs = documents(spark, [*texts, None, "", "\n", "x " * 40_000])
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (2, 1), (2, 1)], "doc_id long, quality int")
    model = qc.fit(docs, table, F.col("doc_id") % 3 != 0)
    rows = {r.doc_id: r for r in qc.score(docs, model).collect()}
    assert len(rows) == len(texts) + 4
    held = [(rows[i].predicted, label) for i, label in labels if i % 3 == 0]
    assert sum(p == label for p, label in held) >= 0.95 * len(held)
    for r in rows.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    again = {r.doc_id: r.score for r in qc.score(docs, qc.fit(docs.repartition(5), table.repartition(2), F.col("doc_id") % 3 != 0)).collect()}
    assert again == {k: r.score for k, r in rows.items()}


def test_few_rows_one_class_and_none(spark):
    texts, labels = labelled(spark, 20)
    docs = documents(spark, texts)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    for keep, score in (("quality = 1", 1.0), ("quality = 0", 0.0), ("false", 0.5)):
        model = qc.fit(docs, table.where(keep), F.lit(True))
        assert all(abs(r.score - score) < 1e-9 for r in qc.score(docs, model).collect())
    assert qc.score(docs.limit(0), model).collect() == []
    assert len(qc.training_rows(docs, table, F.lit(True), 6, "doc_id", "text", "quality")) == 6


def test_dual_descent_separates_and_calibration_is_monotone():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) + (50 if y else 0) for y in (i % 2 for i in range(80))]
    labels = np.arange(80) % 2
    weights, bias = qc.dual_descent(rows, labels, qc.log_ratios(rows, labels), 1.0, 10)
    margins = np.array([weights[r].sum() + bias for r in rows])
    assert ((margins > 0) == (labels == 1)).all()
    slope, _ = qc.calibrate(margins, labels)
    assert slope > 0


def plain_indicators(text):
    """Names of the indicators of one text: byte pairs, hash buckets of byte triples, repetition marks."""
    data = (text or "").encode()
    out = {("pair", data[i : i + 2]) for i in range(len(data) - 1)}
    out |= {("triple", (int.from_bytes(data[i : i + 3], "big") * 2654435761 & 0xFFFFFFFF) >> 15) for i in range(len(data) - 2)}
    words = [w.lower() for w in re.split(rb"[ \t-\r]+", data) if w]
    twice = sum(a == b for a, b in zip(words, words[1:]))
    out |= {("mark", 0)} if not words else set()
    out |= {("mark", k) for k, times in ((1, 50), (2, 10)) if twice * times > len(words)}
    if len(words) >= 50:
        out.add(("mark", 3 + min(4, int(5 * len(set(words)) / len(words)))))
    return out


def named(ids):
    """The same names for indicator ids."""
    out = set()
    for i in ids.tolist():
        if i < qc.MARKS:
            out.add(("mark", i))
        elif i < qc.MARKS + qc.TWO:
            out.add(("pair", bytes(divmod(i - qc.MARKS, 256))))
        else:
            out.add(("triple", i - qc.MARKS - qc.TWO))
    return out


def test_indicators_ratios_and_descent_match_plain_versions(spark, monkeypatch):
    texts = ["", None, "a", "ab", "the the cat sat", "é ß x", "word " * 60, " ".join(f"w{i}" for i in range(80)), "x" * 3000]
    monkeypatch.setattr(qc, "PIECE", 700)
    rows = list(qc.batch_features(pa.array(texts, pa.string())))
    for text, ids in zip(texts, rows):
        assert named(ids) == plain_indicators(text), text
    labels = np.array([0, 1, 0, 1, 1, 0, 1, 0, 1])
    ratios = qc.log_ratios(rows, labels)
    seen = [sum(len(r) for r, y in zip(rows, labels) if y == c) + qc.FEATURES for c in (0, 1)]
    for at in (0, qc.MARKS + 97 * 256 + 98, int(rows[4][5])):
        counts = [sum(at in r for r, y in zip(rows, labels) if y == c) + 1 for c in (0, 1)]
        assert np.isclose(ratios[at], np.log(counts[1] / seen[1]) - np.log(counts[0] / seen[0]))
    # The dual optimum: a dense solver by many sweeps in fixed order reaches the same weights.
    weights, bias = qc.dual_descent(rows, labels, ratios, 1.0, 400)
    dense = np.zeros((len(rows), qc.FEATURES + 1))
    for i, r in enumerate(rows):
        dense[i, r], dense[i, -1] = ratios[r], 1.0
    signs, share = np.where(labels == 1, 1.0, -1.0), labels.mean()
    limit = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    gram = (dense @ dense.T) * np.outer(signs, signs)
    alpha = np.zeros(len(rows))
    for _ in range(4000):
        for i in range(len(rows)):
            alpha[i] = min(max(alpha[i] - (gram[i] @ alpha - 1) / gram[i, i], 0), limit[i])
    own = dense.T @ (alpha * signs)
    margins = [weights[r].sum() + bias for r in rows]
    assert np.allclose(margins, dense @ own, atol=1e-3)


def test_columns_of_clashing_names_and_ties(spark):
    texts, labels = labelled(spark, 60)
    docs = documents(spark, texts).withColumnsRenamed({"lang": "score", "source": "__key", "n_chars": "first"})
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    model = qc.fit(docs, table, F.lit(True))
    rows = qc.score(docs.unionByName(docs), model).collect()
    assert len(rows) == 120 and rows[0].__fields__ == ["doc_id", "score", "predicted"]
    half = qc.Model(np.zeros(qc.FEATURES, np.float32), 0.0, 0.0, 0.0)
    assert {r.predicted for r in qc.score(docs, half, threshold=0.5).collect()} == {1}
