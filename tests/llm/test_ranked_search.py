import math
import random
import re
from collections import Counter

import numpy as np
from helpers import documents, lowered

from siltstone.llm import ranked_search
from siltstone.llm.ranked_search import Index, search

TERM = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain(docs, items, top):
    """(item, rank, doc, score) by scoring every document; docs and items are (id, text)."""
    counted = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    n, size = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c in counted:
            m = 50 + (50 * c.total() * n) // max(size, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(TERM.findall(lowered(text))) if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def wordy(seed, count):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ü1", "a-b", "C"]
    return [" ".join(vocabulary[min(int(rnd.expovariate(0.1)), 43)] for _ in range(rnd.randint(0, 25))) for _ in range(count)]


def found(docs, items, **how):
    return sorted((tuple(r) for r in search(docs, items, **how).collect()), key=repr)


def test_ranks_match_scoring_everything(spark, monkeypatch):
    texts = [*wordy(1, 300), None, "", "...", "w1 " * 20_000, *["w3 w4 w5"] * 80]
    queries = [*wordy(2, 12), "w3 w3 W3", None, "", "nowhere", "w3 w4 w5"]
    df = documents(spark, texts)
    items = spark.createDataFrame(list(enumerate(queries)), "item_id long, text string")
    for top in (5, 50):
        assert found(df, items, top=top) == plain(enumerate(texts), enumerate(queries), top)
    # Several blocks of queries and segments of documents.
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 40)
    assert found(df, items, top=7) == plain(enumerate(texts), enumerate(queries), 7)


def test_repeated_rows_null_and_text_ids_clashing_columns_and_no_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "a"), (None, "a"), (1, "b c"), (None, None)]
    df = spark.createDataFrame([(i, t, t, i) for i, t in rows], "doc_id long, text string, score string, rank long")
    items = [("x", "a"), ("x", "a"), ("x", "b"), (None, "c")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc int")
    documents(spark, [])
    assert found(df, frame) == plain(rows, items, 50)
    assert found(df.limit(0), frame) == [] and found(df, frame.limit(0)) == []
    named = df.selectExpr("concat('d', doc_id) AS name", "text AS body")
    assert {r.name for r in search(named, frame, "name", "body").collect()} == {"d1", "d2", None}


def test_reading_stops_before_the_lists_end_and_misses_no_tie():
    rnd = np.random.default_rng(3)
    docs = 20_000
    term = np.repeat(np.arange(3), docs)
    impact = np.concatenate([(rnd.pareto(1.0, docs) * 100).astype(np.int64) + 1 for _ in range(3)])
    impact[:5000] = 7
    index = Index(term, np.tile(np.arange(docs), 3), impact)
    best, scores, read = index.best(np.arange(3), 20)
    totals = impact.reshape(3, -1).sum(axis=0)
    order = np.lexsort((np.arange(docs), -totals))[:20]
    assert best.tolist() == order.tolist() and scores.tolist() == totals[order].tolist()
    assert read < docs / 4
    # All impacts are equal: the first documents win, and the bound is never strictly below.
    flat = Index(np.zeros(500, np.int64), np.arange(500)[::-1].copy(), np.full(500, 9))
    assert flat.best(np.array([0]), 3)[0].tolist() == [0, 1, 2]
    assert flat.best(np.array([4]), 3)[0].tolist() == []
