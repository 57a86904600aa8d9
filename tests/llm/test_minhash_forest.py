import random

import numpy as np
import pytest
from helpers import closed, documents, invented, word_list

from siltstone.llm.components import components
from siltstone.llm.minhash_forest import near_duplicates, parts_of


def shingles(text, size):
    w = word_list(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def plain(texts, size):
    sets = [shingles(t, size) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return closed(links, range(len(texts))), sets


def star(seed, count):
    """A text and near copies of it, each further from the others than from the text."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    out = [" ".join(base)]
    for k in range(count):
        own = list(base)
        for at in rnd.sample(range(0, 400, 4), 18):
            own[at] = f"k{k}x{at}"
        out.append(" ".join(own))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("size,region", [(2, 2048), (5, 2048), (2, 6)])
def test_components_match_all_pairs(spark, size, region):
    texts = [*invented(11, 60, words=(0, 40), vocabulary=500), None, "", " \n", "One", "one", "ONE two", "a b c"]
    texts += [*star(2, 40), *["copy of one text with several words in it"] * 30, "long " * 30_000, "Long " * 30_001]
    expected, sets = plain(texts, size)
    rows = near_duplicates(documents(spark, texts), shingle=size, region=region).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == expected[row.doc_id]
        assert row.kept == (row.component_id == row.doc_id)


def test_parts_follow_common_prefixes():
    rng = np.random.default_rng(5)
    for region in (1, 3, 10, 200):
        for width in (1, 2, 4):
            rows = rng.integers(0, 3, (rng.integers(1, 150), width)).astype(np.uint8)
            order = rows[np.lexsort(rows.T[::-1])]
            parts = parts_of(order, region)
            assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1] == len(order)
            assert all(0 < high - low <= region for low, high in parts)
            # Two parts that follow each other were not small enough together, or stand under different prefixes.
            for (low, middle), (_, high) in zip(parts, parts[1:]):
                if high - low <= region:
                    inner = [int((order[a] == order[b]).cumprod().sum()) for a, b in ((low, middle - 1), (middle, high - 1), (middle - 1, middle))]
                    assert inner[2] <= max(inner[:2])


def test_copies_of_copies_in_divided_regions(spark):
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(400)]

    def changed(words, count, mark):
        out = list(words)
        for at in rnd.sample([i for i in range(0, 400, 4) if out[i] == base[i]], count):
            out[at] = f"{mark}x{at}"
        return out

    copies = [changed(base, 1, f"c{k}") for k in range(200)]
    # Similar to their parents by 0.801, to the text all the others are near to by 0.793.
    children = [changed(copy, 22, f"d{k}") for k, copy in enumerate(copies[:24])]
    texts = [" ".join(words) for words in [base, *copies, *children]]
    expected, _ = plain(texts, 2)
    rows = near_duplicates(documents(spark, texts), shingle=2, region=6).collect()
    assert set(expected.values()) == {0}
    assert {r.doc_id: r.component_id for r in rows} == expected


def test_null_and_repeated_keys_clashing_columns_and_no_rows(spark):
    df = documents(spark, ["a b c d e f g", "a b c d e f g", "h i j"]).withColumnsRenamed({"lang": "node", "source": "id"})
    df = df.unionByName(df.where("doc_id = 1")).unionByName(df.selectExpr("CAST(NULL AS long) AS doc_id", "text", "node", "id", "n_chars"))
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert rows[:4] == [(False, 0, 0, True), (False, 1, 0, False), (False, 1, 0, False), (False, 2, 2, True)]
    assert rows[4:] == [(True, 0, None, True)] * 3
    assert near_duplicates(df.limit(0)).collect() == []


def test_components_of_chains_stars_and_nothing(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    rnd.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    expected = closed(links, {x for link in links for x in link})
    assert found == {n: expected[n] for n in found}
    assert set(found) == {x for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
