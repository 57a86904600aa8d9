import math
from collections import Counter

import pytest
from helpers import documents, invented, word_list
from pyspark.sql import functions as F

from siltstone.llm import lm_scoring


def plain_model(texts):
    count, pairs = Counter(), Counter()
    for text in texts:
        tokens = [*word_list(text), 0]
        count.update(tokens)
        pairs.update(zip([1, *tokens[:-1]], tokens))
    ends, total = Counter(w for _, w in pairs), Counter()
    cut2 = (0, *lm_scoring.discounts([sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)]))
    cut1 = (0, *lm_scoring.discounts([sum(n == k for n in ends.values()) for k in (1, 2, 3, 4)]))
    left = Counter()
    for (v, _), n in pairs.items():
        total[v] += n
        left[v] += cut2[min(n, 3)]
    spare = sum(cut1[min(n, 3)] for n in ends.values())

    def one(w):
        return (ends[w] - cut1[min(ends[w], 3)] + spare / (len(count) + 1)) / len(pairs) if pairs else 1 / (len(count) + 1)

    def two(v, w):
        n = pairs[v, w]
        return (n - cut2[min(n, 3)] + left[v] * one(w)) / total[v] if total[v] else one(w)

    return count, one, two


@pytest.mark.parametrize("shards", [1, 5])
def test_scores_match_plain_counts(spark, shards):
    texts = [*invented(3, 60), None, "", " \t\n", "Unseen WORDS only", "ab " * 30_000]
    df = documents(spark, texts)
    df = df.unionByName(df.where("doc_id = 1"))
    model = lm_scoring.train(df.where("doc_id % 3 <> 0"), shards=shards)
    used = [t for i, t in enumerate(texts) if i % 3] + ([texts[1]])
    count, one, two = plain_model(used)
    assert model.tokens == sum(count.values()) and model.types == len(count)
    assert abs(sum(one(w) for w in count) + one(b"\0none") - 1) < 1e-9
    assert abs(sum(two(1, w) for w in count) + two(1, b"\0none") - 1) < 1e-9
    rows = lm_scoring.score(df, model, ["doc_id", "lang"]).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        tokens = [*word_list(texts[row.doc_id]), 0]
        assert (row.n_tokens, row.n_known) == (len(tokens), sum(count[w] > 0 for w in tokens))
        assert row.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (model.tokens + model.types + 1)) for w in tokens))
        assert row.score == pytest.approx(sum(math.log10(two(v, w)) for v, w in zip([1, *tokens[:-1]], tokens)))


def test_without_training_rows_and_without_rows(spark):
    df = documents(spark, ["a b", None])
    rows = lm_scoring.score_with_corpus(df, F.lit(False), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in rows) == [(0, 3, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0)]
    assert lm_scoring.score_with_corpus(df.limit(0), F.lit(True), ["doc_id"]).collect() == []


def test_kept_columns_called_like_the_scores(spark):
    df = documents(spark, ["a b", "a b", "c"]).withColumnsRenamed({"lang": "score", "source": "n_tokens"})
    rows = lm_scoring.score_with_corpus(df.unionByName(df), F.lit(True), ["doc_id", "score", "n_tokens", "n_chars"]).collect()
    assert rows[0].__fields__ == ["doc_id", "n_chars", *lm_scoring.SCORES]
    assert len({r.score for r in rows if r.doc_id < 2}) == 1 and len(rows) == 6


def test_model_folder_must_be_mounted():
    with pytest.raises(ValueError):
        lm_scoring.local_folder("hdfs://somewhere/checkpoints")
