import public_tokenizers
from helpers import documents, invented

from siltstone.llm.queries import RANKS
from siltstone.llm.token_counts import byte_encoder, encoded_lengths, length_histogram, length_quantile, suffix_sums, truncated_total


def test_sums_match_plain_counts(spark):
    texts = [*invented(7, 50), None, "", "<|endoftext|> ", "long text " * 20_000, "same", "same"]
    encoder = byte_encoder(RANKS, public_tokenizers.PATTERN)
    lengths = [len(encoder.encode_ordinary(t or "")) for t in texts]
    df = documents(spark, texts).withColumnsRenamed({"lang": "length", "source": "n_docs"})
    sums = suffix_sums(length_histogram(encoded_lengths(df, RANKS, public_tokenizers.PATTERN)))
    rows = sums.collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths))
    for r in rows:
        assert r.n_docs == lengths.count(r.length)
        assert r.n_up_to == sum(x <= r.length for x in lengths)
        assert r.n_at_least == sum(x >= r.length for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= r.length)
        assert r.truncated_tokens == sum(min(x, r.length) for x in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
    for limit in (0, 1, 7, 1000, 10**7):
        assert truncated_total(sums, limit).first()[0] == sum(min(x, limit) for x in lengths)
    for q in (0.01, 0.5, 0.9, 1.0):
        ranked = sorted(lengths)
        assert length_quantile(sums, q).first()[0] == next(x for i, x in enumerate(ranked, 1) if i >= q * len(ranked))


def test_no_rows(spark):
    df = documents(spark, ["x"]).limit(0)
    sums = suffix_sums(length_histogram(encoded_lengths(df, RANKS, public_tokenizers.PATTERN)))
    assert sums.collect() == []
    assert truncated_total(sums, 10).first()[0] == 0
    assert length_quantile(sums, 0.5).first()[0] is None
