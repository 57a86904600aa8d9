"""Token counts: an exact histogram of encoded lengths, and suffix sums over it.

Documents are reduced to (length, how many) first; every further answer reads that histogram only.
For a context limit L the suffix sums give, exactly, how many documents reach L and how many tokens
are left when every document is cut at L: sum(min(length, L)).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# Lengths per block of the two-level sums; a block's histogram has at most this many rows.
BLOCK = 1024


def byte_encoder(path: str, pattern: str):
    """A tokenizer of a rank file, built once per Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_encoders: dict[tuple[str, str], object] = {}


def encoded_lengths(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Replace all columns by `length`: the number of tokens of each row's text; NULL and '' have 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if (path, pattern) not in _encoders:
            _encoders[path, pattern] = byte_encoder(path, pattern)
        encode = _encoders[path, pattern].encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"length": [len(encode(t)) if t else 0 for t in batch[text]]}, dtype="int64")

    return df.select(text).mapInPandas(count, "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(length, n_docs); counted map-side, so a very common length costs one row per task."""
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per distinct length L: documents and tokens at and below it, and totals for the context limit L.

    n_docs: documents of exactly L tokens; n_up_to: of at most L (so the quantile of L is
    n_up_to / total); n_at_least: of L or more; tokens_at_least: their tokens; truncated_tokens: tokens
    left when all documents are cut at L; total_docs, total_tokens: of the whole table.

    Sums are taken in two levels, blocks of lengths first, so no task sorts the whole histogram.
    An empty table gives no rows.
    """
    with_block = histogram.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = with_block.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    later = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("tokens_later"),
        F.sum("docs").over(whole).alias("total_docs"),
        F.sum("tokens").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = with_block.join(later, "block").withColumns(
        {
            "n_at_least": F.sum("n_docs").over(inside) + F.col("docs_later"),
            "tokens_at_least": F.sum("tokens").over(inside) + F.col("tokens_later"),
        }
    )
    return summed.select(
        "length",
        "n_docs",
        (F.col("total_docs") - F.col("n_at_least") + F.col("n_docs")).alias("n_up_to"),
        "n_at_least",
        "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_at_least") * F.col("length")).alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left when every document is cut at any `limit`, also one that no document has."""
    reached = F.col("length") >= limit
    first = F.min_by(F.struct("n_at_least", "tokens_at_least"), F.when(reached, F.col("length")))
    found = sums.agg(first.alias("at"), F.max("total_tokens").alias("total"))
    cut = F.col("total") - F.col("at.tokens_at_least") + F.col("at.n_at_least") * F.lit(limit)
    return found.select(F.coalesce(cut, F.col("total"), F.lit(0)).alias("truncated_tokens"))


def length_quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share `q` of documents does not exceed."""
    return sums.where(F.col("n_up_to") >= F.lit(q) * F.col("total_docs")).agg(F.min("length").alias("length"))
