"""Change feeds by a digest tree: buckets of keys are compared before any row is.

A bucket is a hash range of the key; its digest is taken over the keys and rows in it and does not depend on their order. Digests
of FAN buckets make one of the level above. Two snapshots are compared from the top: only below nodes that differ are
buckets compared, and only rows of buckets that differ are joined. A tree can be stored with its
snapshot, so the next comparison need not read that snapshot to find out that most of it is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .changes import change_feed, keyed_rows
from .columns import comparable, quoted

BUCKETS = 1 << 16
FAN = 256
BUCKET, NODE = "__bucket", "__node"
DIGEST = ("n", "d1", "d2")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(buckets)).cast("int")


def _digest(digests: Sequence[Column]) -> list[Column]:
    n, d1, d2 = digests
    return [F.sum(n).alias("n"), F.bit_xor(d1).alias("d1"), F.bit_xor(d2).alias("d2")]


def digest_tree(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(__node, __bucket, n, d1, d2): the number of rows of each bucket that holds any and 128 bits over them.

    One scan, combined before the shuffle; the tree has at most `buckets` rows, whatever the table.
    """
    rows = keyed_rows(df, keys)
    names = sorted(c for c in df.columns if c not in keys)
    values = [*[quoted(k) for k in keys], *[F.struct(comparable(df, c)) for c in names]]
    marked = rows.select(
        bucket_of(keys, buckets).alias(BUCKET), F.xxhash64(F.lit(1), *values).alias("h1"), F.xxhash64(F.lit(2), *_nulls(values)).alias("h2")
    )
    tree = marked.groupBy(BUCKET).agg(*_digest([F.lit(1).cast("long"), F.col("h1"), F.col("h2")]))
    return tree.withColumn(NODE, F.floor(F.col(BUCKET) / FAN).cast("int")).select(NODE, BUCKET, *DIGEST)


def _nulls(values: Sequence[Column]) -> list[Column]:
    """Each value and whether it is NULL, as hashing skips NULLs."""
    return [c for v in values for c in (v, v.isNull())]


def _differ(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    there = right.select(*[F.col(c).alias(f"r_{c}") for c in (*by, *DIGEST)])
    on = reduce(lambda a, b: a & b, [left[c] == there[f"r_{c}"] for c in by])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(there[f"r_{c}"]) for c in DIGEST])
    return left.join(there, on, "full_outer").where(~same).select(*[F.coalesce(left[c], there[f"r_{c}"]).alias(c) for c in by])


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """(__bucket): the buckets in which two trees differ, looked for below nodes that differ only."""
    tops = [t.groupBy(NODE).agg(*_digest([F.col(c) for c in DIGEST])) for t in (before, after)]
    nodes = _differ(*tops, [NODE])
    below = [t.join(nodes, NODE, "left_semi") for t in (before, after)]
    return _differ(*below, [NODE, BUCKET]).select(BUCKET)


def change_feed_by_digest(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    version: Column | int,
    ts: Column,
    trees: tuple[DataFrame | None, DataFrame | None] = (None, None),
    buckets: int = BUCKETS,
) -> DataFrame:
    """`change_feed`, with rows of unchanged buckets left out ahead of the join.

    `trees` are stored trees of the snapshots (`digest_tree` with the same keys and `buckets`), or None to make them here.
    """
    after = after.select(*[quoted(c) for c in before.columns])
    made = [digest_tree(df, keys, buckets) if tree is None else tree for df, tree in zip((before, after), trees)]
    # At most `buckets` numbers of four bytes each.
    changed = F.broadcast(changed_buckets(*made))
    sides = [df.withColumn(BUCKET, bucket_of(keys, buckets)).join(changed, BUCKET, "left_semi").drop(BUCKET) for df in (before, after)]
    return change_feed(*sides, keys, version, ts)
