"""Change feeds: rows of a table plus what happened to them, in which commit and when."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .columns import comparable, quoted

# Names of the change columns.
CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
RESERVED = [CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP]


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], version: Column | int, ts: Column) -> DataFrame:
    """Row changes between two snapshots of a table whose `keys` identify a row.

    An update gives two rows, `update_preimage` and `update_postimage`. One full outer join on
    the keys; both images come out of the same joined row. Rows with NULL in a key identify nothing
    and are left out; `unkeyed_rows` gives them.
    """
    columns = before.columns
    before, after = keyed_rows(before, keys), keyed_rows(after, keys)
    rest = [c for c in columns if c not in keys]

    def side(df: DataFrame, tag: str) -> DataFrame:
        same = F.struct(F.lit(True).alias("is"), *[comparable(df, c).alias(f"c{i}") for i, c in enumerate(rest)])
        return df.select(
            *[quoted(k).alias(f"{tag}{i}") for i, k in enumerate(keys)],
            F.struct(*[quoted(c) for c in columns]).alias(f"{tag}_row"),
            same.alias(f"{tag}_same"),
        )

    old, new = side(before, "b"), side(after.select(*[quoted(c) for c in columns]), "a")
    on = reduce(lambda x, y: x & y, [old[f"b{i}"] == new[f"a{i}"] for i in range(len(keys))])
    pair = old.join(new, on, "full_outer")

    def image(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    images = (
        F.when(F.col("b_same").isNull(), F.array(image("insert", "a_row")))
        .when(F.col("a_same").isNull(), F.array(image("delete", "b_row")))
        .when(
            F.col("b_same") != F.col("a_same"),
            F.array(image("update_preimage", "b_row"), image("update_postimage", "a_row")),
        )
    )
    return pair.select(F.explode(images).alias("image")).select(
        *[F.col("image.row")[c].alias(c) for c in columns],
        F.col("image.kind").alias(CHANGE_TYPE),
        (F.lit(version) if isinstance(version, int) else version).cast("bigint").alias(COMMIT_VERSION),
        ts.alias(COMMIT_TIMESTAMP),
    )


def keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda x, y: x & y, [quoted(k).isNotNull() for k in keys]))


def unkeyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a change feed leaves out, as a key column is NULL."""
    return df.where(reduce(lambda x, y: x | y, [quoted(k).isNull() for k in keys]))


def insert_feed(df: DataFrame, version: Column | int, ts: Column) -> DataFrame:
    """The change feed of an append-only table: every row of a commit is an insert."""
    return df.select(
        "*",
        F.lit("insert").alias(CHANGE_TYPE),
        (F.lit(version) if isinstance(version, int) else version).cast("bigint").alias(COMMIT_VERSION),
        ts.alias(COMMIT_TIMESTAMP),
    )


def commit_summary(feed: DataFrame) -> DataFrame:
    """Rows per change type, commit version and commit timestamp."""
    return _commits(feed).groupBy("change_type", "commit_version", "commit_timestamp").agg(F.count(F.lit(1)).alias("rcrd_cnt"))


def commit_summary_all(feeds: dict[str, DataFrame]) -> DataFrame:
    """The commit summary of many tables, with the table name in front."""
    named = [_commits(feed).withColumn("table_name", F.lit(name)) for name, feed in feeds.items()]
    union = reduce(DataFrame.unionByName, named)
    return union.groupBy("table_name", "change_type", "commit_version", "commit_timestamp").agg(
        F.count(F.lit(1)).alias("rcrd_cnt")
    )


def _commits(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col(CHANGE_TYPE).alias("change_type"),
        F.col(COMMIT_VERSION).alias("commit_version"),
        F.col(COMMIT_TIMESTAMP).alias("commit_timestamp"),
    )


def drop_reserved(df: DataFrame) -> DataFrame:
    """The frame without the three change columns."""
    return df.drop(*RESERVED)


def except_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)
