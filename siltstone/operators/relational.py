"""Joins, aggregates and orderings of the silver and gold layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ordered import Timeline
from .columns import quoted, row_digest


def enrich(orders: DataFrame, customers: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on named columns; NULL keys match nothing.

    No hint is set: Spark broadcasts the right side when it is known to be small, and otherwise
    splits skewed partitions of the sort-merge join at run time.
    """
    return orders.join(customers, list(on), how)


def left_match(left: DataFrame, right: DataFrame, on: Sequence[str], found: str = "matched") -> DataFrame:
    """The left rows with right columns where there is a match, and whether there was one."""
    marked = right.withColumn(found, F.lit(True))
    return left.join(marked, list(on), "left").withColumn(found, F.coalesce(F.col(found), F.lit(False)))


def consecutive_pairs(
    df: DataFrame, key: Sequence[str], order: Sequence[str], cols: Sequence[str], hot_rows: int | None = None
) -> DataFrame:
    """Each row with the next one of its key, as `before_*` and `after_*` columns. One shuffle."""
    after = {f"after_{c}": quoted(c) for c in cols}
    line = Timeline.of(df, key, order, hot_rows)
    line = line.with_neighbours(after={**after, "__has": F.lit(True)}).where(F.col("__has").isNotNull())
    return line.frame().select(*key, *[quoted(c).alias(f"before_{c}") for c in cols], *after)


def first_last(df: DataFrame, key: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The first and the last row per key side by side, by one aggregation; of rows that tie, the smallest or largest hash."""
    position = F.struct(*order, row_digest(df, list(cols)))
    row = F.struct(*[quoted(c) for c in cols])
    ends = df.groupBy(*key).agg(F.min_by(row, position).alias("f"), F.max_by(row, position).alias("l"))
    return ends.select(
        *key, *[F.col("f")[c].alias(f"first_{c}") for c in cols], *[F.col("l")[c].alias(f"last_{c}") for c in cols]
    )


def rank_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """`rn_asc` and `rn_desc`, the positions of a row in its key from the start and from the end."""
    return Timeline.of(df, key, order, hot_rows).with_row_number("rn_asc", "rn_desc").frame()


def explode_rows(df: DataFrame, col: str, outer: bool = False, alias: str | None = None) -> DataFrame:
    others = [quoted(c) for c in df.columns if c != col]
    return df.select(*others, (F.explode_outer if outer else F.explode)(quoted(col)).alias(alias or col))


def sum_exploded(
    df: DataFrame, array_col: str, keys: Sequence[Column | str], element_keys: Mapping[str, str], measures: Mapping[str, str]
) -> DataFrame:
    """Sums over the elements of an array column, grouped by row keys and element fields.

    `element_keys` and `measures` map output names to element fields. The explode feeds the
    map-side half of the aggregation, so elements are never shuffled.
    """
    rows = df.select(*keys, F.explode(quoted(array_col)).alias("__e"))
    names = [k if isinstance(k, str) else c for k, c in zip(keys, rows.columns)]
    grouped = rows.groupBy(*names, *[F.col("__e")[f].alias(n) for n, f in element_keys.items()])
    return grouped.agg(*[F.sum(F.col("__e")[f]).alias(n) for n, f in measures.items()])


def count_by(df: DataFrame, keys: Sequence[str], name: str = "rcrd_cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, cols: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """The number of distinct combinations, NULLs included."""
    return df.select(*[quoted(c) for c in cols]).distinct().agg(F.count(F.lit(1)).alias(name))


def union_named(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
