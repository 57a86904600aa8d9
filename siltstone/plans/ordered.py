"""Row order within a key, without ever putting an unbounded key into one task.

Spark's window operator sorts all rows of a partition key in one task. A key with a large share of
the table would make that task the whole job. `Timeline` therefore looks at the row count per key
first. Ordinary keys take the plain window. Keys above the limit are range-partitioned on
(key, order), so their rows spread over many tasks; the window then runs within each slice, and
only the first and last row of every slice are matched up across slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import hot_key_rows, shared_dir

SLICE = "__slice"
# A slice takes at least so many rows, however few make a key hot: each slice costs a task, a sample for the borders and
# a report to the driver, so their number must stay far below that of the rows.
SLICE_ROWS = 100_000


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, int, bool] | None:
    """Keys with more than `limit` rows, their total row count, and whether NULLs may be among them.

    None if there are no such keys. The counting combines map-side and reads the key columns only; the
    keys found are stored, never brought to the driver, and how they are joined is left to Spark.
    """
    shared_dir(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    # Nearly always no key has so many rows; then one small job is all there is.
    if (counts.agg(F.max("__rows")).first()[0] or 0) <= limit:
        return None
    counted = counts.where(F.col("__rows") > limit).checkpoint()
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    found = counted.agg(F.sum("__rows").alias("total"), F.count_if(null_key).alias("nulls")).first()
    return counted.select(*keys), found["total"], found["nulls"] > 0


class Timeline:
    """Rows of a table ordered by `order` within `keys`; rows that tie on it must be equal in what is read off them."""

    def __init__(
        self, keys: Sequence[str], order: Sequence[str], cold: DataFrame, hot: DataFrame | None = None, null_keys: bool = True
    ):
        self.null_keys = null_keys
        self.keys = list(keys)
        self.order = list(order)
        self.cold = cold
        self.hot = hot

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot_rows: int | None = None,
        count_on: DataFrame | None = None,
    ) -> Timeline:
        """`count_on` is a cheaper frame with the key columns and at least the rows of `df` to count keys on."""
        spark = df.sparkSession
        limit = hot_rows or hot_key_rows(spark)
        found = hot_keys(df if count_on is None else count_on, keys, limit)
        if found is None:
            return cls(keys, order, df)
        hot, total, null_keys = found
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // max(limit, SLICE_ROWS)))
        shared_dir(spark)
        sliced = (
            df.join(hot, _same_keys(df, hot, keys), "left_semi")
            .repartitionByRange(slices, *keys, *order)
            .withColumn(SLICE, F.spark_partition_id())
            # The slice borders come from sampling, so they are fixed before the rows are read twice.
            .checkpoint()
        )
        return cls(keys, order, df.join(hot, _same_keys(df, hot, keys), "left_anti"), sliced, null_keys)

    def _window(self, hot: bool):
        return Window.partitionBy(*self.keys, *([SLICE] if hot else [])).orderBy(*self.order)

    def _with(self, cold: DataFrame, hot: DataFrame | None) -> Timeline:
        return Timeline(self.keys, self.order, cold, hot, self.null_keys)

    def with_neighbours(self, after: dict[str, Column] | None = None, before: dict[str, Column] | None = None) -> Timeline:
        """Add values of the next (`after`) and previous (`before`) row of the same key."""
        after, before = after or {}, before or {}

        def local(df: DataFrame, hot: bool) -> DataFrame:
            window = self._window(hot)
            added = {name: F.lead(value).over(window) for name, value in after.items()}
            added |= {name: F.lag(value).over(window) for name, value in before.items()}
            return df.withColumns(added)

        cold = local(self.cold, False)
        if self.hot is None:
            return self._with(cold, None)
        position = F.struct(*self.order)
        there = F.lit(True).alias("is")
        edges = self.hot.groupBy(*self.keys, SLICE).agg(
            F.min_by(F.struct(there, *[v.alias(n) for n, v in after.items()]), position).alias("first"),
            F.max_by(F.struct(there, *[v.alias(n) for n, v in before.items()]), position).alias("last"),
        )
        across = Window.partitionBy(*self.keys).orderBy(SLICE)
        edges = edges.withColumns(
            {"__first_after": F.lead("first").over(across), "__last_before": F.lag("last").over(across)}
        ).drop("first", "last")
        window = self._window(True)
        # The ends of a slice are found by position and not by value, as rows may be delivered twice.
        ends = {"__more": F.lead(F.lit(True)).over(window), "__since": F.lag(F.lit(True)).over(window)}
        joined = self._beside(local(self.hot, True).withColumns(ends), edges)
        fixed = {n: F.when(F.col("__more").isNull(), F.col("__first_after")[n]).otherwise(F.col(n)) for n in after}
        fixed |= {n: F.when(F.col("__since").isNull(), F.col("__last_before")[n]).otherwise(F.col(n)) for n in before}
        return self._with(cold, joined.withColumns(fixed).select(*self.hot.columns, *fixed))

    def _beside(self, rows: DataFrame, edges: DataFrame) -> DataFrame:
        """Rows joined with what is known about their slice; slices are bounded, so is the skew.

        Without NULL keys the join is on plain columns, so it keeps the partitioning of the window
        before it and that window's rows are not shuffled again.
        """
        names = [*self.keys, SLICE]
        edges = edges.withColumnsRenamed({name: f"__edge{i}" for i, name in enumerate(names)})
        sides = [(rows[n], edges[f"__edge{i}"]) for i, n in enumerate(names)]
        on = [a.eqNullSafe(b) if self.null_keys else a == b for a, b in sides]
        return rows.join(edges, reduce(lambda a, b: a & b, on))

    def with_row_number(self, name: str, descending: str | None = None) -> Timeline:
        """Add the 1-based position, and under the name `descending` the position from the end."""

        def local(df: DataFrame, hot: bool) -> DataFrame:
            window = self._window(hot)
            df = df.withColumn(name, F.row_number().over(window).cast("bigint"))
            if descending and not hot:
                whole = Window.partitionBy(*self.keys)
                df = df.withColumn(descending, F.count(F.lit(1)).over(whole) - F.col(name) + 1)
            return df

        cold = local(self.cold, False)
        if self.hot is None:
            return self._with(cold, None)
        across = Window.partitionBy(*self.keys).orderBy(SLICE)
        edges = self.hot.groupBy(*self.keys, SLICE).agg(F.count(F.lit(1)).alias("__n"))
        edges = edges.withColumns(
            {
                "__before": F.coalesce(
                    F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "__total": F.sum("__n").over(Window.partitionBy(*self.keys)),
            }
        )
        joined = self._beside(local(self.hot, True), edges)
        number = F.col(name) + F.col("__before")
        columns = [F.col(c) for c in self.hot.columns] + [number.alias(name)]
        if descending:
            columns.append((F.col("__total") - number + 1).alias(descending))
        return self._with(cold, joined.select(*columns))

    def where(self, condition: Column) -> Timeline:
        return self._with(self.cold.where(condition), self.hot.where(condition) if self.hot is not None else None)

    def frame(self) -> DataFrame:
        """All rows again as one DataFrame."""
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(SLICE))
