"""Sums and counts kept from a change feed.

Every change is a signed delta: inserts and postimages add, deletes and preimages subtract, so an update that moves a row
from one group to another takes it out of the first. The running totals are Spark's own streaming aggregation;
a micro-batch writes the totals of the groups it touched, and the newest row of a group is its state. Deltas add up in any
order, so changes may arrive in any.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators.changes import CHANGE_TYPE
from ..operators.columns import quoted
from .keyed import BATCH, with_rocksdb

ROWS = "__rows"
UPTO = "__upto"


def change_sign() -> Column:
    """1 for a row that comes, -1 for one that goes; any other kind of change counts for nothing."""
    kind = F.col(CHANGE_TYPE)
    return F.when(kind.isin("insert", "update_postimage"), 1).when(kind.isin("delete", "update_preimage"), -1).otherwise(0)


def signed_totals(changes: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per group the sums of deltas, and how many rows and non-NULL measures they leave.

    Measures must be exact: fractions as decimals, as sums of doubles do not come back to where they were.
    """
    inexact = [m for m in measures if isinstance(changes.schema[m].dataType, (FloatType, DoubleType))]
    if inexact:
        raise ValueError(f"measures must be whole numbers or decimals: {inexact}")
    sign = change_sign()
    sums = [F.sum(sign * quoted(m)).alias(m) for m in measures]
    present = [F.sum(F.when(quoted(m).isNotNull(), sign).otherwise(0)).alias(f"{ROWS}_{i}") for i, m in enumerate(measures)]
    return changes.groupBy(*keys).agg(*sums, *present, F.sum(sign).alias(ROWS))


@dataclass
class DeltaMart:
    """Totals of `measures` by `keys` below `path`; `rows` shapes the feed, and must keep its change type."""

    path: str
    keys: Sequence[str]
    measures: Sequence[str]
    rows: Callable[[DataFrame], DataFrame] = lambda feed: feed

    def run(self, feed: DataFrame, checkpoint: str) -> None:
        """Take in all changes there are, and stop; a batch that runs again replaces what it wrote."""
        totals = signed_totals(self.rows(feed), self.keys, self.measures)
        with_rocksdb(totals, lambda t: t.writeStream.foreachBatch(self._store).option("checkpointLocation", checkpoint).outputMode("update"))

    def _store(self, totals: DataFrame, batch_id: int) -> None:
        totals.write.mode("overwrite").parquet(f"{self.path}/totals/{BATCH}={batch_id}")

    def _folded(self, spark: SparkSession) -> int | None:
        try:
            # Folder names only.
            return spark.read.parquet(f"{self.path}/folds").agg(F.max(UPTO)).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _newest(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.option("basePath", f"{self.path}/totals").parquet(f"{self.path}/totals")
        folded = self._folded(spark)
        if folded is not None:
            base = spark.read.parquet(f"{self.path}/folds").where(F.col(UPTO) == folded)
            stored = stored.where(F.col(BATCH) > folded).unionByName(base.withColumnRenamed(UPTO, BATCH))
        state = [c for c in stored.columns if c not in (*self.keys, BATCH)]
        newest = stored.groupBy(*self.keys).agg(F.max_by(F.struct(*state), BATCH).alias("__s"), F.max(BATCH).alias(BATCH))
        return newest.select(*self.keys, "__s.*", BATCH)

    def fold(self, spark: SparkSession) -> None:
        """Store every group's newest row once; later reads take this and the batches after it."""
        newest = self._newest(spark).checkpoint()
        upto = newest.agg(F.max(BATCH)).first()[0]
        if upto is not None:
            newest.drop(BATCH).where(F.col(ROWS) != 0).write.mode("overwrite").parquet(f"{self.path}/folds/{UPTO}={upto}")

    def read(self, spark: SparkSession) -> DataFrame:
        """Groups with at least one row; a sum of no values is NULL."""
        totals = self._newest(spark).where(F.col(ROWS) > 0)
        sums = [F.when(F.col(f"{ROWS}_{i}") > 0, quoted(m)).alias(m) for i, m in enumerate(self.measures)]
        return totals.select(*self.keys, *sums, F.col(ROWS).alias("n_rows"))
