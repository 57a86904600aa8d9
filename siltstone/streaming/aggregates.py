"""Sums and counts kept up to date by micro-batches, without streaming state.

Every batch stores its own partial sums in a folder of its own; reading adds them up. A batch that
is run again replaces its folder, so nothing is counted twice. `fold` adds up the batches so far once, between batches,
and later reads take its result and the batches after it. For feeds with updates and deletes see `deltas`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class SumTarget:
    """Sums of `measures` by `keys`; batches must arrive already aggregated to these columns."""

    path: str
    keys: Sequence[str]
    measures: Sequence[str]

    def upsert(self, partial: DataFrame, batch_id: int) -> None:
        partial.select(*self.keys, *self.measures).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def _folded(self, spark: SparkSession) -> int | None:
        try:
            # Folder names only.
            return spark.read.parquet(f"{self.path}/_folds").agg(F.max("upto")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _parts(self, spark: SparkSession) -> DataFrame:
        """All rows there are to add up; `batch` is the number of the batch, or of the last one folded into a row."""
        stored, folded = spark.read.parquet(self.path), self._folded(spark)
        if folded is None:
            return stored
        base = spark.read.parquet(f"{self.path}/_folds").where(F.col("upto") == folded).withColumnRenamed("upto", "batch")
        return stored.where(F.col("batch") > folded).unionByName(base)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._parts(spark).groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])

    def fold(self, spark: SparkSession) -> None:
        """Store the sums of all batches so far; call it between batches."""
        parts = self._parts(spark)
        upto = parts.agg(F.max("batch")).first()[0]
        parts.groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures]).write.mode("overwrite").parquet(f"{self.path}/_folds/upto={upto}")
