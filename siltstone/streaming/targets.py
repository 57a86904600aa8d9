"""Targets kept up to date by micro-batches, on plain Parquet.

A target folder holds the changes received so far, one partition per (bucket, batch), and the
table computed from them, one partition per bucket. A micro-batch replaces its own change
partitions and then recomputes the buckets it touched. Both steps overwrite what they wrote
before, so a batch that is run again, after a failure or by mistake, leaves the same table. The
table of a bucket depends on all its changes and not on their order of arrival, so late rows,
duplicates and rows older than a delete come out right.

Recomputing a bucket costs as much as the bucket holds. For small batches over a large table set
`refresh_each_batch=False`: batches then only store their changes, and `refresh` brings up to date
all buckets touched since it last ran. `compact` merges the small files many batches leave behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..operators.changes import RESERVED
from ..operators.columns import quoted
from ..operators.evolve import SchemaRegistry, conform, merge_types
from ..operators.scd import apply_scd1, apply_scd2, unusable_changes, usable

BUCKET = "__bucket"
BATCH = "__batch"
DELETED = "__deleted"


@dataclass
class ScdTarget:
    """A type-1 or type-2 table fed by change batches."""

    path: str
    keys: Sequence[str]
    sequence_by: Sequence[str]
    scd_type: int = 1
    delete_when: str | None = None
    except_cols: Sequence[str] = field(default_factory=lambda: list(RESERVED))
    track: Sequence[str] | None = None
    valid_from: str | None = None
    buckets: int = 256
    at: Column | None = None
    refresh_each_batch: bool = True
    tie_break: Sequence[str] | None = None

    def __post_init__(self):
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")

    def changes_path(self, spark: SparkSession) -> str:
        return f"{self.path}/changes-{self._registry(spark).text('generation') or 0}"

    def _registry(self, spark: SparkSession) -> SchemaRegistry:
        return SchemaRegistry(spark, f"{self.path}/schema")

    @property
    def table_path(self) -> str:
        return f"{self.path}/table"

    @property
    def quarantine_path(self) -> str:
        return f"{self.path}/quarantine"

    def _write(self, df: DataFrame, path: str, *partitions: str) -> None:
        # Rebalancing by bucket keeps files few, and Spark splits a bucket that got too big.
        writer = df.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch; use it as the function of `foreachBatch`."""
        spark = batch.sparkSession
        schema = self._widened(batch)
        bucket = F.pmod(F.xxhash64(*[quoted(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")
        rows = conform(batch, schema).withColumns({BUCKET: bucket, BATCH: F.lit(batch_id).cast("bigint")}).persist()
        try:
            is_good = usable(self.keys, self.sequence_by)
            good = rows.where(is_good)
            # At most two rows per bucket come to the driver here.
            found = rows.select(BUCKET, is_good.alias("good")).distinct().collect()
            touched = sorted(r[BUCKET] for r in found if r["good"])
            if not all(r["good"] for r in found):
                self._write(unusable_changes(rows, self.keys, self.sequence_by).drop(BUCKET), self.quarantine_path, BATCH)
            if touched:
                self._write(good, self.changes_path(spark), BUCKET, BATCH)
        finally:
            rows.unpersist()
        if touched and self.refresh_each_batch:
            self._recompute(spark, touched)

    def refresh(self, spark: SparkSession) -> None:
        """Recompute the buckets that took in changes after the last refresh."""
        marks = f"{self.path}/refreshed"
        try:
            done = spark.read.schema("batch BIGINT").json(marks).agg(F.max("batch")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            done = None
        # Both columns are folder names, so this reads no data.
        newer = self._changes(spark).select(BUCKET, BATCH).where(F.col(BATCH) > (-1 if done is None else done))
        found = newer.groupBy(BUCKET).agg(F.max(BATCH).alias("batch")).collect()
        if found:
            self._recompute(spark, [r[BUCKET] for r in found])
            mark = spark.createDataFrame([(max(r["batch"] for r in found),)], "batch BIGINT")
            mark.coalesce(1).write.mode("append").json(marks)

    def compact(self, spark: SparkSession) -> str:
        """Store the changes anew, one folder per bucket, and use that copy from now on.

        Type 1 keeps the newest change per key only, deletes included. Call it between batches.
        Returns the path of the copy no longer used, which may be deleted.
        """
        old, changes = self.changes_path(spark), self._changes(spark)
        newest = changes.select(BATCH).agg(F.max(BATCH)).first()[0]
        kept = changes.drop(BATCH)
        if self.scd_type == 1:
            kept = apply_scd1(
                kept, self.keys, self.sequence_by, self.delete_when, deleted_flag=DELETED, tie_break=self.tie_break
            ).drop(DELETED)
        generation = int(self._registry(spark).text("generation") or 0) + 1
        self._write(kept.withColumn(BATCH, F.lit(newest)), f"{self.path}/changes-{generation}", BUCKET, BATCH)
        # Readers and later batches switch over with this one small file.
        self._registry(spark).set_text("generation", str(generation))
        return old

    def _recompute(self, spark: SparkSession, buckets: Sequence[int]) -> None:
        changes = self._changes(spark).where(F.col(BUCKET).isin(list(buckets)))
        self._write(self._table(changes.drop(BATCH)), self.table_path, BUCKET)

    def _changes(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.changes_path(spark), self._schema(spark).add(BATCH, LongType()))

    def _schema(self, spark: SparkSession) -> StructType:
        return self._registry(spark).load("changes").add(BUCKET, IntegerType())

    def _widened(self, batch: DataFrame) -> StructType:
        """The batch's schema merged with that of all batches before it."""
        registry = self._registry(batch.sparkSession)
        stored = registry.load("changes")
        schema = merge_types(stored, batch.schema) if stored is not None else batch.schema
        registry.store("changes", schema)
        return schema

    def _read(self, spark: SparkSession, path: str, schema: StructType) -> DataFrame:
        # With the schema given, Spark opens no footers to find it; older files lack new columns.
        return spark.read.schema(schema).parquet(path)

    def _table(self, rows: DataFrame) -> DataFrame:
        if self.scd_type == 1:
            # Deleted keys stay as marked rows, so a bucket left with none of its keys is still rewritten.
            return apply_scd1(
                rows, self.keys, self.sequence_by, self.delete_when, self.except_cols, self.at, DELETED, self.tie_break
            )
        return apply_scd2(
            rows, self.keys, self.sequence_by, self.delete_when, self.except_cols, self.track, self.valid_from, self.at,
            tie_break=self.tie_break,
        )

    def read(self, spark: SparkSession) -> DataFrame:
        empty = spark.createDataFrame([], self._schema(spark))
        table = self._read(spark, self.table_path, self._table(empty).schema).drop(BUCKET)
        if self.scd_type == 1:
            table = table.where(~F.col(DELETED)).drop(DELETED)
        return table

    def quarantined(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("mergeSchema", "true").parquet(self.quarantine_path).drop(BATCH)
