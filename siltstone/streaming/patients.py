"""The patient flow as micro-batches: one parse feeds both history and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import FAILED, PATIENT_RULES, quarantine_records, split_valid, validate
from ..operators.changes import RESERVED
from ..plans.patients import (
    DELETED, FLOW_NAME, KEYS, PAYLOAD_DIGEST, QUARANTINE_COLUMNS, SEQUENCE, TABLE_NAME, tie_break, typed_patients,
)
from .targets import ScdTarget


class PatientStream:
    """Type-1 or type-2 patients below `path`, and the records that failed a rule."""

    def __init__(self, path: str, scd_type: int = 2, rules: dict[str, str] | None = None, buckets: int = 256):
        self.path = path
        self.rules = rules or PATIENT_RULES
        self.target = ScdTarget(
            f"{path}/patients", KEYS, SEQUENCE, scd_type, DELETED, except_cols=[*RESERVED, PAYLOAD_DIGEST], buckets=buckets
        )

    def upsert(self, feed: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of the change feed; use it as the function of `foreachBatch`."""
        checked = validate(typed_patients(feed, F.current_timestamp()), self.rules).persist()
        try:
            _, failed = split_valid(checked)
            gone = F.coalesce(F.expr(DELETED), F.lit(False))
            valid = checked.where(F.col(FAILED).isNull() | gone).drop(FAILED)
            records = quarantine_records(
                failed.drop(FAILED), self.rules, FLOW_NAME, TABLE_NAME, QUARANTINE_COLUMNS, F.current_timestamp()
            )
            self.target.tie_break = tie_break(valid.columns)
            records.write.mode("overwrite").parquet(f"{self.path}/failed/batch={batch_id}")
            self.target.upsert(valid, batch_id)
        finally:
            checked.unpersist()

    def patients(self, spark: SparkSession) -> DataFrame:
        return self.target.read(spark)

    def failed(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/failed").drop("batch")
