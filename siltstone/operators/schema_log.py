"""Schemas of tables now and over time, from a log of flow definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsoncols import json_path
from ..session import shared_dir
from .relational import consecutive_pairs

# The shape of the log and of a schema inside it.
FLOW_DEFINITION = "flow_definition"
SCHEMA_ELEMENTS = "array<struct<name:string,path:array<string>,data_type:string>>"
LOG_SCHEMA = "timestamp TIMESTAMP, event_type STRING, details STRING"


def schema_audit(df: DataFrame, at: Column) -> DataFrame:
    """One row per column of `df`: name, type, audit time."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name STRING, data_type STRING").withColumn("audit_ts", at)


def describe(df: DataFrame) -> DataFrame:
    """Column list with name, type and comment."""
    rows = [(f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name STRING, data_type STRING, comment STRING")


def flow_definition_entry(df: DataFrame, dataset: str, at: Column) -> DataFrame:
    """The log row a run writes for a dataset: its schema as JSON inside `details`."""
    elements = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("name"), F.array(F.lit(f.name)).alias("path"), F.lit(f.dataType.simpleString()).alias("data_type")
            )
            for f in df.schema.fields
        ]
    )
    definition = F.struct(F.lit(dataset).alias("output_dataset"), elements.alias("schema"))
    return df.sparkSession.range(1).select(
        at.alias("timestamp"),
        F.lit(FLOW_DEFINITION).alias("event_type"),
        F.to_json(F.struct(definition.alias(FLOW_DEFINITION))).alias("details"),
    )


def append_flow_definition(df: DataFrame, dataset: str, log_path: str, at: Column) -> None:
    flow_definition_entry(df, dataset, at).coalesce(1).write.mode("append").parquet(log_path)


def flow_definitions(log: DataFrame, table: str | None = None) -> DataFrame:
    """Flow-definition rows of an event log as (output_table, timestamp, schema_json)."""
    rows = log.where(F.col("event_type") == FLOW_DEFINITION).select(
        json_path(F.col("details"), "flow_definition.output_dataset").alias("output_table"),
        F.col("timestamp"),
        json_path(F.col("details"), "flow_definition.schema").alias("schema_json"),
    )
    return rows if table is None else rows.where(F.col("output_table") == table)


def schema_history(log: DataFrame, table: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Each schema of a dataset with the one that followed it, newest first. Definitions are taken from the log's JSON once, and stored."""
    shared_dir(log.sparkSession)
    pairs = consecutive_pairs(
        flow_definitions(log, table).checkpoint(), ["output_table"], ["timestamp", "schema_json"], ["schema_json", "timestamp"], hot_rows
    )
    return pairs.select(
        "output_table",
        F.col("before_schema_json").alias("before_schema"),
        F.col("after_schema_json").alias("after_schema"),
        F.col("before_timestamp").alias("before_ts"),
        F.col("after_timestamp").alias("after_ts"),
    ).orderBy(F.col("after_ts").desc(), "output_table")


def schema_diff(log: DataFrame, table: str | None = None) -> DataFrame:
    """Columns of a dataset's first and last schema: NEW, REMOVED, CHANGED or MATCHED.

    First and last schema come from one aggregation, and the columns of both are matched inside
    the row, so nothing is joined.
    """
    position = F.struct("timestamp", "schema_json")
    ends = flow_definitions(log, table).groupBy("output_table").agg(
        F.min_by("schema_json", position).alias("before_schema"),
        F.max_by("schema_json", position).alias("after_schema"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )

    def types(col: str) -> Column:
        elements = F.from_json(F.col(col), SCHEMA_ELEMENTS)
        return F.map_from_entries(F.transform(elements, lambda e: F.struct(e["name"], e["data_type"])))

    both = ends.withColumns({"before": types("before_schema"), "after": types("after_schema")})
    names = F.array_union(F.map_keys("after"), F.map_keys("before"))
    rows = both.select("output_table", "first_ts", "last_ts", "before", "after", F.explode(names).alias("column_name"))
    old, new = F.col("before")[F.col("column_name")], F.col("after")[F.col("column_name")]
    status = (
        F.when(~F.map_contains_key("before", F.col("column_name")), "NEW")
        .when(~F.map_contains_key("after", F.col("column_name")), "REMOVED")
        .when(~old.eqNullSafe(new), "CHANGED")
        .otherwise("MATCHED")
    )
    return rows.select(
        "output_table", "column_name", F.coalesce(new, old).alias("column_type"), status.alias("status"), "first_ts", "last_ts"
    )


def read_event_log(log: DataFrame, event_type: str, **paths: str) -> DataFrame:
    """Log rows of one event type with JSON paths of `details` pulled out as columns."""
    return log.where(F.col("event_type") == event_type).select(
        "timestamp", "event_type", *[json_path(F.col("details"), p).alias(n) for n, p in paths.items()]
    )
