"""Schema audit and history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.schema_log import describe, read_event_log, schema_audit, schema_diff, schema_history
from .base import AT, Tables, at, register

AUDITED = ["customer", "orders", "lineitem", "events", "part", "supplier", "nation", "region", "documents", "conversations", "embeddings", "pages", "benchmark", "labels"]
TYPES_SQL = """CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END"""
COLUMNS_SQL = f"""
    SELECT table_name, column_name, {TYPES_SQL} AS data_type FROM information_schema.columns
    WHERE table_name IN ({", ".join(f"'{name}'" for name in AUDITED)})"""


@register("obs_schema_audit", "OBS-1", f"SELECT *, TIMESTAMP '{AT}' AS audit_ts FROM ({COLUMNS_SQL}) AS c")
def audit(t: Tables) -> DataFrame:
    audits = [schema_audit(t(name), at()).withColumn("table_name", F.lit(name)) for name in AUDITED]
    return reduce(DataFrame.unionByName, audits)


@register("obs_describe", "OBS-4", f"SELECT table_name, column_name AS col_name, data_type, CAST(NULL AS VARCHAR) AS comment FROM ({COLUMNS_SQL}) AS c")
def described(t: Tables) -> DataFrame:
    lists = [describe(t(name)).withColumn("table_name", F.lit(name)) for name in AUDITED]
    return reduce(DataFrame.unionByName, lists)


# A log with one entry per event: the user is the dataset, and its columns follow the event.
ELEMENT = """concat('{{"name":"{0}","path":["{0}"],"data_type":"{1}"}}')"""
SCHEMA_TEXT = f"""concat('[', {ELEMENT.format("id", "bigint")},
    CASE WHEN event_id % 3 <> 0 THEN concat(',', {ELEMENT.format("name", "string")}) ELSE '' END,
    ',{{"name":"value","path":["value"],"data_type":"', CASE WHEN event_id % 2 = 0 THEN 'int' ELSE 'double' END, '"}}', ']')"""
DETAILS = f"""concat('{{"flow_definition":{{"output_dataset":"user_', user_id, '","schema":', {SCHEMA_TEXT}, '}}}}')"""
LOG_SQL = f"""
    log AS (SELECT concat('user_', user_id) AS output_table, ts, event_id, {SCHEMA_TEXT} AS schema_json FROM events
            WHERE event_type <> 'error')"""


def event_log(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "update_progress").otherwise("flow_definition")
    return t("events").select(F.col("ts").alias("timestamp"), kind.alias("event_type"), F.expr(DETAILS).alias("details"))


@register(
    "obs_schema_history",
    "OBS-2 REL-4 REL-11",
    f"""
    WITH {LOG_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY output_table ORDER BY ts) AS rn FROM log)
    SELECT a.output_table, a.schema_json AS before_schema, b.schema_json AS after_schema, a.ts AS before_ts, b.ts AS after_ts
    FROM numbered AS a JOIN numbered AS b ON a.output_table = b.output_table AND b.rn = a.rn + 1""",
)
def history(t: Tables) -> DataFrame:
    return schema_history(event_log(t))


@register(
    "obs_schema_diff",
    "OBS-3 REL-5 REL-6 REL-12",
    f"""
    WITH {LOG_SQL}, ends AS (
      SELECT output_table, min(ts) AS first_ts, max(ts) AS last_ts, arg_min(event_id, ts) AS f, arg_max(event_id, ts) AS l FROM log GROUP BY output_table),
    cols AS (
      SELECT *, 'id' AS column_name, 'bigint' AS old_type, 'bigint' AS new_type FROM ends
      UNION ALL SELECT *, 'name', CASE WHEN f % 3 <> 0 THEN 'string' END, CASE WHEN l % 3 <> 0 THEN 'string' END FROM ends
      UNION ALL SELECT *, 'value', CASE WHEN f % 2 = 0 THEN 'int' ELSE 'double' END, CASE WHEN l % 2 = 0 THEN 'int' ELSE 'double' END FROM ends)
    SELECT output_table, column_name, coalesce(new_type, old_type) AS column_type, first_ts, last_ts,
           CASE WHEN old_type IS NULL THEN 'NEW' WHEN new_type IS NULL THEN 'REMOVED' WHEN old_type <> new_type THEN 'CHANGED' ELSE 'MATCHED' END AS status
    FROM cols WHERE old_type IS NOT NULL OR new_type IS NOT NULL""",
)
def diff(t: Tables) -> DataFrame:
    return schema_diff(event_log(t))


@register(
    "obs_event_log",
    "OBS-5 JSN-8",
    f"""
    SELECT ts AS timestamp, 'flow_definition' AS event_type, output_table AS dataset, 'bigint' AS first_type FROM (WITH {LOG_SQL} SELECT * FROM log) AS l""",
)
def log_query(t: Tables) -> DataFrame:
    return read_event_log(
        event_log(t), "flow_definition", dataset="flow_definition.output_dataset", first_type="flow_definition.schema[0].data_type"
    )
