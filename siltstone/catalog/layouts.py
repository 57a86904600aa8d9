"""Flows with declared layouts, and flows over inferred and VARIANT payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import repair_json
from ..operators.evolve import infer_schema
from ..plans.curve import write_clustered
from ..plans.marts import merge_trip_names, silver_orders, silver_trips
from ..plans.patients import connection_history, inferred_latest
from ..sources.files import stream_parquet, stream_table, with_file_metadata, write_table
from ..streaming.run import run_batches
from .base import AT, PATIENT_FEED_SQL, Tables, at, files_for, register
from .changes import OPEN_END, TEXT_TIME, end_as_text
from .relations import BRONZE_SQL, DELIVERED, _bronze_orders, _customers


def _dirty(name: str):
    return F.concat(F.lit("  "), name, F.lit("\u0007 "))


@register(
    "flow_orders_layout",
    "REL-19 STD-6 SRC-16 SRC-14",
    f"""
    WITH {BRONZE_SQL} SELECT order_date, city, count(*) AS n, count(DISTINCT order_number) AS orders, min(customer_name) AS first_name
    FROM silver WHERE order_date < DATE '1998-01-01' GROUP BY order_date, city""",
    text=("order_date",),
)
def orders_layout(t: Tables) -> DataFrame:
    """Orders with untidy names, streamed into a standardized silver table in folders by order date."""
    bronze, silver = t.scratch("bronze"), t.scratch("silver")
    orders = _bronze_orders(t).withColumn("customer_name", _dirty("customer_name"))
    write_table(orders.repartition(max(3, files_for(t("lineitem").count()))), bronze)
    customers = _customers(t).withColumns({c: _dirty(c) for c in ("customer_name", "city")})

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = silver_orders(batch, customers, columns=DELIVERED, standardized=True)
        write_table(rows, f"{silver}/batch={batch_id}", partition_by=["order_date"])

    run_batches(stream_table(t.spark, bronze), store, t.scratch("checkpoint"))
    stored = t.spark.read.option("basePath", silver).parquet(silver).where("order_date < DATE '1998-01-01'")
    return stored.groupBy("order_date", "city").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_number").alias("orders"), F.min("customer_name").alias("first_name")
    )


@register(
    "flow_trips_layout",
    "REL-20 SRC-5 SRC-10 SRC-16 STD-1 STD-6 STD-8",
    f"""
    SELECT CAST(event_id % 60 AS BIGINT) AS trip_duration, date_trunc('second', ts) AS start_time, user_id AS start_station_id, event_id AS bike_id,
           concat(upper(event_type[1]), event_type[2:]) AS user_type, true AS from_file
    FROM events WHERE user_id BETWEEN 20 AND 40 OR event_type = 'error'""",
)
def trips_layout(t: Tables) -> DataFrame:
    """Trips of two generations of Parquet files, streamed into silver along a curve through station and user type."""
    landing, silver = t.scratch("landing"), t.scratch("silver")
    time = F.date_format("ts", "M/d/yyyy HH:mm:ss")
    common = [F.col("user_id").cast("string").alias("start_station_id"), time.alias("stoptime")]
    old = [F.expr("event_id % 60").alias("tripduration"), time.alias("starttime"), F.col("event_id").alias("bikeid"), _dirty("event_type").alias("usertype")]
    new = [F.expr("event_id % 60").alias("Trip Duration"), time.alias("Start Time"), F.col("event_id").alias("Bike ID"), _dirty("event_type").alias("User Type")]
    files = max(4, files_for(t("events").count()))
    for half, names in enumerate((old, new)):
        t("events").where(f"event_id % 2 = {half}").select(*common, *names).repartition(-(-files // 2)).write.mode("append").parquet(landing)
    raw = with_file_metadata(stream_parquet(t.spark, landing, t.scratch("schemas")))

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = silver_trips(merge_trip_names(batch, missing="null"), standardized=True)
        write_clustered(rows, silver, ["start_station_id", "user_type"], files, "append", folder=f"batch={batch_id}")

    run_batches(raw, store, t.scratch("checkpoint"))
    rows = t.spark.read.option("basePath", silver).parquet(f"{silver}/batch=*").where("start_station_id BETWEEN 20 AND 40 OR user_type = 'Error'")
    return rows.select(
        "trip_duration", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "start_station_id", "bike_id", "user_type",
        F.col("source_file").contains("landing").alias("from_file"),
    )


@register(
    "flow_patient_inferred",
    "CDC-3 JSN-9 JSN-10 SRC-4",
    f"""
    WITH {PATIENT_FEED_SQL}, rows AS (SELECT * FROM feed WHERE "ID" IS NOT NULL AND _change_type <> 'update_preimage')
    SELECT "ID", "BusinessID", concat('', o_orderkey) AS "D_id", json_extract_string(raw, '$.mood') AS "D_mood", o_orderkey % 2 = 0 AS "D_private",
           CASE WHEN o_orderkey % 29 <> 0 THEN 946684800 + o_orderkey * 60 END AS "D_created", 2 AS n_records, CAST(NULL AS VARCHAR) AS "D_rescued"
    FROM (SELECT *, row_number() OVER (PARTITION BY "ID", "BusinessID" ORDER BY _commit_version DESC) AS rn FROM rows) AS r
    WHERE rn = 1 AND _change_type <> 'delete'""",
    text=("D_created",),
)
def patient_inferred(t: Tables) -> DataFrame:
    """Type-1 patients whose payload schema nobody declared."""
    feed = t.patient_feed()
    schema = infer_schema(feed.select(repair_json(F.col("D")).alias("j")), "j")
    latest = inferred_latest(feed.drop("raw"), schema)
    return latest.select("ID", "BusinessID", "D_id", "D_mood", "D_private", "D_created", F.size("D_records").alias("n_records"), "D_rescued")


@register(
    "flow_connection_history",
    "CDC-4 JSN-3 JSN-6 JSN-7 JSN-15 DQ-4",
    f"""
    WITH used AS (
      SELECT concat('P', user_id % 40) AS "PatientID", concat('C', event_id % 5) AS connection_id, event_type AS follower_name, event_id, ts,
             event_id % 5 AS status, event_id % 11 = 0 AS gone
      FROM events WHERE event_id % 31 <> 0 AND (event_id % 11 = 0 OR event_id % 7 <> 0) AND event_id % 5 < 4),
    spans AS (SELECT *, lead(ts) OVER (PARTITION BY "PatientID", connection_id ORDER BY event_id) AS until FROM used)
    SELECT "PatientID", connection_id, follower_name, CAST(status AS INTEGER) AS status, event_id % 2 = 0 AS accepted, epoch_ms(event_id * 1000) AS created,
           ts AS "EffectiveFrom", strftime(coalesce(until, {OPEN_END}), '{TEXT_TIME}') AS "EffectiveTo", until IS NULL AS "IsCurrent"
    FROM spans WHERE NOT gone""",
)
def connections(t: Tables) -> DataFrame:
    """History of connections whose payload is read by path from one VARIANT; unknown states fail a rule."""
    payload = F.expr(
        """concat('{"id":"C', event_id % 5, '","follower":{"id":"F', user_id, '","name":"', event_type, '"},"status":', event_id % 5,
        ',"accepted":', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, ',"created":', event_id, '}')"""
    )
    kind = F.expr("CASE WHEN event_id % 11 = 0 THEN 'delete' WHEN event_id % 7 = 0 THEN 'update_preimage' ELSE 'update_postimage' END")
    feed = t("events").select(
        F.expr("concat('P', user_id % 40)").alias("PatientID"), F.when(F.expr("event_id % 31 = 0"), F.lit("{bad")).otherwise(payload).alias("D"),
        kind.alias("_change_type"), F.col("event_id").alias("_commit_version"), F.col("ts").alias("_commit_timestamp"),
    )
    history = connection_history(feed)
    return history.select(
        "PatientID", "connection_id", "follower_name", "status", "accepted", F.col("created").cast("timestamp_ntz").alias("created"),
        "EffectiveFrom", "EffectiveTo", "IsCurrent",
    ).transform(end_as_text)
