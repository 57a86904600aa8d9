"""Silver and gold tables of the retail and trip data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from ..functions.times import epoch_ts, parse_ts
from ..operators.evolve import conform
from ..operators.quality import expect_or_drop
from ..operators.relational import enrich, sum_exploded
from ..operators.standardize import clean_column_names, coalesce_variants, standardize, title_columns

# Columns, name variants and formats of the source data.
SILVER_ORDER_COLUMNS = [
    "customer_id", "customer_name", "number_of_line_items", "order_datetime", "order_date", "order_number",
    "ordered_products", "state", "city", "lon", "lat", "units_purchased", "loyalty_segment", "source_file",
    "data_ingestion_ts", "file_modification_time",
]
VALID_ORDER_NUMBER = {"valid order_number": "order_number IS NOT NULL"}
TRIP_TIME_FORMAT = "M/d/yyyy HH:mm:ss"
TRIP_VARIANTS = {
    "trip_duration": ["tripduration", "trip_duration"],
    "start_time": ["starttime", "start_time"],
    "stop_time": ["stoptime", "stop_time"],
    "start_station_id": ["start_station_id"],
    "start_station_name": ["start_station_name"],
    "start_station_latitude": ["start_station_latitude"],
    "start_station_longitude": ["start_station_longitude"],
    "end_station_id": ["end_station_id"],
    "end_station_name": ["end_station_name"],
    "end_station_latitude": ["end_station_latitude"],
    "end_station_longitude": ["end_station_longitude"],
    "bike_id": ["bikeid", "bike_id"],
    "user_type": ["usertype", "user_type"],
    "birth_year": ["birth_year"],
}
TRIP_FIELDS = {
    "trip_duration": (LongType(), "how long the bike was out, as delivered"),
    "start_time": (TimestampType(), "when the bike was taken"),
    "stop_time": (TimestampType(), "when the bike was returned"),
    "start_station_id": (LongType(), "where it was taken: number"),
    "start_station_name": (StringType(), "where it was taken: name"),
    "start_station_latitude": (DoubleType(), "where it was taken: degrees north"),
    "start_station_longitude": (DoubleType(), "where it was taken: degrees east"),
    "end_station_id": (LongType(), "where it was returned: number"),
    "end_station_name": (StringType(), "where it was returned: name"),
    "end_station_latitude": (DoubleType(), "where it was returned: degrees north"),
    "end_station_longitude": (DoubleType(), "where it was returned: degrees east"),
    "bike_id": (LongType(), "number of the bike"),
    "user_type": (StringType(), "with or without a subscription"),
    "birth_year": (DoubleType(), "of the rider, if given"),
    "source_file": (StringType(), "file the row came from"),
    "file_modification_time": (TimestampType(), "when that file was last changed"),
}
TRIP_SCHEMA = StructType([StructField(n, kind, True, {"comment": text}) for n, (kind, text) in TRIP_FIELDS.items()])


def silver_orders(
    bronze: DataFrame,
    customers: DataFrame,
    on: Sequence[str] = ("customer_id", "customer_name"),
    columns: Sequence[str] = SILVER_ORDER_COLUMNS,
    standardized: bool = False,
) -> DataFrame:
    """Orders with customer columns, typed order time and date; rows without order number dropped.

    The drop comes before the join, so dropped rows are neither shuffled nor matched. A column of
    `columns` that neither side has raises. With `standardized`, equal rows collapse and text is trimmed and cleaned.
    """
    valid = expect_or_drop(bronze, VALID_ORDER_NUMBER)
    joined = enrich(valid, customers, on)
    typed = joined.withColumn("order_datetime", epoch_ts(F.col("order_datetime")))
    typed = typed.withColumn("order_date", F.to_date("order_datetime"))
    chosen = typed.select(*columns)
    return title_columns(standardize(chosen) if standardized else chosen, ["customer_name"])


def sales_by_city(silver: DataFrame, city: str) -> DataFrame:
    """Sales and quantity of one city by order date, customer and currency."""
    return sum_exploded(
        silver.where(F.col("city") == city),
        "ordered_products",
        ["order_date", "city", "customer_id", "customer_name"],
        {"currency": "curr"},
        {"sales": "price", "quantity": "qty"},
    )


def merge_trip_names(raw: DataFrame, missing: str = "raise") -> DataFrame:
    """One column per trip attribute, whatever the file called it; file columns are kept.

    Names are cleaned first, so `Trip Duration` is found; an attribute without any variant raises, or
    is NULL with `missing="null"`.
    """
    raw = clean_column_names(raw)
    spec = dict(TRIP_VARIANTS)
    for extra in ("source_file", "file_modification_time"):
        if extra in raw.columns:
            spec[extra] = [extra]
    return coalesce_variants(raw, spec, missing)


def silver_trips(bronze: DataFrame, schema: StructType = TRIP_SCHEMA, standardized: bool = False) -> DataFrame:
    """Trips with typed times, in the declared schema with its column comments; text as in `silver_orders`."""
    times = {c: parse_ts(F.col(c), TRIP_TIME_FORMAT) for c in ("start_time", "stop_time")}
    clean = standardize(bronze) if standardized else bronze
    typed = title_columns(clean.withColumns(times), ["user_type"])
    shaped = conform(typed, schema)
    return shaped.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])
