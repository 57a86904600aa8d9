"""What a JSON payload column contains: keys, errors and quality flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.rescue import corrupt_text, rescued_json, shape_pattern, variant_map
from .columns import computed_once, quoted

# Column names and error messages.
RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"
MALFORMED = "Malformed JSON in D column"
UNKNOWN_ERROR = "Unknown error"
MIN_PAYLOAD_LENGTH = 5
# Set by the typed parse where it met a value it could not read.
_UNREAD = "__unread"


def with_rescue(df: DataFrame, json_col: str, schema: StructType) -> DataFrame:
    """The typed fields of a JSON column plus `_rescued_data`."""
    return _typed(df, json_col, schema, rescue=True, corrupt=False)


def with_corrupt(df: DataFrame, json_col: str, schema: StructType) -> DataFrame:
    """The typed fields of a JSON column plus `_corrupt_record`."""
    return _typed(df, json_col, schema, rescue=False, corrupt=True)


def ingest_json_quality(df: DataFrame, json_col: str, schema: StructType) -> DataFrame:
    """Typed fields, `_rescued_data` and `_corrupt_record` in one pass."""
    return _typed(df, json_col, schema, rescue=True, corrupt=True)


def _typed(df: DataFrame, json_col: str, schema: StructType, rescue: bool, corrupt: bool) -> DataFrame:
    others = [c for c in df.columns if c != json_col]
    text, typed, json = F.col("__text"), F.col("__typed"), F.col("__json")
    # The text is parsed twice in all: by the schema, and as the VARIANT that all flags are read from.
    marked = StructType([*schema.fields, StructField(_UNREAD, StringType())])
    typing = F.from_json(quoted(json_col), marked, {"columnNameOfCorruptRecord": _UNREAD})
    parses = {"__text": quoted(json_col), "__typed": typing, "__json": F.try_parse_json(quoted(json_col))}
    parsed = computed_once(df, parses, others)
    names = {f"__t{i}": f for i, f in enumerate(schema.fieldNames())}
    pattern = shape_pattern(schema) if rescue else None
    fits = F.lit(False) if pattern is None else F.coalesce(F.schema_of_variant(json).rlike(pattern) & typed[_UNREAD].isNull(), F.lit(False))
    parsed = computed_once(parsed, {**{n: typed[f] for n, f in names.items()}, "__fits": fits}, [*others, "__text", "__json"])
    typed, fits = F.struct(*[F.col(n).alias(f) for n, f in names.items()]), F.col("__fits")
    flags = {}
    if rescue:
        # Rows that fit have nothing to lose; the others are taken apart.
        parsed = computed_once(parsed, {"__raw": F.when(~fits, variant_map(json))})
        flags[RESCUED] = F.when(~fits, rescued_json(text, json, F.col("__raw"), typed, schema))
    if corrupt:
        flags[CORRUPT] = corrupt_text(text, json)
    flagged = computed_once(parsed, flags, [*others, *names])
    return flagged.select(*[quoted(c) for c in others], *[F.col(n).alias(f) for n, f in names.items()], *flags)


def track_keys(df: DataFrame, col: str, source: str, at: Column) -> DataFrame:
    """Every top-level key with its first and last time seen; combines map-side before the shuffle."""
    keys = df.select(F.explode(F.json_object_keys(quoted(col))).alias("key_name"), at.alias("at"))
    return keys.groupBy("key_name").agg(
        F.min("at").alias("first_seen_timestamp"),
        F.max("at").alias("last_updated_timestamp"),
        F.lit(source).alias("source_table"),
    )


def merge_key_tracking(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Upsert of key tracking: first seen is the earliest, last updated the latest."""
    return stored.unionByName(found).groupBy("key_name", "source_table").agg(
        F.min("first_seen_timestamp").alias("first_seen_timestamp"),
        F.max("last_updated_timestamp").alias("last_updated_timestamp"),
    ).select("key_name", "first_seen_timestamp", "last_updated_timestamp", "source_table")


def error_records(df: DataFrame, col: str, min_len: int = MIN_PAYLOAD_LENGTH) -> DataFrame:
    """Rows whose payload is NULL or too short to be anything."""
    return df.where(quoted(col).isNull() | (F.length(quoted(col)) < min_len))


def classify_json_errors(df: DataFrame, col: str, required: Sequence[str], at: Column | None = None) -> DataFrame:
    """Rows whose payload is malformed or lacks a required key, with what is wrong with them."""
    checked = computed_once(df, {"__v": F.try_parse_json(quoted(col))}, [col])
    message = F.when(F.col("__v").isNull(), F.lit(MALFORMED))
    for key in required:
        value = F.try_variant_get(F.col("__v"), f"$.{key}", "string")
        message = message.when(value.isNull(), F.lit(f"Missing or invalid {key}"))
    columns = [quoted(col), quoted(col).alias(RESCUED), F.col("error_message")]
    if at is not None:
        columns.append(at.alias("processedTime"))
    return computed_once(checked, {"error_message": message}, [col]).where(F.col("error_message").isNotNull()).select(*columns)
