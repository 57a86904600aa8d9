"""The patient tables: payload repair, typing, rules, quarantine and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions.jsoncols import extra_keys, parse_map, parse_struct, parse_variant, project_keys, structure_records, variant_path
from ..functions.text import repair_json, strip_control
from ..functions.times import epoch_ts, safe_cast
from ..operators.changes import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, RESERVED
from ..operators.columns import computed_once
from ..operators.flatten import expand_struct
from ..operators.payload import RESCUED, with_rescue
from ..operators.quality import FAILED, PATIENT_RULES, quarantine_records, split_valid, validate
from ..operators.scd import apply_scd1, apply_scd2

# Bronze columns, payload keys and their types.
BRONZE_COLUMNS = [
    "ID", "Shard", "Private", "Name", "Address1", "Address2", "City", "State", "ZipCode", "Country", "PhoneNumber",
    "BusinessID", "Created", "CreatedBy", "Updated", "UpdatedBy", "V", "D", "P",
]
PAYLOAD_COLUMNS = {
    "D_id": ("id", "string"),
    "D_name": ("name", "string"),
    "D_address1": ("address1", "string"),
    "D_address2": ("address2", "string"),
    "D_city": ("city", "string"),
    "D_state": ("state", "string"),
    "D_zipCode": ("zipCode", "string"),
    "D_country": ("country", "string"),
    "D_phoneNumber": ("phoneNumber", "string"),
    "D_businessId": ("businessId", "string"),
    "D_private": ("private", "boolean"),
    "D_created": ("created", "epoch"),
    "D_createdBy": ("createdBy", "string"),
    "D_updated": ("updated", "epoch"),
    "D_updatedBy": ("updatedBy", "string"),
}
OTHER_KNOWN_KEYS = ["records", "P", "V"]
QUARANTINE_COLUMNS = [
    "ID", "Shard", "BusinessID", "D_state", "D_zipCode", "D_created", "Created", "Updated", "processedTime",
]
FLOW_NAME = "silver_events_patient_data_cdc_scd2"
TABLE_NAME = "silver_events_patient_data_scd2"
PAYLOAD_DIGEST = "__payload"
KEYS = ["ID", "BusinessID"]
SEQUENCE = [COMMIT_VERSION, COMMIT_TIMESTAMP]
DELETED = f"{CHANGE_TYPE} = 'delete'"
PRACTICE_PAYLOAD = (
    "address1 STRING, address2 STRING, anonymous BOOLEAN, businessId STRING, city STRING, country STRING, "
    "created BIGINT, createdBy STRING, name STRING, patientId STRING, phoneNumber STRING, practiceId STRING, "
    "referrerId STRING, shard INT, state STRING, updated BIGINT, updatedBy STRING, zipCode STRING"
)
PRACTICE_RENAMES = {
    "created": "json_created",
    "createdBy": "json_createdBy",
    "patientId": "patientId_from_json",
    "practiceId": "practiceId_from_json",
    "shard": "json_shard",
    "updated": "json_updated",
    "updatedBy": "json_updatedBy",
}


def typed_patients(feed: DataFrame, at: Column) -> DataFrame:
    """The change feed with the payload repaired, parsed once and projected to typed columns."""
    parsed = computed_once(feed, {"__map": parse_map(repair_json(F.col("D")))})
    payload = F.col("__map")
    known = [key for key, _ in PAYLOAD_COLUMNS.values()] + OTHER_KNOWN_KEYS
    have = [c for c in BRONZE_COLUMNS if c in feed.columns and c not in ("D", "P", "V")]
    return parsed.select(
        *have,
        *project_keys(payload, PAYLOAD_COLUMNS),
        extra_keys(payload, known).alias("D_extra"),
        structure_records(payload["records"]).alias("D_records"),
        *[c for c in ("P", "V") if c in feed.columns],
        at.alias("processedTime"),
        *[c for c in RESERVED if c in feed.columns],
        F.xxhash64("D").alias(PAYLOAD_DIGEST),
    )


def valid_patients(typed: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """The changes that patients are kept from: rows that pass all rules, and deletes, of which only key and sequence are read."""
    checked = validate(typed, rules or PATIENT_RULES)
    gone = F.coalesce(F.expr(DELETED), F.lit(False)) & F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
    return checked.where(F.col(FAILED).isNull() | gone).drop(FAILED)


def tie_break(columns: list[str]) -> list[str]:
    """The columns as received; the typed ones follow from them."""
    return [c for c in [*BRONZE_COLUMNS, *RESERVED, PAYLOAD_DIGEST] if c in columns]


def patient_history(feed: DataFrame, at: Column, rules: dict[str, str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Type-2 history of the valid patients."""
    valid = valid_patients(typed_patients(feed, at), rules)
    return apply_scd2(
        valid, KEYS, SEQUENCE, DELETED, [*RESERVED, PAYLOAD_DIGEST], hot_rows=hot_rows, tie_break=tie_break(valid.columns), count_on=feed
    )


def patient_latest(feed: DataFrame, at: Column, rules: dict[str, str] | None = None) -> DataFrame:
    """Type-1 table of the valid patients."""
    valid = valid_patients(typed_patients(feed, at), rules)
    return apply_scd1(valid, KEYS, SEQUENCE, DELETED, [*RESERVED, PAYLOAD_DIGEST], tie_break=tie_break(valid.columns))


def patient_quarantine(feed: DataFrame, at: Column, rules: dict[str, str] | None = None) -> DataFrame:
    """One record per patient change that fails a rule."""
    return quarantine_records(typed_patients(feed, at), rules or PATIENT_RULES, FLOW_NAME, TABLE_NAME, QUARANTINE_COLUMNS, at)


def inferred_latest(feed: DataFrame, schema: StructType) -> DataFrame:
    """Type-1 table of patients whose payload is parsed by an inferred schema; its fields get the prefix `D_`.

    Fields that the schema lacks stay in `D_rescued`, as JSON text.
    """
    # The row's own columns are set aside, as payload keys may be called like them.
    packed = feed.select(F.struct(*[c for c in feed.columns if c != "D"]).alias("__row"), repair_json(F.col("D")).alias("__j"))
    parsed = with_rescue(packed, "__j", schema)
    fields = [F.col(f"`{f}`").alias(f"D_{f}") for f in schema.fieldNames()]
    named = parsed.select("__row.*", *fields, F.col(RESCUED).alias("D_rescued"))
    return apply_scd1(named, KEYS, SEQUENCE, DELETED, RESERVED)


# Payload paths of a connection and their types.
CONNECTION_PATHS = {
    "connection_id": ("id", "string"),
    "follower_id": ("follower.id", "string"),
    "follower_name": ("follower.name", "string"),
    "status": ("status", "int"),
    "accepted": ("accepted", "boolean"),
    "created": ("created", "bigint"),
}
CONNECTION_RULES = {"has_connection": "connection_id IS NOT NULL", "known_status": "status BETWEEN 0 AND 3"}


def connection_history(feed: DataFrame, rules: dict[str, str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Type-2 history of valid connections between patients; paths are read from one VARIANT per payload."""
    parsed = computed_once(feed, {"__v": parse_variant(strip_control(F.col("D")))}, [c for c in feed.columns if c != "D"])
    paths = [variant_path(F.col("__v"), path, kind).alias(name) for name, (path, kind) in CONNECTION_PATHS.items()]
    typed = parsed.select(*[c for c in feed.columns if c != "D"], *paths).withColumn("created", epoch_ts(F.col("created")))
    valid, _ = split_valid(validate(typed, rules or CONNECTION_RULES))
    return apply_scd2(valid, ["PatientID", "connection_id"], SEQUENCE, DELETED, RESERVED, hot_rows=hot_rows, count_on=None)


def practice_history(feed: DataFrame, at: Column, hot_rows: int | None = None) -> DataFrame:
    """Type-2 history of patient-practice links, with the payload parsed to a declared struct."""
    timed = feed.withColumns({c: safe_cast(F.col(c), "timestamp") for c in ("Created", "Updated")})
    parsed = computed_once(timed, {"json_data": parse_struct(strip_control(F.col("D")), PRACTICE_PAYLOAD)})
    usable = parsed.where(F.col("json_data.patientId").isNotNull())
    flat = expand_struct(usable, "json_data", renames=PRACTICE_RENAMES)
    return apply_scd2(
        flat, ["patientId_from_json", "practiceId_from_json"], SEQUENCE, DELETED, except_cols=RESERVED, at=at, hot_rows=hot_rows
    )
