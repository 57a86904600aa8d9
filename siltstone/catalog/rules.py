"""Expectations, central rules and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import (
    PATIENT_EXPECTATIONS,
    PATIENT_REASONS,
    apply_rules,
    expect,
    expect_or_drop,
    expectation_metrics,
    load_rules,
    observe_expectations,
    quarantine,
    quarantine_records,
    query_text,
    rules_as_dict,
    rules_table,
    split_valid,
    validate,
)
from ..sources.files import stream_table
from ..streaming.aggregates import SumTarget
from ..streaming.run import store_expected
from .base import AT, PATIENTS_SQL, Tables, at, register

FLOW, TABLE = "patients_flow", "patients"

# The same checks in the other engine's words; a NULL result is a failure there too.
CHECKS = {
    "id_not_null": '"ID" IS NOT NULL',
    "business_id_not_null": '"BusinessID" IS NOT NULL',
    "phone_number_valid": """coalesce(regexp_full_match("PhoneNumber", '[0-9]{10,15}'), false)""",
    "country_is_us": """coalesce("Country" = 'US', false)""",
    "zip_valid": """coalesce(regexp_full_match("ZipCode", '[0-9]{5}'), false)""",
    "state_valid": """coalesce("State" IS NOT NULL AND length("State") > 1, false)""",
}
ALL_PASS = " AND ".join(CHECKS.values())


def first_failed(values: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN NOT {check} THEN '{values[name]}'" for name, check in CHECKS.items()) + " END"


NAMES = {name: name for name in CHECKS}


@register(
    "dq_expect",
    "DQ-1",
    f"WITH {PATIENTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, count(*) FILTER (WHERE {check}) AS passed, "
        f"count(*) FILTER (WHERE NOT {check}) AS failed FROM patients"
        for name, check in CHECKS.items()
    ),
)
def expectations(t: Tables) -> DataFrame:
    _, metrics = expect(t.patients(), PATIENT_EXPECTATIONS)
    return metrics


@register(
    "dq_expect_stream",
    "DQ-1 SRC-19",
    f"WITH {PATIENTS_SQL} SELECT count(*) AS total, "
    + ", ".join(f"count(*) FILTER (WHERE {check}) AS {name}" for name, check in CHECKS.items())
    + " FROM patients",
)
def expectations_on_a_stream(t: Tables) -> DataFrame:
    """All rows pass on, file by file; the counts are stored with each batch."""
    landing, sink = t.scratch("landing"), t.scratch("sink")
    t.patients().repartition(120).write.parquet(landing)
    schema = t.spark.read.parquet(landing).schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    counts = SumTarget(t.scratch("counts"), [], ["total", *PATIENT_EXPECTATIONS])
    store_expected(stream, PATIENT_EXPECTATIONS, sink, counts, t.scratch("checkpoint"))
    stored = t.spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("stored"))
    return counts.read(t.spark).join(stored, F.col("total") == F.col("stored")).drop("stored")


@register(
    "dq_expect_or_drop",
    "DQ-2",
    f"""WITH {PATIENTS_SQL} SELECT c_custkey, "ZipCode" FROM patients WHERE {CHECKS["id_not_null"]} AND {CHECKS["zip_valid"]}""",
)
def dropped(t: Tables) -> DataFrame:
    kept = expect_or_drop(t.patients(), {n: PATIENT_EXPECTATIONS[n] for n in ("id_not_null", "zip_valid")})
    return kept.select("c_custkey", "ZipCode")


@register(
    "dq_quarantine",
    "DQ-3",
    f"WITH {PATIENTS_SQL} SELECT c_custkey, {first_failed(PATIENT_REASONS)} AS quarantine_reason FROM patients WHERE NOT ({ALL_PASS})",
)
def quarantined(t: Tables) -> DataFrame:
    return quarantine(t.patients(), PATIENT_EXPECTATIONS, PATIENT_REASONS).select("c_custkey", "quarantine_reason")


@register(
    "dq_quarantine_null_passes",
    "DQ-3",
    f"""
    WITH {PATIENTS_SQL}, reasons AS (
      SELECT c_custkey, CASE WHEN "ID" IS NULL THEN 'ID is NULL' WHEN "BusinessID" IS NULL THEN 'BusinessID is NULL'
        WHEN NOT regexp_full_match("PhoneNumber", '[0-9]{{10,15}}') THEN 'Invalid PhoneNumber' WHEN "Country" <> 'US' THEN 'Invalid Country'
        WHEN NOT regexp_full_match("ZipCode", '[0-9]{{5}}') THEN 'Invalid ZipCode' WHEN "State" IS NULL OR length("State") <= 1 THEN 'Invalid State'
        END AS quarantine_reason FROM patients)
    SELECT * FROM reasons WHERE quarantine_reason IS NOT NULL""",
)
def quarantined_lenient(t: Tables) -> DataFrame:
    """The lenient reading, where a missing phone, zip or country is no failure."""
    rows = quarantine(t.patients(), PATIENT_EXPECTATIONS, PATIENT_REASONS, null_passes=True)
    return rows.select("c_custkey", "quarantine_reason")


@register(
    "dq_validate",
    "DQ-4",
    f"WITH {PATIENTS_SQL} SELECT c_custkey, {first_failed(NAMES)} AS failed_constraint FROM patients",
)
def validated(t: Tables) -> DataFrame:
    valid, failed = split_valid(validate(t.patients(), PATIENT_EXPECTATIONS))
    both = valid.withColumn("failed_constraint", F.lit(None).cast("string")).unionByName(failed)
    return both.select("c_custkey", "failed_constraint")


@register(
    "dq_quarantine_records",
    "DQ-5",
    f"""
    WITH {PATIENTS_SQL}, failed AS (SELECT *, {first_failed(NAMES)} AS constraint_name FROM patients)
    SELECT '{FLOW}' AS flow_name, '{TABLE}' AS table_name, constraint_name,
           CASE constraint_name {" ".join(
               f"WHEN '{n}' THEN '{e.replace(chr(39), chr(39) * 2)}'" for n, e in PATIENT_EXPECTATIONS.items())} END AS constraint_expression,
           TIMESTAMP '{AT}' AS violated_at, "ID" AS record_id, "ZipCode" AS record_zip
    FROM failed WHERE constraint_name IS NOT NULL""",
)
def typed_records(t: Tables) -> DataFrame:
    records = quarantine_records(t.patients(), PATIENT_EXPECTATIONS, FLOW, TABLE, ["ID", "ZipCode"], at())
    return records.select(
        "flow_name", "table_name", "constraint_name", "constraint_expression", "violated_at",
        F.col("record.ID").alias("record_id"), F.col("record.ZipCode").alias("record_zip"),
    )


def _rules(t: Tables) -> DataFrame:
    """The central table: rules of this flow, one of them switched off, and those of another flow."""
    enabled = {n: e for n, e in PATIENT_EXPECTATIONS.items() if n != "country_is_us"}
    off = {"country_is_us": PATIENT_EXPECTATIONS["country_is_us"]}
    other = {"never": "false"}
    table = rules_table(t.spark, FLOW, TABLE, enabled).unionByName(rules_table(t.spark, FLOW, TABLE, off, enabled=False))
    return table.unionByName(rules_table(t.spark, "other_flow", TABLE, other))


ENABLED = {n: c for n, c in CHECKS.items() if n != "country_is_us"}


@register(
    "dq_rules",
    "DQ-6",
    f"WITH {PATIENTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, count(*) FILTER (WHERE {check}) AS passed, "
        f"count(*) FILTER (WHERE NOT {check}) AS failed FROM patients"
        for name, check in ENABLED.items()
    ),
)
def enabled_rules(t: Tables) -> DataFrame:
    """The enabled rules, looked up centrally and counted over the table."""
    return expectation_metrics(t.patients(), rules_as_dict(load_rules(_rules(t), FLOW, TABLE)))


@register(
    "dq_combined_predicate",
    "DQ-7",
    f"""WITH {PATIENTS_SQL} SELECT 'SELECT * FROM patients WHERE '
    || '{" AND ".join(PATIENT_EXPECTATIONS[n] for n in sorted(ENABLED)).replace("'", "''")}' AS sql_text,
    count(*) FILTER (WHERE {" AND ".join(ENABLED.values())}) AS n_rows FROM patients""",
)
def predicate(t: Tables) -> DataFrame:
    """The query text made from the rules, and how many rows that query keeps."""
    text = query_text(load_rules(_rules(t), FLOW, TABLE), TABLE).first()["sql_text"]
    condition = text.split(" WHERE ", 1)[1]
    return t.patients().agg(F.lit(text).alias("sql_text"), F.count_if(F.expr(condition)).alias("n_rows"))


@register(
    "dq_apply_rules",
    "DQ-8",
    f"""WITH {PATIENTS_SQL} SELECT c_custkey, "ID", "State" FROM patients WHERE {" AND ".join(ENABLED.values())}""",
)
def cleaned(t: Tables) -> DataFrame:
    return apply_rules(t.patients(), load_rules(_rules(t), FLOW, TABLE)).select("c_custkey", "ID", "State")
