"""Expectations, central rules and quarantine.

A rule is a name and a SQL predicate. A row passes only if the predicate is TRUE; NULL counts as a
failure, unless `null_passes` asks for the lenient reading.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .columns import as_column, quoted
from .payload import CORRUPT, RESCUED

RULES_SCHEMA = (
    "flow_name STRING, table_name STRING, constraint_name STRING, constraint_expression STRING, "
    "added_at TIMESTAMP, enabled BOOLEAN"
)
FAILED = "failed_constraint"

# The rules the patient flows are checked with.
PATIENT_RULES = {
    "id_not_null": "ID IS NOT NULL",
    "businessid_not_null": "BusinessID IS NOT NULL",
    "dcreated_not_null": "D_created IS NOT NULL",
    "state_two_chars": "D_state RLIKE '^[A-Z]{2}$'",
    "zipcode_us_pattern": "D_zipCode RLIKE '^[0-9]{5}(-[0-9]{4})?$'",
}
PATIENT_EXPECTATIONS = {
    "id_not_null": "ID IS NOT NULL",
    "business_id_not_null": "BusinessID IS NOT NULL",
    "phone_number_valid": "PhoneNumber RLIKE '^[0-9]{10,15}$'",
    "country_is_us": "Country = 'US'",
    "zip_valid": "ZipCode RLIKE '^[0-9]{5}$'",
    "state_valid": "State IS NOT NULL AND length(State) > 1",
}
PATIENT_REASONS = {
    "id_not_null": "ID is NULL",
    "business_id_not_null": "BusinessID is NULL",
    "phone_number_valid": "Invalid PhoneNumber",
    "country_is_us": "Invalid Country",
    "zip_valid": "Invalid ZipCode",
    "state_valid": "Invalid State",
}


def passes(expression: str, null_passes: bool = False) -> Column:
    return F.coalesce(F.expr(expression), F.lit(null_passes))


def first_failure(rules: Mapping[str, str], null_passes: bool = False) -> Column:
    """The name of the first rule a row fails, in the order of `rules`; NULL if it passes all."""
    failure = F.lit(None).cast("string")
    for name, expression in reversed(rules.items()):
        failure = F.when(~passes(expression, null_passes), F.lit(name)).otherwise(failure)
    return failure


def expect(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """All rows unchanged, and a frame (constraint_name, passed, failed) counted in one pass."""
    return df, expectation_metrics(df, rules)


def expectation_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    counts = df.agg(
        *[F.count_if(passes(e)).alias(f"p{i}") for i, e in enumerate(rules.values())],
        F.count(F.lit(1)).alias("n"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("constraint_name"),
                F.col(f"p{i}").alias("passed"),
                (F.col("n") - F.col(f"p{i}")).alias("failed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def observe_expectations(df: DataFrame, rules: Mapping[str, str], name: str | Observation = "expectations") -> DataFrame:
    """The rows unchanged; pass counts per rule and `total` appear in the metrics of the job or stream that runs them."""
    counts = [F.count_if(passes(e)).alias(n) for n, e in rules.items()]
    return df.observe(name, F.count(F.lit(1)).alias("total"), *counts)


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    for expression in rules.values():
        df = df.where(passes(expression))
    return df


def quarantine(df: DataFrame, rules: Mapping[str, str], reasons: Mapping[str, str] | None = None, null_passes: bool = False) -> DataFrame:
    """Rows failing any rule, with the reason of the first failure."""
    failure = first_failure(rules, null_passes)
    bad = df.withColumn("__failed", failure).where(F.col("__failed").isNotNull())
    reason = F.col("__failed")
    if reasons:
        reason = F.create_map(*[F.lit(x) for pair in reasons.items() for x in pair])[reason]
    return bad.withColumn("quarantine_reason", reason).drop("__failed")


def validate(df: DataFrame, rules: Mapping[str, str], null_passes: bool = False) -> DataFrame:
    """All rows with `failed_constraint`; NULL marks the valid ones."""
    return df.withColumn(FAILED, first_failure(rules, null_passes))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows without the marker, and the failed rows with it. Together they are the input."""
    return validated.where(F.col(FAILED).isNull()).drop(FAILED), validated.where(F.col(FAILED).isNotNull())


def quarantine_records(
    df: DataFrame, rules: Mapping[str, str], flow: str, table: str, cols: Sequence[str], at: Column, null_passes: bool = False
) -> DataFrame:
    """One typed quarantine record per failing row."""
    checked = validate(df, rules, null_passes).where(F.col(FAILED).isNotNull())
    expressions = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    return checked.select(
        F.lit(flow).alias("flow_name"),
        F.lit(table).alias("table_name"),
        F.col(FAILED).alias("constraint_name"),
        expressions[F.col(FAILED)].alias("constraint_expression"),
        at.alias("violated_at"),
        F.struct(*[quoted(c) for c in cols]).alias("record"),
    )


def rules_table(spark: SparkSession, flow: str, table: str, rules: Mapping[str, str], enabled: bool = True) -> DataFrame:
    """Rule rows in the shape of the central constraints table."""
    rows = [(flow, table, name, expression, None, enabled) for name, expression in rules.items()]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def load_rules(rules: DataFrame, flow: str, table: str) -> DataFrame:
    """The enabled rules of one flow and table."""
    return rules.where((F.col("flow_name") == flow) & (F.col("table_name") == table) & F.col("enabled"))


def rules_as_dict(rules: DataFrame) -> dict[str, str]:
    """Rule rows to the mapping the operators take; a rules table is configuration, one row per rule."""
    return {r.constraint_name: r.constraint_expression for r in rules.select("constraint_name", "constraint_expression").collect()}


def combined_predicate(rules: DataFrame) -> DataFrame:
    """One row with all rule expressions joined by AND, in rule-name order."""
    ordered = F.array_sort(F.collect_list(F.struct("constraint_name", "constraint_expression")))
    return rules.agg(F.concat_ws(" AND ", F.transform(ordered, lambda r: r["constraint_expression"])).alias("where_clause"))


def query_text(rules: DataFrame, table: str) -> DataFrame:
    """The text of a query that keeps the rows of `table` all rules accept."""
    return combined_predicate(rules).select(
        F.concat(F.lit(f"SELECT * FROM {table} WHERE "), F.col("where_clause")).alias("sql_text")
    )


def apply_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows every rule accepts."""
    return expect_or_drop(df, rules_as_dict(rules))


def quality_summary(df: DataFrame) -> DataFrame:
    """Counts of all, rescued and corrupt rows, and the share of flagged rows in percent."""
    rescued, corrupt = F.count_if(F.col(RESCUED).isNotNull()), F.count_if(F.col(CORRUPT).isNotNull())
    total = F.count(F.lit(1))
    share = F.round((rescued + corrupt) / F.nullif(total, F.lit(0)) * 100, 1)
    return df.agg(
        total.alias("total"), rescued.alias("rescued"), corrupt.alias("corrupt"), share.alias("coverage_pct")
    )


def quality_issues(df: DataFrame, columns: Sequence[Column | str], file_col: str = "file_name") -> DataFrame:
    """The flagged rows ordered by source file.

    The texts follow in the order, so the sort can split a file that holds most of the rows.
    """
    flagged = df.where(F.col(RESCUED).isNotNull() | F.col(CORRUPT).isNotNull())
    return flagged.select(*columns, RESCUED, CORRUPT, file_col).orderBy(file_col, RESCUED, CORRUPT)


# Rules that hold for a time; a NULL bound is open, and a rule holds from `valid_from` until before `valid_to`.
TIMED_RULES_SCHEMA = "constraint_name STRING, constraint_expression STRING, valid_from TIMESTAMP, valid_to TIMESTAMP"
FAILED_RULES = "failed_rules"
# Rules that one bitmap has room for.
MOST_RULES = 63


def timed_rules(rules: DataFrame) -> list[tuple[str, str, datetime | None, datetime | None]]:
    """Rule versions in order of name and begin; a rules table is configuration, one row per version."""
    rows = rules.select("constraint_name", "constraint_expression", "valid_from", "valid_to").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[2] is not None, r[2]))


def rule_bits(rules: Sequence[tuple]) -> dict[str, int]:
    """The bit of every rule, in order of name; versions of a rule share it."""
    names = sorted({r[0] for r in rules})
    if len(names) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return {name: at for at, name in enumerate(names)}


def with_failed_rules(df: DataFrame, rules: Sequence[tuple], event_time: Column | str, null_passes: bool = False) -> DataFrame:
    """Add `failed_rules`, a bitmap of all rules that fail by the version valid at the row's own time.

    Versions are part of the plan, so a row is tested by those of its time in the same pass and nothing is joined. A row
    without a time is tested by the versions without a begin or end only.
    """
    when = as_column(event_time).cast("timestamp")
    bits = rule_bits(rules)
    failed = F.lit(0).cast("bigint")
    for name, expression, start, end in rules:
        valid = F.lit(True) if start is None else F.coalesce(when >= F.lit(start), F.lit(False))
        valid = valid if end is None else valid & F.coalesce(when < F.lit(end), F.lit(False))
        bit = F.lit(1 << bits[name]).cast("bigint")
        failed = failed.bitwiseOR(F.when(valid & ~passes(expression, null_passes), bit).otherwise(F.lit(0).cast("bigint")))
    return df.withColumn(FAILED_RULES, failed)


def failure_counts(marked: DataFrame) -> DataFrame:
    """(failed_rules, n): how many rows fail just these rules. Counts of batches merge by adding them up."""
    return marked.groupBy(FAILED_RULES).agg(F.count(F.lit(1)).alias("n"))


def rule_pairs(counts: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """(rule, other, n): rows that fail both, read off the counts; a rule with itself gives its own failures."""
    names = F.array(*[F.lit(name) for name in rule_bits(rules)])
    hit = F.filter(F.transform(names, lambda name, at: F.when(F.getbit(FAILED_RULES, at) == 1, name)), lambda name: name.isNotNull())
    rows = counts.withColumn("rules", hit).select("n", "rules", F.explode("rules").alias("rule"))
    pairs = rows.select("rule", F.explode("rules").alias("other"), "n").where(F.col("rule") <= F.col("other"))
    return pairs.groupBy("rule", "other").agg(F.sum("n").alias("n"))
