"""Streams whose schema changes, exact stream de-duplication, rescue by field, rules in time and the stream log."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from ..operators.lattice import EvolvingTable
from ..operators.quality import TIMED_RULES_SCHEMA, failure_counts, rule_pairs, timed_rules, with_failed_rules
from ..operators.standardize import dedupe_stream_exact
from ..sources.delimited import stream_delimited_fields
from ..streaming.keyed import with_rocksdb
from ..streaming.logged import batch_reports, run_logged
from ..streaming.run import run_batches
from .base import Tables, files_for, register

# Of three batches, the second has text where the first has numbers and adds an object; the third has keys that are data.
EVOLVING = [
    """concat('{"kind":"', event_type, '","n":', event_id, '}')""",
    """concat('{"kind":"', event_type, '","n":"no ', event_id, '","more":{"user":', user_id, '}}')""",
    """concat('{"kind":"', event_type, '","n":', event_id, '.5,"marks":{"m', event_id, '":', user_id, '}}')""",
]


@register(
    "json_lattice_stream",
    "JSN-9 SRC-4 SRC-14",
    """
    SELECT event_id, event_type AS kind, CASE event_id % 3 WHEN 0 THEN concat('', event_id) WHEN 1 THEN concat('no ', event_id) ELSE concat(event_id, '.5') END AS n,
           CASE event_id % 3 WHEN 1 THEN user_id END AS more_user, CASE event_id % 3 WHEN 2 THEN concat('m', event_id, '=', user_id) END AS marks
    FROM events""",
    text=("more_user",),
)
def lattice_stream(t: Tables) -> DataFrame:
    """Keys and types change while the stream runs, and nothing is lost."""
    landing = t.scratch("landing")
    files = files_for(t("events").count(), len(EVOLVING))
    for at, payload in enumerate(EVOLVING):
        rows = t("events").where(f"event_id % 3 = {at}").select("event_id", F.expr(payload).alias("j"))
        rows.repartition(files).write.mode("append").parquet(f"{landing}/{at}")
    stream = t.spark.readStream.schema("event_id BIGINT, j STRING").options(maxFilesPerTrigger=files, recursiveFileLookup="true").parquet(landing)
    table = EvolvingTable(t.scratch("evolving"), "j", ["event_id"], most_keys=200)
    run_batches(stream, table.upsert, t.scratch("checkpoint"))
    marks = F.array_join(F.transform(F.map_entries("marks"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return table.read(t.spark).select("event_id", "kind", "n", F.col("more.user").alias("more_user"), marks.alias("marks"))


@register("std_dedupe_exact_stream", "STD-7 SRC-14", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events", text=("day",))
def exact_dedupe(t: Tables) -> DataFrame:
    """Copies come in all of four micro-batches."""
    landing, sink = t.scratch("landing"), t.scratch("sink")
    files = files_for(t("events").count(), 4)
    t("events").select("user_id", "event_type", F.col("ts").cast("date").alias("day")).repartition(4 * files).write.parquet(landing)
    stream = t.spark.readStream.schema(t.spark.read.parquet(landing).schema).option("maxFilesPerTrigger", files).parquet(landing)
    checkpoint = t.scratch("checkpoint")
    with_rocksdb(dedupe_stream_exact(stream), lambda s: s.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint))
    return t.spark.read.parquet(sink)


@register(
    "source_rescue_delimited",
    "SRC-1 SRC-7",
    """
    SELECT o_orderkey AS id, concat(o_orderpriority, chr(9), '"', o_orderstatus) AS label, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 THEN o_custkey END AS customer,
           CASE WHEN o_orderkey % 7 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN '{"_c3":"more"}' END
                WHEN o_orderkey % 11 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN '{"customer":"n/a","_c3":"more"}' ELSE '{"customer":"n/a"}' END
                WHEN o_orderkey % 5 = 0 THEN '{"_c3":"more"}' END AS _rescued_data
    FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 5 = 0)""",
    text=("customer",),
)
def rescue_delimited(t: Tables) -> DataFrame:
    """Lines that are short, long or mistyped; labels hold the separator and a quote."""
    landing, sink = t.scratch("landing"), t.scratch("sink")
    label = F.expr("concat('\"', o_orderpriority, '\\t', '\"\"', o_orderstatus, '\"')")
    customer = F.when(F.expr("o_orderkey % 11 = 0"), F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    fields = F.concat_ws("\t", F.col("o_orderkey").cast("string"), label, F.when(F.expr("o_orderkey % 7 <> 0"), customer), F.when(F.expr("o_orderkey % 5 = 0"), F.lit("more")))
    lines = t("orders").where("NOT (o_orderkey % 7 = 0 AND o_orderkey % 5 = 0)").select(fields.alias("value"))
    files = files_for(t("orders").count(), 3)
    t.spark.range(4).select(F.lit("id\tlabel\tcustomer").alias("value")).unionByName(lines).repartition(3 * files).write.text(landing)
    run_batches(
        stream_delimited_fields(t.spark, landing, "id BIGINT, label STRING, customer BIGINT", maxFilesPerTrigger=str(files)),
        lambda batch, n: batch.write.mode("overwrite").parquet(f"{sink}/batch={n}"), t.scratch("checkpoint"),
    )
    return t.spark.read.parquet(sink).drop("batch")


# One rule changes midway and one is switched off.
SWITCH = datetime.datetime(2024, 1, 5)
TIMED_RULES = [
    ("known_kind", "event_type <> 'error'", None, None),
    ("small_value", "value < 50", None, SWITCH),
    ("small_value", "value < 90", SWITCH, None),
    ("odd_user", "user_id % 2 = 1", None, SWITCH),
]
FAILS = {
    "known_kind": "event_type = 'error'",
    "small_value": f"CASE WHEN ts < TIMESTAMP '{SWITCH}' THEN value >= 50 ELSE value >= 90 END",
    "odd_user": f"ts < TIMESTAMP '{SWITCH}' AND user_id % 2 <> 1",
}


@register(
    "dq_rules_in_time",
    "DQ-3 DQ-6 DQ-8",
    " UNION ALL ".join(
        f"SELECT '{a}' AS rule, '{b}' AS other, count(*) AS n FROM events WHERE {FAILS[a]} AND {FAILS[b]} HAVING count(*) > 0" for a in FAILS for b in FAILS if a <= b
    ),
)
def rules_in_time(t: Tables) -> DataFrame:
    """Failures per rule and pair of rules, added up from two halves of the events."""
    rules = timed_rules(t.spark.createDataFrame(TIMED_RULES, TIMED_RULES_SCHEMA))
    halves = [failure_counts(with_failed_rules(t("events").where(f"event_id % 2 = {h}"), rules, "ts")) for h in (0, 1)]
    return rule_pairs(halves[0].unionByName(halves[1]), rules)


@register(
    "obs_stream_log",
    "OBS-5 SRC-14 DQ-1",
    "SELECT 110 AS batches, count(*) AS input_rows, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events",
)
def stream_log(t: Tables) -> DataFrame:
    """Over 110 micro-batches, more than a query itself remembers, each is in the log once, with what was observed in it."""
    landing, log = t.scratch("landing"), t.scratch("log")
    t("events").select("event_id", "event_type").repartition(110).write.parquet(landing)
    stream = t.spark.readStream.schema("event_id BIGINT, event_type STRING").option("maxFilesPerTrigger", 1).parquet(landing)
    observed = stream.observe("seen", F.count_if(F.col("event_type") == "error").alias("errors"))
    run_logged(observed, t.scratch("sink"), t.scratch("checkpoint"), log)
    reports = batch_reports(t.spark, log, "seen", ("errors",)).where("input_rows > 0")
    return reports.agg(F.count_distinct("batch_id").cast("int").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("errors").alias("errors"))
