"""JSON payload columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.jsoncols import (
    extra_keys,
    json_path,
    parse_map,
    parse_struct,
    parse_variant,
    project_keys,
    structure_records,
    variant_path,
)
from ..functions.text import repair_json, strip_control, unquote_json
from ..functions.times import epoch_ts
from ..operators.columns import computed_once
from ..operators.evolve import parse_evolving, SchemaRegistry
from ..operators.flatten import expand_struct, fully_flatten
from ..operators.payload import classify_json_errors, error_records, merge_key_tracking, track_keys
from ..operators.relational import explode_rows
from .base import AT, PATIENT_FEED_SQL, Tables, at, register

# Events as JSON objects with one nested object.
EVENT_JSON = """concat('{"id":', event_id, ',"kind":"', event_type, '","cents":', CAST(round(value * 100) AS BIGINT),
    ',"props":', replace(props, ' ', ''), ',"flag":', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, '}')"""
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def event_json(t: Tables) -> DataFrame:
    return t("events").select("event_id", "ts", F.expr(EVENT_JSON).alias("j"))


@register("json_repair", "JSN-1", "WITH " + PATIENT_FEED_SQL + " SELECT o_orderkey, raw AS repaired FROM feed")
def repair(t: Tables) -> DataFrame:
    return t.patient_feed().select("o_orderkey", repair_json(F.col("D")).alias("repaired"))


@register("json_unquote", "JSN-2", "WITH " + PATIENT_FEED_SQL + " SELECT o_orderkey, raw AS unquoted FROM feed")
def unquote(t: Tables) -> DataFrame:
    return t.patient_feed().select("o_orderkey", unquote_json(F.col("D")).alias("unquoted"))


@register(
    "json_strip_control",
    "JSN-3",
    r"""
    SELECT doc_id, md5(stripped) AS text_md5, length(stripped) AS n FROM (
      SELECT doc_id, replace(regexp_replace(concat(text, '\u0000'), '[\x00-\x1F\x7F]', '', 'g'), '\u0000', '') AS stripped FROM documents) AS d""",
)
def strip(t: Tables) -> DataFrame:
    stripped = strip_control(F.concat("text", F.lit("\\u0000")))
    return t("documents").select("doc_id", F.md5(stripped).alias("text_md5"), F.length(stripped).alias("n"))


@register(
    "json_parse_struct",
    "JSN-4",
    f"SELECT event_id, event_id AS id, event_type AS kind, CAST(round(value * 100) AS BIGINT) AS cents, {K} AS k FROM events",
)
def struct(t: Tables) -> DataFrame:
    parsed = event_json(t).select(
        "event_id", parse_struct(F.col("j"), "id BIGINT, kind STRING, cents BIGINT, props STRUCT<k: INT>").alias("p")
    )
    return parsed.select("event_id", "p.id", "p.kind", "p.cents", F.col("p.props.k").alias("k"))


@register(
    "json_parse_map",
    "JSN-5",
    "SELECT event_id, CAST(5 AS INTEGER) AS n_keys, event_type AS kind, replace(props, ' ', '') AS props FROM events",
)
def as_map(t: Tables) -> DataFrame:
    parsed = event_json(t).select("event_id", parse_map(F.col("j")).alias("m"))
    return parsed.select("event_id", F.size("m").alias("n_keys"), F.col("m")["kind"].alias("kind"), F.col("m")["props"].alias("props"))


@register(
    "json_parse_variant",
    "JSN-6",
    f"SELECT event_id, event_id % 7 <> 0 AS is_json, CASE WHEN event_id % 7 <> 0 THEN {K} END AS k FROM events",
    text=("k",),
)
def as_variant(t: Tables) -> DataFrame:
    text = F.when(F.expr("event_id % 7 = 0"), F.lit("{broken")).otherwise(F.col("j"))
    parsed = event_json(t).select("event_id", parse_variant(text).alias("v"))
    return parsed.select("event_id", F.col("v").isNotNull().alias("is_json"), variant_path(F.col("v"), "props.k", "int").alias("k"))


@register(
    "json_variant_path",
    "JSN-7",
    f"""
    SELECT event_id, event_type AS kind, {K} AS k, event_id % 2 = 0 AS flag, CAST(round(value * 100) AS BIGINT) AS cents,
           CAST(NULL AS INTEGER) AS kind_as_int, CAST(NULL AS VARCHAR) AS missing FROM events""",
    text=("kind_as_int",),
)
def paths(t: Tables) -> DataFrame:
    v = F.col("v")
    return event_json(t).select("event_id", parse_variant(F.col("j")).alias("v")).select(
        "event_id",
        variant_path(v, "kind", "string").alias("kind"),
        variant_path(v, "props.k", "int").alias("k"),
        variant_path(v, "flag", "boolean").alias("flag"),
        variant_path(v, "cents", "bigint").alias("cents"),
        variant_path(v, "kind", "int").alias("kind_as_int"),
        variant_path(v, "nowhere.at.all", "string").alias("missing"),
    )


@register("json_path", "JSN-8", "SELECT event_id, event_type AS kind, json_extract_string(props, '$.k') AS k FROM events")
def text_path(t: Tables) -> DataFrame:
    return event_json(t).select(
        "event_id", json_path(F.col("j"), "kind").alias("kind"), json_path(F.col("j"), "props.k").alias("k")
    )


@register(
    "json_infer_schema",
    "JSN-9",
    f"""
    SELECT event_id, event_type AS kind, {K} AS k, CASE WHEN event_id % 2 = 0 THEN concat('n', event_id) END AS note,
           value + event_id % 2 * 0.5 AS amount FROM events""",
)
def inferred(t: Tables) -> DataFrame:
    """A first batch fixes the schema; the second one adds a key and widens a number."""
    registry = SchemaRegistry(t.spark, t.scratch("schemas"))
    events = t("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    whole = events.where("event_id % 2 = 1").select("event_id", F.to_json(F.struct(
        F.col("event_type").alias("kind"), F.struct("k").alias("props"), (F.col("value") + 0.5).alias("amount"))).alias("j"))
    later = events.where("event_id % 2 = 0").select("event_id", F.to_json(F.struct(
        F.col("event_type").alias("kind"), F.struct("k").alias("props"), F.col("value").alias("amount"),
        F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note"))).alias("j"))
    parse_evolving(whole, "j", "p", registry, "events")
    rows = parse_evolving(later, "j", "p", registry, "events")
    both = rows.unionByName(whole.withColumn("p", F.from_json("j", rows.schema["p"].dataType)))
    return both.select("event_id", "p.kind", F.col("p.props.k").cast("int").alias("k"), "p.note", "p.amount")


@register(
    "json_expand_struct",
    "JSN-10",
    """
    SELECT o_orderkey, o_custkey AS "D_customer", o_orderstatus AS "D_status", o_totalprice AS json_total FROM orders""",
)
def expanded(t: Tables) -> DataFrame:
    packed = F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
    rows = t("orders").select("o_orderkey", F.from_json(F.to_json(packed), "customer BIGINT, status STRING, total DOUBLE").alias("d"))
    return expand_struct(rows, "d", prefix="D_", renames={"total": "json_total"})


@register(
    "json_project_keys",
    "JSN-11",
    "WITH " + PATIENT_FEED_SQL + """
    SELECT o_orderkey, concat('', o_orderkey) AS "D_id", CASE o_orderkey % 13 WHEN 0 THEN 'Texas' WHEN 1 THEN NULL ELSE 'TX' END AS "D_state",
           o_orderkey % 2 = 0 AS "D_private",
           CASE WHEN o_orderkey % 29 <> 0 THEN epoch_ms((946684800 + o_orderkey * 60) * 1000) END AS "D_created" FROM feed""",
)
def projected(t: Tables) -> DataFrame:
    spec = {"D_id": ("id", "string"), "D_state": ("state", "string"), "D_private": ("private", "boolean"), "D_created": ("created", "epoch")}
    rows = t.patient_feed().select("o_orderkey", parse_map(repair_json(F.col("D"))).alias("m"))
    return rows.select("o_orderkey", *project_keys(F.col("m"), spec)).withColumn("D_created", F.col("D_created").cast("timestamp_ntz"))


@register(
    "json_extra_keys",
    "JSN-12",
    "WITH " + PATIENT_FEED_SQL + """
    SELECT f.o_orderkey, concat('mood=', o.o_orderstatus, ';zipCode=', 10000 + f.o_orderkey % 80000) AS extras
    FROM feed AS f JOIN orders AS o ON f.o_orderkey = o.o_orderkey""",
)
def extras(t: Tables) -> DataFrame:
    rows = t.patient_feed().select("o_orderkey", parse_map(F.col("raw")).alias("m"))
    unknown = extra_keys(F.col("m"), ["id", "name", "state", "private", "created", "records"])
    pairs = F.transform(F.map_entries(unknown), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select("o_orderkey", F.concat_ws(";", F.array_sort(pairs)).alias("extras"))


@register(
    "json_records",
    "JSN-13 REL-12",
    "WITH " + PATIENT_FEED_SQL + """
    SELECT f.o_orderkey, concat('r', f.o_orderkey) AS record_id, 'first' AS record_name, 'a,b' AS boxes, concat('d', o.o_custkey) AS option_data,
           true AS option_fixed, CAST(f.o_orderkey % 10 AS INTEGER) AS priority, 'T' AS type, 'red' AS color
    FROM feed AS f JOIN orders AS o ON f.o_orderkey = o.o_orderkey
    UNION ALL SELECT o_orderkey, concat('s', o_orderkey), 'second', '', NULL, NULL, NULL, 'U', NULL FROM feed""",
    text=("option_fixed", "priority"),
)
def records(t: Tables) -> DataFrame:
    feed = t.patient_feed().select("o_orderkey", F.get_json_object("raw", "$.records").alias("text"))
    parsed = computed_once(feed, {"records": structure_records(F.col("text"))}, ["o_orderkey"])
    r = explode_rows(parsed, "records", alias="r")
    return r.select(
        "o_orderkey", "r.record_id", "r.record_name", F.concat_ws(",", "r.option_checkBoxes").alias("boxes"), "r.option_data",
        F.col("r.option_fixedText").alias("option_fixed"), "r.priority", "r.type", F.col("r.record_extra")["color"].alias("color"),
    )


@register(
    "json_flatten",
    "JSN-14 STD-9 REL-12",
    """
    SELECT concat('', o_orderkey) AS "key", concat('', o_custkey) AS customer_key, o_orderstatus AS customer_status_code,
           kind AS lines_exploded_kind, concat('', n) AS lines_exploded_size_n
    FROM (SELECT *, 'low' AS kind, o_orderkey % 7 AS n FROM orders WHERE o_orderkey % 3 <> 0
          UNION ALL SELECT *, 'high', o_orderkey % 5 FROM orders WHERE o_orderkey % 3 <> 0
          UNION ALL SELECT *, NULL, NULL FROM orders WHERE o_orderkey % 3 = 0) AS o""",
)
def flattened(t: Tables) -> DataFrame:
    def line(kind: str, n: str):
        return F.struct(F.lit(kind).alias("kind"), F.struct(F.expr(n).alias("n")).alias("size"))

    lines = F.when(F.expr("o_orderkey % 3 <> 0"), F.array(line("low", "o_orderkey % 7"), line("high", "o_orderkey % 5")))
    nested = t("orders").select(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("status")).alias("customer"),
        lines.alias("lines"),
    )
    flat = fully_flatten(nested)
    # A NULL number as text: the SQL side writes concat('', NULL), which is ''.
    return flat.withColumn("lines_exploded_size_n", F.coalesce("lines_exploded_size_n", F.lit("")))


@register(
    "json_epoch",
    "JSN-15",
    """
    SELECT o_orderkey, o_orderdate AS from_text, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS from_number FROM orders""",
)
def epochs(t: Tables) -> DataFrame:
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    rows = t("orders").select("o_orderkey", seconds.cast("string").alias("s"), F.when(F.expr("o_orderkey % 4 <> 0"), seconds).alias("n"))
    return rows.select(
        "o_orderkey", epoch_ts(F.col("s")).cast("timestamp_ntz").alias("from_text"), epoch_ts(F.col("n")).cast("timestamp_ntz").alias("from_number")
    )


@register(
    "json_track_keys",
    "JSN-16",
    """
    SELECT key_name, min(ts) AS first_seen_timestamp, max(ts) AS last_updated_timestamp, 'events' AS source_table
    FROM (SELECT unnest(['id', event_type, 'k']) AS key_name, ts FROM events) AS e GROUP BY key_name""",
)
def tracked(t: Tables) -> DataFrame:
    """Two batches, tracked one after the other and merged; the first sighting survives the upsert."""
    text = F.expr("""concat('{"id":', event_id, ',"', event_type, '":1,"k":', event_id % 9, '}')""")
    rows = t("events").select("ts", text.alias("j"), (F.col("event_id") % 2).alias("half"))
    first, second = [track_keys(rows.where(F.col("half") == h), "j", "events", F.col("ts")) for h in (0, 1)]
    return merge_key_tracking(first, second)


@register(
    "json_error_records",
    "JSN-17",
    "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '{}' END AS j FROM events WHERE event_id % 3 < 2",
)
def too_short(t: Tables) -> DataFrame:
    text = F.when(F.expr("event_id % 3 = 1"), F.lit("{}")).when(F.expr("event_id % 3 = 2"), F.col("props"))
    return error_records(t("events").select("event_id", text.alias("j")), "j")


@register(
    "json_error_classes",
    "JSN-18",
    f"""
    SELECT error_message, count(*) AS n, TIMESTAMP '{AT}' AS "processedTime" FROM (
      SELECT CASE WHEN event_id % 6 = 0 THEN 'Malformed JSON in D column' WHEN event_id % 6 = 1 THEN 'Missing or invalid practiceId' END
             AS error_message FROM events) AS e
    WHERE error_message IS NOT NULL GROUP BY error_message""",
)
def classes(t: Tables) -> DataFrame:
    text = F.expr(
        """CASE WHEN event_id % 6 = 0 THEN concat('{"practiceId":"p', user_id) WHEN event_id % 6 = 1 THEN '{"other":1}'
        ELSE concat('{"practiceId":"p', user_id, '"}') END"""
    )
    errors = classify_json_errors(t("events").select(text.alias("D")), "D", ["practiceId"], at())
    return errors.groupBy("error_message", "processedTime").agg(F.count(F.lit(1)).alias("n"))
