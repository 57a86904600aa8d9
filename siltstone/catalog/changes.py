"""Change feeds and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.changes import (
    change_feed,
    commit_summary,
    commit_summary_all,
    drop_reserved,
    except_columns,
    insert_feed,
)
from ..operators.evolve import widen
from ..operators.flatten import cast_all_to_string
from ..operators.scd import apply_scd1, apply_scd2, validity_columns
from ..plans.patients import patient_history, patient_latest, patient_quarantine, practice_history
from ..sources.files import stream_delimited, stream_table
from ..streaming.aggregates import SumTarget
from ..streaming.patients import PatientStream
from ..streaming.run import run_batches
from ..streaming.targets import ScdTarget
from .base import AT, PATIENT_FEED_SQL, Tables, at, files_for, register

OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"
TEXT_TIME = "%Y-%m-%d %H:%M:%S.%f"


def end_as_text(df: DataFrame) -> DataFrame:
    """The open end as text, as pandas cannot hold the year 9999 in nanoseconds."""
    return df.withColumn("EffectiveTo", F.date_format("EffectiveTo", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def spans_sql(key: str, track: str) -> str:
    return f"""
    WITH ordered AS (
      SELECT *, lag({track}) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS before_value,
             row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn
      FROM events),
    opened AS (SELECT * FROM ordered WHERE rn = 1 OR before_value <> {track}),
    closed AS (SELECT *, lead(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS until FROM opened)
    SELECT user_id, event_id, event_type, value, ts AS "EffectiveFrom", strftime(coalesce(until, {OPEN_END}), '{TEXT_TIME}') AS "EffectiveTo",
           until IS NULL AS "IsCurrent"
    FROM closed"""


def _spans(t: Tables, key: str, track: str, hot_rows: int | None = None) -> DataFrame:
    spans = apply_scd2(
        t("events"), key, ["ts", "event_id"], except_cols=["ts", "props"], track=[track], valid_from="ts", hot_rows=hot_rows
    )
    return end_as_text(spans)


@register("cdc_scd2_spans", "CDC-4 CDC-6", spans_sql("user_id", "event_type"))
def scd2_spans(t: Tables) -> DataFrame:
    return _spans(t, "user_id", "event_type")


@register("cdc_scd2_hot_key", "CDC-4", spans_sql("event_type", "user_id"))
def scd2_hot_key(t: Tables) -> DataFrame:
    """Five keys hold the whole table, and the limit is set so low that all of them are split."""
    return _spans(t, "event_type", "user_id", hot_rows=500)


@register(
    "cdc_scd1_latest",
    "CDC-3 CDC-5",
    """
    SELECT user_id, event_id, ts, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS e
    WHERE rn = 1 AND event_type <> 'error'""",
)
def scd1_latest(t: Tables) -> DataFrame:
    return apply_scd1(t("events"), "user_id", ["ts", "event_id"], "event_type = 'error'")


@register(
    "cdc_delete_when",
    "CDC-5 CDC-4",
    f"""
    SELECT user_id, event_id, event_type, ts AS "EffectiveFrom", strftime(coalesce(until, {OPEN_END}), '{TEXT_TIME}') AS "EffectiveTo",
           until IS NULL AS "IsCurrent"
    FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events) AS e
    WHERE event_type <> 'error'""",
)
def delete_when(t: Tables) -> DataFrame:
    changes = t("events").select("user_id", "event_id", "event_type", "ts")
    history = apply_scd2(changes, "user_id", ["ts", "event_id"], "event_type = 'error'", except_cols=["ts"], valid_from="ts")
    return end_as_text(history)


@register(
    "cdc_composite_sequence",
    "CDC-6 CDC-3",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_partkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC,
                                   l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) AS l
    WHERE rn = 1""",
)
def composite_sequence(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    latest = apply_scd1(lines, "l_orderkey", ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_partkey")


@register(
    "cdc_except_columns",
    "CDC-7",
    """
    SELECT "ID", "BusinessID", "Shard", o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY "ID", "BusinessID" ORDER BY _commit_version DESC) AS rn
      FROM (WITH """
    + PATIENT_FEED_SQL
    + """ SELECT * FROM feed) AS f WHERE "ID" IS NOT NULL AND _change_type <> 'update_preimage') AS r
    WHERE rn = 1 AND _change_type <> 'delete'""",
)
def except_cols(t: Tables) -> DataFrame:
    feed = except_columns(t.patient_feed(), ["raw", "D", "Created", "Updated"])
    dropped = ["_change_type", "_commit_version", "_commit_timestamp"]
    return apply_scd1(feed, ["ID", "BusinessID"], ["_commit_version", "_commit_timestamp"], "_change_type = 'delete'", dropped)


@register(
    "cdc_drop_reserved",
    "CDC-8",
    "WITH " + PATIENT_FEED_SQL + ' SELECT o_orderkey, "ID", "Shard", "BusinessID", "Created", "Updated", md5("D") AS d_md5 FROM feed',
)
def reserved_dropped(t: Tables) -> DataFrame:
    return drop_reserved(t.patient_feed()).withColumn("d_md5", F.md5("D")).drop("raw", "D")


@register(
    "cdc_validity",
    "CDC-9",
    f"""
    SELECT event_id, ts AS "EffectiveFrom", strftime({OPEN_END}, '{TEXT_TIME}') AS "EffectiveTo", true AS "IsCurrent" FROM events""",
)
def validity(t: Tables) -> DataFrame:
    return end_as_text(validity_columns(t("events").select("event_id", "ts"), "ts").drop("ts"))


@register(
    "cdc_merge_schema",
    "CDC-10",
    """
    SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS p_brand, CAST(p_size AS BIGINT) AS p_size,
        CAST(CAST(p_size AS DECIMAL(21, 2)) AS VARCHAR) AS exact, CAST(p_size AS DOUBLE) AS rough, TIMESTAMP '2024-01-02 00:00:00' AS moment
    FROM part""",
    text=("exact",),
)
def merge_schema(t: Tables) -> DataFrame:
    """The newer half of the rows brings a column the target lacks and wider types of others."""
    part = t("part")

    def typed(rows: DataFrame, size: str, exact: str, rough: str, moment: str, *more: str) -> DataFrame:
        day = F.lit("2024-01-02").cast(moment)
        size_as = [F.col("p_size").cast(kind).alias(name) for kind, name in ((size, "p_size"), (exact, "exact"), (rough, "rough"))]
        return rows.select("p_partkey", "p_name", *more, *size_as, day.alias("moment"))

    old = typed(part.where("p_partkey % 2 = 0"), "smallint", "decimal(10,2)", "float", "date")
    new = typed(part.where("p_partkey % 2 = 1"), "bigint", "bigint", "double", "timestamp_ntz", "p_brand")
    return widen(old, new)


@register(
    "cdc_processed_time",
    "CDC-11",
    f"""
    SELECT user_id, max(event_id) AS event_id, TIMESTAMP '{AT}' AS "processedTime" FROM events GROUP BY user_id""",
)
def processed_time(t: Tables) -> DataFrame:
    return apply_scd1(t("events").select("user_id", "event_id"), "user_id", "event_id", at=at())


SNAPSHOT_SQL = """
    before_rows AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders),
    after_rows AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
      FROM before_rows WHERE o_orderkey % 17 <> 0
      UNION ALL
      SELECT o_orderkey + 10000000000, o_totalprice, NULL FROM before_rows WHERE o_orderkey % 19 = 0)"""


@register(
    "cdc_change_feed",
    "CDC-1",
    f"""
    WITH {SNAPSHOT_SQL},
    pairs AS (
      SELECT b.o_orderkey AS bk, b.o_totalprice AS bp, b.o_orderstatus AS bs,
             a.o_orderkey AS ak, a.o_totalprice AS ap, a.o_orderstatus AS asx
      FROM before_rows AS b FULL OUTER JOIN after_rows AS a ON b.o_orderkey = a.o_orderkey)
    SELECT ak AS o_orderkey, ap AS o_totalprice, asx AS o_orderstatus, 'insert' AS _change_type,
           CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '{AT}' AS _commit_timestamp FROM pairs WHERE bk IS NULL
    UNION ALL SELECT bk, bp, bs, 'delete', 2, TIMESTAMP '{AT}' FROM pairs WHERE ak IS NULL
    UNION ALL SELECT bk, bp, bs, 'update_preimage', 2, TIMESTAMP '{AT}' FROM pairs WHERE ak = bk AND ap <> bp
    UNION ALL SELECT ak, ap, asx, 'update_postimage', 2, TIMESTAMP '{AT}' FROM pairs WHERE ak = bk AND ap <> bp""",
)
def snapshot_feed(t: Tables) -> DataFrame:
    return change_feed(*snapshots(t), ["o_orderkey"], 2, at())


def snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    before = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    # Rows without a key are on both sides and take no part.
    lost = before.where("o_orderkey % 23 = 0").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    price = F.when(F.expr("o_orderkey % 13 = 0"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = before.where("o_orderkey % 17 <> 0").withColumn("o_totalprice", price)
    added = before.where("o_orderkey % 19 = 0").select(
        (F.col("o_orderkey") + 10000000000).alias("o_orderkey"), "o_totalprice", F.lit(None).cast("string").alias("o_orderstatus")
    )
    return before.unionByName(lost), after.unionByName(added).unionByName(lost)


@register(
    "cdc_insert_feed",
    "CDC-1 CDC-2",
    f"SELECT 'insert' AS change_type, user_id % 10 AS commit_version, TIMESTAMP '{AT}' AS commit_timestamp, count(*) AS rcrd_cnt FROM events GROUP BY ALL",
)
def inserts(t: Tables) -> DataFrame:
    return commit_summary(insert_feed(t("events"), F.col("user_id") % 10, at()))


@register(
    "cdc_commit_summary",
    "CDC-2 REL-8",
    "WITH " + PATIENT_FEED_SQL + """
    SELECT _change_type AS change_type, _commit_version AS commit_version, _commit_timestamp AS commit_timestamp,
           count(*) AS rcrd_cnt FROM (SELECT _change_type, o_orderkey % 20 AS _commit_version, _commit_timestamp FROM feed) AS f
    GROUP BY ALL""",
)
def summary(t: Tables) -> DataFrame:
    return commit_summary(t.patient_feed().withColumn("_commit_version", F.expr("o_orderkey % 20")))


ALL_FEEDS = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}


@register(
    "cdc_commit_summary_all",
    "CDC-2 REL-8 REL-10",
    "SELECT table_name, change_type, commit_version, commit_timestamp, count(*) AS rcrd_cnt FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CASE WHEN {key} % 5 = 0 THEN 'delete' ELSE 'insert' END AS change_type, "
        f"{key} % 20 AS commit_version, TIMESTAMP '{AT}' AS commit_timestamp FROM {name}"
        for name, key in ALL_FEEDS.items()
    )
    + ") AS feeds GROUP BY ALL",
)
def summary_all(t: Tables) -> DataFrame:
    def feed(name: str, key: str) -> DataFrame:
        return t(name).select(
            F.expr(f"CASE WHEN {key} % 5 = 0 THEN 'delete' ELSE 'insert' END AS _change_type"),
            F.expr(f"{key} % 20 AS _commit_version"),
            at().alias("_commit_timestamp"),
        )

    return commit_summary_all({name: feed(name, key) for name, key in ALL_FEEDS.items()})


def _streamed(t: Tables, target: ScdTarget) -> DataFrame:
    """Events arrive in four micro-batches in no particular order."""
    landing = t.scratch("landing")
    files = files_for(t("events").count(), 4)
    t("events").select("user_id", "event_id", "event_type", "ts", "value").repartition(4 * files).write.parquet(landing)
    stream = t.spark.readStream.schema(t.spark.read.parquet(landing).schema).option("maxFilesPerTrigger", files).parquet(landing)
    run_batches(stream, target.upsert, t.scratch("checkpoint"))
    return target.read(t.spark)


@register(
    "cdc_stream_scd1",
    "CDC-3 SRC-14",
    """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS e
    WHERE rn = 1 AND event_type <> 'error'""",
)
def stream_scd1(t: Tables) -> DataFrame:
    return _streamed(
        t, ScdTarget(t.scratch("scd1"), ["user_id"], ["ts", "event_id"], delete_when="event_type = 'error'", buckets=8)
    )


@register("cdc_stream_scd2", "CDC-4 SRC-14", spans_sql("user_id", "event_type"))
def stream_scd2(t: Tables) -> DataFrame:
    target = ScdTarget(
        t.scratch("scd2"), ["user_id"], ["ts", "event_id"], 2, except_cols=["ts"], track=["event_type"], valid_from="ts", buckets=8
    )
    return end_as_text(_streamed(t, target))


@register(
    "cdc_table_stream",
    "CDC-1 SRC-19",
    "WITH " + PATIENT_FEED_SQL + " SELECT _change_type, count(*) AS rcrd_cnt FROM feed GROUP BY _change_type",
)
def table_stream(t: Tables) -> DataFrame:
    """A stored change feed read as a stream, summed up from micro-batch results."""
    stored, target = t.scratch("feed"), SumTarget(t.scratch("counts"), ["change_type"], ["rcrd_cnt"])
    t.patient_feed().select("_change_type", "_commit_version", "_commit_timestamp").write.parquet(stored)
    run_batches(
        stream_table(t.spark, stored), lambda batch, batch_id: target.upsert(commit_summary(batch), batch_id), t.scratch("checkpoint")
    )
    return target.read(t.spark).withColumnRenamed("change_type", "_change_type")


VALID_PATIENT = """"ID" IS NOT NULL AND o_orderkey % 29 <> 0 AND o_orderkey % 13 > 1"""
LIVE_VERSIONS = f"""
    WITH {PATIENT_FEED_SQL},
    rows AS (
      SELECT * FROM feed WHERE ({VALID_PATIENT} OR "ID" IS NOT NULL AND _change_type = 'delete') AND _change_type <> 'update_preimage')"""


HISTORY_SQL = (
    LIVE_VERSIONS
    + f"""
    SELECT "ID", "BusinessID", concat('', o_orderkey) AS "D_id", 'TX' AS "D_state",
           epoch_ms((946684800 + o_orderkey * 60) * 1000) AS "D_created", o_orderkey % 2 = 0 AS "D_private",
           _commit_timestamp AS "EffectiveFrom", strftime(coalesce(until, {OPEN_END}), '{TEXT_TIME}') AS "EffectiveTo", until IS NULL AS "IsCurrent"
    FROM (SELECT *, lead(_commit_timestamp) OVER (PARTITION BY "ID", "BusinessID" ORDER BY _commit_version) AS until FROM rows) AS r
    WHERE _change_type <> 'delete'"""
)


def _history_columns(history: DataFrame) -> DataFrame:
    return history.select(
        "ID", "BusinessID", "D_id", "D_state", F.col("D_created").cast("timestamp_ntz").alias("D_created"), "D_private",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("EffectiveFrom", "EffectiveTo")], "IsCurrent",
    ).transform(end_as_text)


@register("flow_patient_history", "CDC-4 JSN-1 JSN-5 JSN-11 JSN-13 DQ-4", HISTORY_SQL)
def flow_history(t: Tables) -> DataFrame:
    return _history_columns(patient_history(t.patient_feed(), at()))


@register("flow_patient_stream", "CDC-4 SRC-1 SRC-14 JSN-1 JSN-5 JSN-11 JSN-13 DQ-4 DQ-5", HISTORY_SQL)
def flow_stream(t: Tables) -> DataFrame:
    """Change files in delimited text, streamed in three micro-batches into history and quarantine."""
    landing = t.scratch("landing")
    feed = cast_all_to_string(t.patient_feed().drop("raw", "o_orderkey"))
    files = files_for(t("orders").count(), 3)
    feed.repartition(3 * files).write.options(sep="\t", header="true", escape='"').csv(landing)
    stream = stream_delimited(t.spark, landing, feed.schema, maxFilesPerTrigger=str(files)).withColumns(
        {"_commit_version": F.col("_commit_version").try_cast("bigint"), "_commit_timestamp": F.col("_commit_timestamp").try_cast("timestamp")}
    )
    flow = PatientStream(t.scratch("patients"), buckets=8)
    run_batches(stream, flow.upsert, t.scratch("checkpoint"))
    return _history_columns(flow.patients(t.spark))


@register(
    "flow_patient_latest",
    "CDC-3 JSN-11 JSN-12 JSN-13",
    LIVE_VERSIONS
    + """
    SELECT "ID", "BusinessID", concat('', o_orderkey) AS "D_id", o_orderstatus_mood AS mood, 2 AS n_records,
           concat('d', substr("ID", 2)) AS option_data, CAST(o_orderkey % 10 AS INTEGER) AS priority
    FROM (SELECT *, json_extract_string(raw, '$.mood') AS o_orderstatus_mood,
                 row_number() OVER (PARTITION BY "ID", "BusinessID" ORDER BY _commit_version DESC) AS rn FROM rows) AS r
    WHERE rn = 1 AND _change_type <> 'delete'""",
)
def flow_latest(t: Tables) -> DataFrame:
    latest = patient_latest(t.patient_feed(), at())
    first = F.col("D_records")[0]
    return latest.select(
        "ID", "BusinessID", "D_id", F.col("D_extra")["mood"].alias("mood"), F.size("D_records").alias("n_records"),
        first["option_data"].alias("option_data"), first["priority"].alias("priority"),
    )


@register(
    "flow_patient_quarantine",
    "DQ-4 DQ-5 JSN-1 JSN-5",
    f"""
    WITH {PATIENT_FEED_SQL},
    failed AS (SELECT *, CASE WHEN "ID" IS NULL THEN 'id_not_null' WHEN o_orderkey % 29 = 0 THEN 'dcreated_not_null'
                              WHEN o_orderkey % 13 <= 1 THEN 'state_two_chars' END AS constraint_name FROM feed)
    SELECT 'silver_events_patient_data_cdc_scd2' AS flow_name, 'silver_events_patient_data_scd2' AS table_name, constraint_name,
           CASE constraint_name WHEN 'id_not_null' THEN 'ID IS NOT NULL' WHEN 'dcreated_not_null' THEN 'D_created IS NOT NULL'
             ELSE 'D_state RLIKE ''^[A-Z]{{2}}$''' END AS constraint_expression,
           "ID" AS id, "Created" AS created,
           CASE o_orderkey % 13 WHEN 0 THEN 'Texas' WHEN 1 THEN NULL ELSE 'TX' END AS d_state, TIMESTAMP '{AT}' AS violated_at
    FROM failed WHERE constraint_name IS NOT NULL""",
)
def flow_quarantine(t: Tables) -> DataFrame:
    records = patient_quarantine(t.patient_feed(), at())
    return records.select(
        "flow_name", "table_name", "constraint_name", "constraint_expression", F.col("record.ID").alias("id"),
        F.col("record.Created").alias("created"), F.col("record.D_state").alias("d_state"), "violated_at",
    )



def _practice_feed(events: DataFrame) -> DataFrame:
    payload = F.expr("to_json(named_struct('patientId', concat('', user_id), 'practiceId', concat('Q', event_id % 3), 'city', event_type, 'created', event_id, 'other', 1))")
    kind = F.expr("CASE WHEN event_id % 11 = 0 THEN 'delete' WHEN event_id % 7 = 0 THEN 'update_preimage' ELSE 'update_postimage' END")
    nothing = F.lit(None).cast("string")
    return events.select(
        F.lit("x").alias("PatientID"), nothing.alias("Created"), nothing.alias("Updated"),
        F.when(F.expr("event_id % 31 = 0"), F.lit("{bad")).otherwise(payload).alias("D"), kind.alias("_change_type"),
        F.col("event_id").alias("_commit_version"), F.col("ts").alias("_commit_timestamp"),
    )


@register(
    "flow_practice_history",
    "CDC-4 JSN-3 JSN-4 JSN-10 REL-17",
    f"""
    WITH used AS (
      SELECT concat('', user_id) AS patient, concat('Q', event_id % 3) AS practice, event_type AS city, event_id, ts, event_id % 11 = 0 AS gone
      FROM events WHERE event_id % 31 <> 0 AND (event_id % 11 = 0 OR event_id % 7 <> 0)),
    spans AS (SELECT *, lead(ts) OVER (PARTITION BY patient, practice ORDER BY event_id) AS until FROM used)
    SELECT patient, practice, city, event_id AS created, ts AS "EffectiveFrom",
           strftime(coalesce(until, {OPEN_END}), '{TEXT_TIME}') AS "EffectiveTo", until IS NULL AS "IsCurrent"
    FROM spans WHERE NOT gone""",
)
def flow_practices(t: Tables) -> DataFrame:
    """History of links whose keys stand in the JSON payload; lines that are no JSON have no key and go."""
    history = practice_history(_practice_feed(t("events")), at())
    return history.select(
        F.col("patientId_from_json").alias("patient"), F.col("practiceId_from_json").alias("practice"), "city",
        F.col("json_created").alias("created"), "EffectiveFrom", "EffectiveTo", "IsCurrent",
    ).transform(end_as_text)
