"""Sources, sinks and ingestion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from ..functions.text import batch_prefix
from ..operators.flatten import cast_all_to_string
from ..operators.payload import ingest_json_quality, with_corrupt, with_rescue
from ..operators.quality import quality_issues, quality_summary
from ..sources.feeds import Feed, ingest_feeds, run_feeds, text_schema
from ..sources.files import (
    append_by_name,
    read_csv,
    read_json,
    read_table,
    stream_delimited,
    stream_json,
    stream_parquet,
    stream_table,
    with_file_metadata,
    with_ingest_audit,
    write_table,
)
from ..sources.generate import json_rows_for
from ..streaming.run import run_stream
from .base import AT, Tables, at, register

# CSV written so that any text survives: quotes doubled, blanks and empty strings kept.
FAITHFUL_CSV = {
    "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "",
}


def _landed(t: Tables, stream: DataFrame) -> DataFrame:
    """Run a stream to completion and read what it stored."""
    sink = t.scratch("sink")
    run_stream(stream, sink, t.scratch("checkpoint"))
    return t.spark.read.parquet(sink)


@register(
    "source_stream_delimited",
    "SRC-1 SRC-14",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
           o_orderpriority FROM orders""",
)
def delimited(t: Tables) -> DataFrame:
    orders = cast_all_to_string(t("orders"))
    path = t.export(orders, "csv", sep="\t", header="true", **FAITHFUL_CSV)
    rows = _landed(t, stream_delimited(t.spark, path, orders.schema))
    numbers = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return rows.withColumns({c: F.col(c).try_cast(kind) for c, kind in numbers.items()})


@register(
    "source_delimited_utf16",
    "SRC-2",
    "SELECT doc_id, md5(text) AS text_md5, length(text) AS n_text, lang FROM documents",
)
def delimited_utf16(t: Tables) -> DataFrame:
    """Headerless UTF-16LE files whose fields span lines."""
    documents = t("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    path = t.export(documents, "csv", sep="\t", encoding="UTF-16LE", **FAITHFUL_CSV)
    stream = stream_delimited(t.spark, path, documents.schema, header=False, multi_line=True, encoding="UTF-16LE")
    return _landed(t, stream).select(
        F.col("doc_id").try_cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"), F.length("text").alias("n_text"), "lang"
    )


EVENT_SCHEMA = (
    StructType()
    .add("event_id", LongType())
    .add("user_id", LongType())
    .add("event_type", StringType())
    .add("value", DoubleType())
    .add("props", StringType())
)
EVENT_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"


@register("source_stream_json", "SRC-3 SRC-14", EVENT_SQL)
def json_declared(t: Tables) -> DataFrame:
    path = t.export(t("events").select(*EVENT_SCHEMA.names), "json")
    rows = _landed(t, stream_json(t.spark, path, EVENT_SCHEMA))
    return rows.where(F.col("_rescued_data").isNull()).select(*EVENT_SCHEMA.names)


@register("source_stream_json_inferred", "SRC-4 JSN-9", EVENT_SQL)
def json_inferred(t: Tables) -> DataFrame:
    path = t.export(t("events").select(*EVENT_SCHEMA.names), "json")
    rows = _landed(t, stream_json(t.spark, path, schema_location=t.scratch("schemas")))
    return rows.select(*EVENT_SCHEMA.names)


@register(
    "source_stream_parquet",
    "SRC-5 CDC-10",
    "SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events",
)
def parquet_evolving(t: Tables) -> DataFrame:
    """Newer files carry a column the older ones lack."""
    landing, events = t.scratch("landing"), t("events")
    events.where("event_id % 2 = 0").select("event_id", "event_type").write.parquet(landing)
    events.where("event_id % 2 = 1").select("event_id", "event_type", "props").write.mode("append").parquet(landing)
    return _landed(t, stream_parquet(t.spark, landing, t.scratch("schemas")))


@register("source_read_csv", "SRC-6", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_batch(t: Tables) -> DataFrame:
    path = t.export(t("customer"), "csv", header="true", **FAITHFUL_CSV)
    rows = read_csv(t.spark, path)
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    return rows.withColumns({c: F.col(c).try_cast(kind) for c, kind in types.items()})


# Event rows as JSON text, every tenth of them spoilt in one of four ways.
SPOILT_PARTS = (
    """concat('{"id":', event_id, ',"kind":"', event_type, '","cents":',
    CASE WHEN event_id % 10 = 2 THEN '"N/A"' ELSE concat('', CAST(round(value * 100) AS BIGINT)) END,
    ',"meta":{"user":', user_id, CASE WHEN event_id % 10 = 1 THEN ',"extra":"bonus"' ELSE '' END, '}',
    CASE WHEN event_id % 10 = 0 THEN ',"unexpected":"x"' ELSE '' END,
    CASE WHEN event_id % 10 = 3 THEN '' ELSE '}' END)"""
)
SPOILT_SQL = f"spoilt AS (SELECT event_id, event_type, user_id, value, {SPOILT_PARTS} AS j FROM events)"
SPOILT_SCHEMA = (
    StructType()
    .add("id", LongType())
    .add("kind", StringType())
    .add("cents", LongType())
    .add("meta", StructType().add("user", LongType()))
)
RESCUED_SQL = """CASE event_id % 10 WHEN 0 THEN '{"unexpected":"x"}' WHEN 1 THEN '{"meta":{"extra":"bonus"}}'
    WHEN 2 THEN '{"cents":"N/A"}' END"""


def spoilt(t: Tables) -> DataFrame:
    return t("events").select("event_id", F.expr(SPOILT_PARTS).alias("j"))


@register(
    "source_rescue",
    "SRC-7",
    f"""
    SELECT event_id, CASE WHEN event_id % 10 NOT IN (2, 3) THEN CAST(round(value * 100) AS BIGINT) END AS cents,
           CASE WHEN event_id % 10 <> 3 THEN user_id END AS user_id, {RESCUED_SQL} AS _rescued_data FROM events""",
    text=("cents", "user_id"),
)
def rescue(t: Tables) -> DataFrame:
    rows = with_rescue(spoilt(t), "j", SPOILT_SCHEMA)
    return rows.select("event_id", "cents", F.col("meta.user").alias("user_id"), "_rescued_data")


@register(
    "source_corrupt",
    "SRC-8",
    f"WITH {SPOILT_SQL} SELECT event_id, CASE WHEN event_id % 10 = 3 THEN j END AS _corrupt_record FROM spoilt",
)
def corrupt(t: Tables) -> DataFrame:
    return with_corrupt(spoilt(t), "j", SPOILT_SCHEMA).select("event_id", "_corrupt_record")


@register(
    "source_json_quality",
    "SRC-9 SRC-7 SRC-8",
    f"""
    WITH {SPOILT_SQL} SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN event_type END AS kind, {RESCUED_SQL} AS _rescued_data,
           CASE WHEN event_id % 10 = 3 THEN j END AS _corrupt_record FROM spoilt""",
)
def json_quality(t: Tables) -> DataFrame:
    rows = ingest_json_quality(spoilt(t), "j", SPOILT_SCHEMA)
    return rows.select("event_id", "kind", "_rescued_data", "_corrupt_record")


@register(
    "dq_quality_summary",
    "DQ-9 SRC-9",
    """
    SELECT count(*) AS total, count(*) FILTER (WHERE event_id % 10 < 3) AS rescued, count(*) FILTER (WHERE event_id % 10 = 3) AS corrupt,
           round(count(*) FILTER (WHERE event_id % 10 <= 3) / count(*) * 100, 1) AS coverage_pct FROM events""",
)
def summary(t: Tables) -> DataFrame:
    return quality_summary(ingest_json_quality(spoilt(t), "j", SPOILT_SCHEMA))


@register(
    "dq_quality_issues",
    "DQ-10 SRC-9 SRC-10",
    f"""
    WITH {SPOILT_SQL} SELECT CASE WHEN event_id % 10 <> 3 THEN event_id END AS id, {RESCUED_SQL} AS _rescued_data,
           CASE WHEN event_id % 10 = 3 THEN j END AS _corrupt_record, true AS from_json_file FROM spoilt WHERE event_id % 10 <= 3""",
    text=("id",),
)
def issues(t: Tables) -> DataFrame:
    """Files of JSON lines, read with rescue and corrupt capture; flagged lines by file."""
    path = t.export(spoilt(t).select(F.col("j").alias("value")), "text")
    rows = with_file_metadata(read_json(t.spark, path, SPOILT_SCHEMA, corrupt=True), "all")
    flagged = quality_issues(rows, ["id"])
    return flagged.select("id", "_rescued_data", "_corrupt_record", F.col("file_name").startswith("part-").alias("from_json_file"))


@register("source_file_metadata", "SRC-10", "SELECT 'events.parquet' AS file_name, true AS path_matches, count(*) AS n FROM events")
def file_metadata(t: Tables) -> DataFrame:
    rows = with_file_metadata(t("events").select("event_id", "_metadata"), "names")
    matches = F.col("fullFilePath").endswith(F.col("inputFilename")) & (F.col("fileMetadata.file_name") == F.col("inputFilename"))
    return rows.groupBy(F.col("inputFilename").alias("file_name"), matches.alias("path_matches")).agg(F.count(F.lit(1)).alias("n"))


LANDING_PATH = (
    "CASE WHEN o_orderkey % 5 = 0 THEN '/landing/none/file.tsv' ELSE concat('/landing/', year(o_orderdate), '/', month(o_orderdate), "
    "'/', day(o_orderdate), '/', 10 + o_orderkey % 14, '-00/file.tsv') END"
)


@register(
    "source_batch_prefix",
    "SRC-11",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN concat(year(o_orderdate), '/', month(o_orderdate), '/', day(o_orderdate),
           '/', 10 + o_orderkey % 14, '-00') END AS bronze_prefix FROM orders""",
)
def prefix(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", batch_prefix(F.expr(LANDING_PATH)).alias("bronze_prefix"))


@register(
    "source_ingest_audit",
    "SRC-12",
    f"""
    SELECT c_custkey, TIMESTAMP '{AT}' AS "ingestTime", CAST(TIMESTAMP '{AT}' AS DATE) AS "ingestDate",
           TIMESTAMP '{AT}' AS data_ingestion_ts FROM customer""",
    text=("ingestDate",),
)
def ingest_audit(t: Tables) -> DataFrame:
    return with_ingest_audit(t("customer").select("c_custkey"), at())


# The source feeds and their columns, all of them text.
FEED_COLUMNS = {
    "GdprBacklog": "PatientID Processed Active Timestamp",
    "PartnerNotification": "ID PatientID Shard PartnerID Retry Message",
    "PatientSensor": "PatientID Shard SerialNumber Activated Ended D Created",
    "PatientPartnerConnection": "PatientID Shard PartnerID Created CreatedBy Updated UpdatedBy V D P",
    "PatientConnectionHistory": "PatientID Shard FollowerID Action Status D Updated",
    "Measurement": "PatientID Shard DeviceID Timestamp Type FactoryTimestamp Created D UploadID RecordNumber TimestampOffset",
    "PatientConnection": "PatientID Shard FollowerID S SUpdated R RUpdated D Updated",
    "PatientUpload": "PatientID Shard UploadID DeviceID DeviceTypeID TSMin TSMax FTSMin FTSMax Created",
    "LibreLinkSession": "PatientID Shard DeviceID DeviceTypeID Created CreatedBy Updated UpdatedBy V D P",
    "PatientPractice": "PatientID Shard PracticeID Created CreatedBy Updated UpdatedBy V D P",
}
def _feed_sql(name: str) -> str:
    feed = f"'bronze_{name.lower()}' AS feed"
    if name == "PatientPractice":
        return f"SELECT {feed}, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_patients, CAST(sum(o_orderkey) AS BIGINT) AS sum_k FROM orders"
    payload = "sum(CAST(json_extract_string(props, '$.k') AS BIGINT))" if "D" in FEED_COLUMNS[name].split() else "NULL"
    return f"SELECT {feed}, count(*) AS n_rows, count(DISTINCT user_id) AS n_patients, CAST({payload} AS BIGINT) AS sum_k FROM events"


@register("source_feeds", "SRC-13 SRC-1 SRC-10 SRC-11 SRC-12 JSN-9", " UNION ALL ".join(_feed_sql(name) for name in FEED_COLUMNS), text=("sum_k",))
def feeds(t: Tables) -> DataFrame:
    """All feeds at once, with and without a JSON payload; one of them is made from orders."""
    root = t.scratch("feeds")
    sources = {name: (t("events"), {"PatientID": "user_id", "Created": "ts", "Type": "event_type", "D": "props"}) for name in FEED_COLUMNS}
    sources["PatientPractice"] = (
        t("orders"),
        {"PatientID": "o_custkey", "PracticeID": "o_orderkey", "D": "to_json(named_struct('k', o_orderkey, 's', o_orderstatus))"},
    )
    feeds = []
    for name, (df, mapping) in sources.items():
        schema = text_schema(FEED_COLUMNS[name])
        columns = [F.expr(mapping.get(c, "NULL")).cast("string").alias(c) for c in schema.names]
        df.select(*columns).write.options(sep="\t", header="true", escape='"').csv(f"{root}/in/{name}")
        feeds.append(Feed(name, schema, f"{root}/in/{name}"))
    sinks = run_feeds(ingest_feeds(t.spark, feeds, f"{root}/schemas", at()), root)
    counts = []
    for name, sink in sinks.items():
        table = t.spark.read.parquet(sink)
        parsed = F.sum("D_parsed.k") if "D_parsed" in table.columns else F.lit(None).cast("bigint")
        counts.append(
            table.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("PatientID").alias("n_patients"), parsed.alias("sum_k"))
            .select(F.lit(name).alias("feed"), "n_rows", "n_patients", "sum_k")
        )
    return reduce(DataFrame.unionByName, counts)


@register("source_run_stream", "SRC-14", "SELECT event_type, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM events GROUP BY event_type")
def run_twice(t: Tables) -> DataFrame:
    """The second run finds nothing new, so every row is stored once."""
    landing, sink, checkpoint = t.scratch("landing"), t.scratch("sink"), t.scratch("checkpoint")
    t("events").select("event_id", "event_type").write.parquet(landing)
    for _ in range(2):
        run_stream(stream_table(t.spark, landing), sink, checkpoint)
    rows = t.spark.read.parquet(sink)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high")
    )


@register("source_write_read", "SRC-15", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def write_read(t: Tables) -> DataFrame:
    path, orders = t.scratch("table"), t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(orders, path)
    write_table(orders, path)
    return read_table(t.spark, path)


@register(
    "source_partitioned_layout",
    "SRC-16",
    """
    SELECT l_returnflag, year(l_shipdate) AS ship_year, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem
    WHERE l_returnflag = 'R' GROUP BY ALL""",
)
def partitioned(t: Tables) -> DataFrame:
    """The stored table is pruned to one folder, then to the row groups whose statistics match."""
    path = t.scratch("table")
    lines = t("lineitem").select("l_returnflag", "l_shipdate", "l_quantity")
    write_table(lines, path, partition_by=["l_returnflag"], cluster_by=["l_shipdate"])
    kept = read_table(t.spark, path).where("l_returnflag = 'R'")
    return kept.groupBy("l_returnflag", F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@register(
    "source_json_rows",
    "SRC-18",
    """
    SELECT event_id AS id, concat('user_', event_id % 100) AS user_name, concat('192.168.1.', event_id % 255) AS ip,
           concat('device_', event_id % 10) AS device, CAST(event_id % 5 AS INTEGER) AS n_tags, true AS score_in_range FROM events""",
)
def json_rows(t: Tables) -> DataFrame:
    rows = json_rows_for(t("events"), "event_id")
    path = lambda p: F.get_json_object("json_str", p)
    return rows.select(
        path("$.id").cast("bigint").alias("id"), path("$.user").alias("user_name"), path("$.metadata.ip").alias("ip"),
        path("$.metadata.device").alias("device"), F.json_array_length(path("$.tags")).alias("n_tags"),
        path("$.score").cast("int").between(0, 100).alias("score_in_range"),
    )


@register("source_stream_table", "SRC-19", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def table_as_stream(t: Tables) -> DataFrame:
    stored = t.scratch("table")
    write_table(t("events"), stored)
    stream = stream_table(t.spark, stored).where("event_type = 'purchase'").select("event_id", "user_id", "value")
    return _landed(t, stream)


@register(
    "source_append_by_name",
    "SRC-20",
    """
    SELECT p_partkey, p_name,
        CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) END AS p_size,
        CASE WHEN p_partkey % 3 = 1 THEN concat('{"p_size":"x', p_size, '"}') END AS lost
    FROM part""",
    text=("p_size",),
)
def append(t: Tables) -> DataFrame:
    """Three appends: another order and a narrower type, values that do not fit, one column missing."""
    path, part = t.scratch("table"), t("part")
    schema = StructType.fromDDL("p_partkey BIGINT, p_name STRING, p_size BIGINT")
    odd = part.withColumn("p_size", F.concat(F.lit("x"), "p_size"))
    append_by_name(part.where("p_partkey % 3 = 0").select("p_size", "p_name", "p_partkey", "p_brand"), path, schema, rescued="lost")
    append_by_name(odd.where("p_partkey % 3 = 1"), path, schema, rescued="lost")
    append_by_name(part.where("p_partkey % 3 = 2").select("p_name", "p_partkey"), path, schema, rescued="lost")
    return read_table(t.spark, path)
