"""Standardization."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.flatten import cast_all_to_string
from ..operators.standardize import (
    clean_column_names,
    coalesce_variants,
    dedupe,
    dedupe_stream,
    lower_columns,
    standardize,
    standardize_encoding,
    title_columns,
    trim_strings,
)
from ..sources.files import stream_table
from ..streaming.run import run_stream
from .base import Tables, register

LATIN1 = r"[\x00-\x1F\x7F-\x{FF}]"
TITLE = """array_to_string(list_transform(string_split({0}, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), ' ')"""


@register("std_column_names", "STD-1", "SELECT p_partkey AS part_key, p_name AS part_name_text_, p_size AS p_size FROM part")
def names(t: Tables) -> DataFrame:
    odd = t("part").select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("PART-Name (Text)"), F.col("p_size").alias("P_Size"))
    return clean_column_names(odd)


@register("std_trim", "STD-2", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def trimmed(t: Tables) -> DataFrame:
    padded = t("part").withColumns({c: F.concat(F.lit("  "), F.col(c), F.lit("   ")) for c in ("p_name", "p_brand", "p_type")})
    return trim_strings(padded)


@register("std_lower", "STD-3", "SELECT p_partkey, lower(p_brand) AS p_brand, lower(p_type) AS p_type, p_name FROM part")
def lowered(t: Tables) -> DataFrame:
    return lower_columns(t("part").select("p_partkey", "p_brand", "p_type", "p_name"), ["p_brand", "p_type"])


@register(
    "std_title", "STD-4", f"SELECT p_partkey, {TITLE.format('p_name')} AS p_name, {TITLE.format('p_type')} AS p_type FROM part"
)
def titled(t: Tables) -> DataFrame:
    return title_columns(t("part").select("p_partkey", "p_name", "p_type"), ["p_name", "p_type"])


@register(
    "std_encoding",
    "STD-5",
    rf"""
    SELECT doc_id, md5(cleaned) AS text_md5, length(cleaned) AS n, source FROM (
      SELECT doc_id, regexp_replace(text, '{LATIN1}', '', 'g') AS cleaned,
             CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS source FROM documents) AS d""",
)
def encoded(t: Tables) -> DataFrame:
    source = F.when(F.expr("doc_id % 3 <> 0"), F.col("source"))
    cleaned = standardize_encoding(t("documents").select("doc_id", "text", source.alias("source")))
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"), "source")


@register(
    "std_standardize",
    "STD-6 STD-7",
    rf"""
    SELECT md5(regexp_replace(trim(doc_text, ' '), '{LATIN1}', '', 'g')) AS text_md5, lang, n_chars FROM (
      SELECT DISTINCT text AS doc_text, lang, n_chars FROM documents) AS d""",
)
def standardized(t: Tables) -> DataFrame:
    raw = t("documents").select(F.col("text").alias("Doc Text"), F.col("lang").alias("LANG"), F.col("n_chars").alias("N Chars"))
    return standardize(raw).select(F.md5("doc_text").alias("text_md5"), "lang", "n_chars")


@register("std_dedupe", "STD-7", "SELECT lang, md5(text) AS text_md5 FROM (SELECT DISTINCT lang, text FROM documents) AS d")
def deduped(t: Tables) -> DataFrame:
    return dedupe(t("documents").select("lang", "text")).select("lang", F.md5("text").alias("text_md5"))


@register(
    "std_dedupe_map",
    "STD-7",
    "SELECT DISTINCT event_type, json_extract_string(props, '$.k') AS k FROM events",
)
def deduped_maps(t: Tables) -> DataFrame:
    """Rows holding a map, which Spark cannot compare by itself."""
    rows = t("events").select("event_type", F.from_json("props", "MAP<STRING,STRING>").alias("props"))
    return dedupe(rows).select("event_type", F.col("props")["k"].alias("k"))


@register("std_dedupe_stream", "STD-7 SRC-14", "SELECT event_id, event_type FROM events")
def deduped_stream(t: Tables) -> DataFrame:
    """Every event is delivered twice; state is bounded by the watermark."""
    landing, sink = t.scratch("landing"), t.scratch("sink")
    events = t("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.unionByName(events).write.parquet(landing)
    stream = dedupe_stream(stream_table(t.spark, landing), "ts", "31 days", ["event_id"])
    run_stream(stream, sink, t.scratch("checkpoint"))
    return t.spark.read.parquet(sink).select("event_id", "event_type")


@register(
    "std_coalesce_variants",
    "STD-8",
    """
    SELECT event_id AS bike_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'late' END AS user_type, CAST(NULL AS VARCHAR) AS birth_year
    FROM events""",
)
def variants(t: Tables) -> DataFrame:
    raw = t("events").select(
        F.when(F.expr("event_id % 2 = 0"), F.col("event_id")).alias("bikeid"),
        F.when(F.expr("event_id % 2 = 1"), F.col("event_id")).alias("bike_id"),
        F.when(F.expr("event_id % 2 = 0"), F.col("event_type")).alias("usertype"),
        F.lit("late").alias("user_type"),
    )
    spec = {"bike_id": ["bikeid", "bike_id"], "user_type": ["usertype", "user_type"], "birth_year": ["birthyear"]}
    return coalesce_variants(raw, spec, missing="null").withColumn("birth_year", F.col("birth_year").cast("string"))


@register(
    "std_cast_strings",
    "STD-9",
    "SELECT concat('', o_orderkey) AS o_orderkey, o_orderstatus, concat('', year(o_orderdate)) AS order_year FROM orders",
)
def as_strings(t: Tables) -> DataFrame:
    return cast_all_to_string(t("orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("order_year")))
