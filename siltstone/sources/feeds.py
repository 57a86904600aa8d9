"""Table-driven ingestion: one bronze stream per feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.evolve import SchemaRegistry, infer_from_new_files
from ..streaming.run import run_streams
from .files import delimited_options, stream_delimited, with_batch_prefix, with_file_metadata, with_ingest_audit

PAYLOAD = "D"


@dataclass(frozen=True)
class Feed:
    name: str
    schema: StructType
    path: str
    header: bool = True
    multi_line: bool = False
    encoding: str = "UTF-8"
    hints: str | None = None

    @property
    def table(self) -> str:
        return f"bronze_{self.name.lower()}"


def text_schema(columns: str | Sequence[str]) -> StructType:
    names = columns.split() if isinstance(columns, str) else columns
    return StructType([StructField(n, StringType()) for n in names])


def feeds_of(columns: Mapping[str, str | Sequence[str]], root: str, names: Sequence[str] | None = None) -> list[Feed]:
    """Feeds by name and text columns, below a folder with one sub-folder each; `names` chooses some of them."""
    return [Feed(n, text_schema(columns[n]), f"{root}/{n}") for n in names or columns]


def has_payload(schema: StructType) -> bool:
    return PAYLOAD in schema.fieldNames()


def ingest_feeds(spark: SparkSession, feeds: Sequence[Feed], schema_location: str, at: Column | None = None) -> dict[str, DataFrame]:
    """A bronze streaming DataFrame per feed; `D_parsed` only where the feed has a payload column."""
    registry = SchemaRegistry(spark, schema_location)
    tables = {}
    for feed in feeds:
        df = stream_delimited(
            spark, feed.path, feed.schema, header=feed.header, multi_line=feed.multi_line, encoding=feed.encoding
        )
        df = with_file_metadata(df.select("*", "_metadata").withColumnRenamed("_metadata", "file_info"), "names")
        df = with_ingest_audit(with_batch_prefix(df, "fullFilePath"), at).drop("data_ingestion_ts")
        if has_payload(feed.schema):
            options = delimited_options(header=feed.header, multi_line=feed.multi_line, encoding=feed.encoding)
            reader = spark.read.schema(feed.schema).options(**options)
            payload = infer_from_new_files(reader, feed.path, "csv", PAYLOAD, registry, feed.table, feed.hints)
            df = df.withColumn("D_parsed", F.from_json(PAYLOAD, payload) if payload.fields else F.lit(None).cast("string"))
        tables[feed.table] = df
    return tables


def run_feeds(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Run every feed to completion, all at once; returns the folder of each table."""
    sinks = {name: f"{root}/tables/{name}" for name in tables}
    run_streams({name: (df, sinks[name], f"{root}/checkpoints/{name}") for name, df in tables.items()})
    return sinks
