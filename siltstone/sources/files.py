"""File sources and sinks, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import batch_prefix
from ..operators.columns import row_digest
from ..operators.evolve import SchemaRegistry, conform, infer_from_new_files, merge_types
from ..operators.payload import RESCUED, ingest_json_quality, with_corrupt, with_rescue

FILE_MODES = ("all", "names", "source")


def stream_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = "\t",
    header: bool = True,
    multi_line: bool = False,
    encoding: str = "UTF-8",
    rescue: bool = False,
    **options: str,
) -> DataFrame:
    """Stream delimited text files by a declared schema.

    Quotes inside quoted fields are read as doubled quotes, so JSON payload columns arrive intact.
    With `rescue`, `_rescued_data` keeps the whole line where it has more or fewer fields than the
    schema or a value of the wrong type.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if rescue:
        schema = StructType([*schema.fields, StructField(RESCUED, StringType())])
        options["columnNameOfCorruptRecord"] = RESCUED
    reader = spark.readStream.schema(schema).options(**delimited_options(sep, header, multi_line, encoding))
    return reader.options(**options).csv(path)


def delimited_options(sep: str = "\t", header: bool = True, multi_line: bool = False, encoding: str = "UTF-8") -> dict[str, str]:
    return {
        "sep": sep, "header": str(header).lower(), "multiLine": str(multi_line).lower(), "encoding": encoding, "escape": '"',
    }


def stream_json(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    schema_location: str | None = None,
    key: str = "json",
    rescue: bool = True,
    corrupt: bool = False,
    hints: str | None = None,
) -> DataFrame:
    """Stream JSON-lines files by a declared schema, or by one inferred and kept in `schema_location`.

    Lines are read as text and parsed once, which is what tells rescued rows from corrupt ones.
    """
    if schema is None:
        if schema_location is None:
            raise ValueError("give a schema or a schema_location to keep the inferred one in")
        registry = SchemaRegistry(spark, schema_location)
        schema = infer_from_new_files(spark.read, path, "text", "value", registry, key, hints)
    lines = spark.readStream.text(path).select(F.col("value"), F.col("_metadata"))
    return _json_columns(lines, schema, rescue, corrupt)


def read_json(spark: SparkSession, path: str, schema: StructType, rescue: bool = True, corrupt: bool = False) -> DataFrame:
    """The batch form of `stream_json`."""
    return _json_columns(spark.read.text(path).select(F.col("value"), F.col("_metadata")), schema, rescue, corrupt)


def _json_columns(lines: DataFrame, schema: StructType, rescue: bool, corrupt: bool) -> DataFrame:
    if rescue and corrupt:
        parsed = ingest_json_quality(lines, "value", schema)
    elif corrupt:
        parsed = with_corrupt(lines, "value", schema)
    elif rescue:
        parsed = with_rescue(lines, "value", schema)
    else:
        typed = lines.select("_metadata", F.from_json("value", schema).alias("__t"))
        parsed = typed.select("_metadata", "__t.*")
    fields = [c for c in parsed.columns if c != "_metadata"]
    return parsed.select(*fields, F.col("_metadata").alias("file_info"))


def stream_parquet(spark: SparkSession, path: str, schema_location: str, key: str = "parquet", merge: bool = True) -> DataFrame:
    """Stream Parquet files; columns added by newer files join the schema kept in `schema_location`.

    Only footers of files not seen at an earlier start are opened, a bounded number of files at a time.
    """
    registry = SchemaRegistry(spark, schema_location)
    schema = registry.load(key)
    for files in registry.unseen_groups(path, key, "*.parquet"):
        paths = [r.path for r in files.select("path").collect()]
        found = spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths).schema
        schema = merge_types(schema, found) if schema is not None else found
        registry.store(key, schema)
        registry.mark_seen(files, key)
    if schema is None:
        raise ValueError(f"no Parquet files in {path} to take a schema from")
    return spark.readStream.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A headered CSV file with all columns as text."""
    return spark.read.options(header="true", escape='"', **options).csv(path)


def with_file_metadata(df: DataFrame, mode: str = "source") -> DataFrame:
    """File columns: all of them, name / path / whole struct, or path and modification time."""
    info = "file_info" if "file_info" in df.columns else "_metadata"
    kept = [c for c in df.columns if c != "file_info"]
    if mode == "all":
        return df.select(*kept, f"{info}.*")
    if mode == "names":
        return df.select(
            *kept,
            F.col(f"{info}.file_name").alias("inputFilename"),
            F.col(f"{info}.file_path").alias("fullFilePath"),
            F.col(info).alias("fileMetadata"),
        )
    if mode == "source":
        return df.select(
            *kept,
            F.col(f"{info}.file_path").alias("source_file"),
            F.col(f"{info}.file_modification_time").alias("file_modification_time"),
        )
    raise ValueError(f"mode must be one of {FILE_MODES}")


def with_batch_prefix(df: DataFrame, col: str, name: str = "bronze_prefix") -> DataFrame:
    return df.withColumn(name, batch_prefix(F.col(col)))


def with_ingest_audit(df: DataFrame, at: Column | None = None) -> DataFrame:
    """`ingestTime`, `ingestDate` and `data_ingestion_ts`, all from the same instant."""
    now = F.current_timestamp() if at is None else at
    return df.withColumns({"ingestTime": now, "ingestDate": now.cast("date"), "data_ingestion_ts": now})


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    clusters: int | None = None,
) -> None:
    """Write Parquet, laid out for later pruning.

    `partition_by` makes folders; rows are rebalanced on the partition columns first, which gives
    few files per folder yet lets Spark split a folder that holds too much. `cluster_by` range
    partitions and sorts, so row-group statistics prune; a hash of the row comes last in the range,
    so a value that most rows share is spread over several files.
    """
    if cluster_by:
        ranged = [*partition_by, *cluster_by]
        borders = [*ranged, row_digest(df)]
        df = df.repartitionByRange(clusters, *borders) if clusters else df.repartitionByRange(*borders)
        df = df.sortWithinPartitions(*ranged)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table as a stream of its rows."""
    return spark.readStream.schema(schema or spark.read.parquet(path).schema).parquet(path)


def append_by_name(df: DataFrame, path: str, schema: StructType, rescued: str | None = None) -> None:
    """Append rows to a declared table, columns matched by name and cast to the declared type.

    A value that does not fit fails the append; with `rescued`, a column of that name keeps it instead.
    """
    conform(df, schema, rescued=rescued).write.mode("append").parquet(path)
