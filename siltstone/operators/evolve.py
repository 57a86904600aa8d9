"""Schema inference for JSON columns with a registry of what was seen before."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from ..session import shared_dir
from .columns import quoted

SEEN_COLUMNS = ["path", "length", "modificationTime"]
INTEGERS = [ByteType, ShortType, IntegerType, LongType]
DIGITS = dict(zip(INTEGERS, (3, 5, 10, 19)))
TIMES = (TimestampType, TimestampNTZType)
# Paths that are brought to the driver and read at once.
FILES_AT_ONCE = 10_000


class SchemaRegistry:
    """Merged schemas by key, one numbered text file per change, below a shared folder."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def _versions(self, key: str) -> list[tuple[int, str]]:
        try:
            stored = self.spark.read.schema("version INT, fields STRING").json(f"{self.location}/{key}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted((r.version, r.fields) for r in stored.collect())

    def text(self, key: str) -> str | None:
        """The newest text noted under `key`."""
        versions = self._versions(key)
        return versions[-1][1] if versions else None

    def set_text(self, key: str, text: str) -> None:
        """Append `text` as the newest version, unless it is the newest already."""
        if text != self.text(key):
            self._append(key, text)

    def unseen_files(self, path: str, key: str, pattern: str = "*") -> DataFrame:
        """(path, length, modificationTime) of the files not noted under `key` yet, from the listing alone.

        A file counts as seen only if name, size and time are noted, so a file that arrives late, with
        an older time or in the same second as another is looked at.
        """
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        found = listed.load(path).select(*SEEN_COLUMNS)
        try:
            noted = self.spark.read.schema(found.schema).parquet(self._seen_path(key))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return found
            raise
        return found.join(noted.select(*SEEN_COLUMNS), SEEN_COLUMNS, "left_anti")

    def unseen_groups(self, path: str, key: str, pattern: str = "*", size: int = FILES_AT_ONCE) -> Iterator[DataFrame]:
        """The unseen files, oldest first, at most `size` at a time, so that the driver never holds more paths than that.

        A group must be marked as seen before the next one is asked for; a start that ends early goes on where it was.
        """
        shared_dir(self.spark)
        files = self.unseen_files(path, key, pattern).orderBy("modificationTime", "path").checkpoint()
        held: list = []
        for row in files.toLocalIterator():
            held.append(tuple(row))
            if len(held) == size:
                yield self.spark.createDataFrame(held, files.schema)
                held = []
        if held:
            yield self.spark.createDataFrame(held, files.schema)

    def mark_seen(self, files: DataFrame, key: str) -> None:
        """Note files as looked at; one set of rows per start that found new files."""
        files.write.mode("append").parquet(self._seen_path(key))

    def _seen_path(self, key: str) -> str:
        return f"{self.location}/{key}-files"

    def load(self, key: str) -> StructType | None:
        stored = self.text(key)
        return StructType.fromJson(json.loads(stored)) if stored else None

    def store(self, key: str, schema: StructType) -> None:
        self.set_text(key, schema.json())

    def _append(self, key: str, text: str) -> None:
        versions = self._versions(key)
        version = versions[-1][0] + 1 if versions else 1
        row = self.spark.createDataFrame([(version, text)], "version INT, fields STRING")
        row.coalesce(1).write.mode("append").json(f"{self.location}/{key}")


def infer_schema(
    df: DataFrame,
    col: str,
    registry: SchemaRegistry | None = None,
    key: str | None = None,
    hints: str | None = None,
) -> StructType:
    """The schema of all JSON objects in a column, merged with what the registry holds for `key`.

    Inference is one distributed aggregation over every row. New keys add columns after the old
    ones; a type conflict widens. `hints` is DDL that overrides or adds fields.
    """
    # JSON text is an object if it begins like one; asked of the text, each row is parsed once and has no schema of its own made.
    like = F.ltrim(quoted(col), F.lit(" \t\r\n")).startswith("{")
    inferred = df.agg(F.schema_of_variant_agg(F.when(like, F.try_parse_json(quoted(col)))).alias("s")).first()["s"]
    schema = _from_variant_schema(inferred)
    if registry is not None:
        stored = registry.load(key)
        schema = merge_types(stored, schema) if stored is not None else schema
    if hints:
        hinted = StructType.fromDDL(hints)
        fixed = {f.name: f for f in hinted.fields}
        names = schema.fieldNames()
        schema = StructType(
            [fixed.get(f.name, f) for f in schema.fields] + [f for f in hinted.fields if f.name not in names]
        )
    if registry is not None:
        registry.store(key, schema)
    return schema


def infer_from_new_files(
    reader: DataFrameReader, path: str, fmt: str, col: str, registry: SchemaRegistry, key: str, hints: str | None = None
) -> StructType:
    """`infer_schema` over the files not looked at for `key` before; others are not read again."""
    schema = None
    for files in registry.unseen_groups(path, key):
        frame = reader.format(fmt).load([r.path for r in files.select("path").collect()])
        schema = infer_schema(frame, col, registry, key, hints)
        registry.mark_seen(files, key)
    if schema is None:
        schema = infer_schema(registry.spark.createDataFrame([], f"`{col}` string"), col, registry, key, hints)
    return schema


def parse_evolving(
    df: DataFrame,
    col: str,
    out: str,
    registry: SchemaRegistry | None = None,
    key: str | None = None,
    hints: str | None = None,
) -> DataFrame:
    """Add `out`, the struct parsed from JSON text by the inferred and evolved schema."""
    schema = infer_schema(df, col, registry, key, hints)
    return df.withColumn(out, F.from_json(quoted(col), schema))


def _from_variant_schema(text: str | None) -> StructType:
    """Turn `OBJECT<a: BIGINT, ...>` as reported by Spark into a StructType."""
    if not text or not text.startswith("OBJECT<"):
        return StructType([])
    # Quoted key names are matched first, so a key that reads like a type is left alone.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m.group(1) or "STRUCT<", text)
    parsed = StructType.fromDDL("root " + ddl)
    return _settled(parsed["root"].dataType)


def _settled(data_type: DataType) -> DataType:
    """Fractions become doubles, whole numbers too long for BIGINT stay decimals; undecided types become strings."""
    if isinstance(data_type, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, ArrayType):
        return ArrayType(_settled(data_type.elementType))
    if isinstance(data_type, DecimalType) and data_type.scale == 0 and data_type.precision > 18:
        return data_type
    if isinstance(data_type, (DecimalType, FloatType)):
        return DoubleType()
    if isinstance(data_type, (VariantType, NullType)):
        return StringType()
    return data_type


def merge_types(old: DataType, new: DataType) -> DataType:
    """Structs merge by field; integers, decimals, floats and times widen; anything else in conflict is STRING."""
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        later = {f.name: f.dataType for f in new.fields}
        merged = [
            StructField(f.name, merge_types(f.dataType, later[f.name]) if f.name in later else f.dataType)
            for f in old.fields
        ]
        return StructType(merged + [StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merge_types(old.elementType, new.elementType))
    if isinstance(old, MapType) and isinstance(new, MapType):
        return MapType(merge_types(old.keyType, new.keyType), merge_types(old.valueType, new.valueType))
    return _wider(old, new) or StringType()


def _wider(old: DataType, new: DataType) -> DataType | None:
    """The smallest type that holds all values of two scalar types, or None if only text does."""
    if isinstance(old, NullType) or isinstance(new, NullType):
        return new if isinstance(old, NullType) else old
    if type(old) in INTEGERS and type(new) in INTEGERS:
        return max(old, new, key=lambda t: INTEGERS.index(type(t)))
    if isinstance(old, DateType) and type(new) in TIMES or isinstance(new, DateType) and type(old) in TIMES:
        return new if isinstance(old, DateType) else old
    exact = [DecimalType(DIGITS[type(t)], 0) if type(t) in INTEGERS else t for t in (old, new)]
    if all(isinstance(t, DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact) + scale
        return DecimalType(digits, scale) if digits <= 38 else None
    if all(isinstance(t, (DecimalType, FloatType, DoubleType)) for t in exact):
        return DoubleType()
    return None


def widen(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; a column one side lacks is NULL there, and both sides get the merged type."""
    merged = merge_types(target.schema, batch.schema)
    return conform(target, merged).unionByName(conform(batch, merged))


def conform(df: DataFrame, schema: StructType, unfit: str = "raise", rescued: str | None = None) -> DataFrame:
    """Columns of `schema` by name and in its order; missing ones are NULL, the rest is cast.

    A value its declared type cannot hold fails the query, or is NULL with `unfit="null"`. With the name
    `rescued` it is NULL, and that column holds such values as JSON by column name (NULL if there are none).
    """
    lenient = unfit == "null" or rescued is not None
    lost = {}
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        if f.name not in have:
            col = F.lit(None).cast(f.dataType)
        elif have[f.name] == f.dataType:
            col = quoted(f.name)
        elif isinstance(f.dataType, StringType) and isinstance(have[f.name], (StructType, ArrayType)):
            col = F.to_json(quoted(f.name))
        else:
            col = quoted(f.name).try_cast(f.dataType) if lenient else quoted(f.name).cast(f.dataType)
            lost[f.name] = F.when(quoted(f.name).isNotNull() & quoted(f.name).try_cast(f.dataType).isNull(), quoted(f.name).cast("string"))
        columns.append(col.alias(f.name))
    if rescued is not None:
        gone = reduce(lambda a, b: a | b, [c.isNotNull() for c in lost.values()], F.lit(False))
        columns.append(F.when(gone, F.to_json(F.struct(*[c.alias(n) for n, c in lost.items()]))).alias(rescued))
    return df.select(*columns)
