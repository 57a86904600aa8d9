"""Schemas of JSON as rows that merge: (path, kind, n, first_seen).

What a batch of JSON holds is found level by level: every object gives its keys as paths, every array its elements. Counts and
first sightings of a (path, kind) add up over batches in any order, so rows of many batches, or of one batch in many
tasks, merge by one aggregation, and the schema is read off the merged rows. Where an object's keys are data (ids, dates)
its children share one path, so the rows stay as few as the schema has parts and the object becomes a map.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..session import shared_dir
from .columns import quoted

LATTICE = "path ARRAY<STRING>, kind STRING, n BIGINT, first_seen BIGINT"
# An object with more different keys than this is a map.
MOST_KEYS = 500
# Steps of a path besides keys, which are written with a leading dot.
ELEMENTS, VALUES = "[]", "{}"


def lattice_of(df: DataFrame, col: str, seen: Column | int = 0, known: DataFrame | None = None, most_keys: int = MOST_KEYS) -> DataFrame:
    """The rows of one batch: which kinds of values stand at which paths, how often, and the smallest `seen`.

    `known` are the rows of earlier batches; an object that is a map there stays one. Text that is no JSON counts as
    nothing. One pass per level of nesting, over the values of that level only.
    """
    shared_dir(df.sparkSession)
    seen = F.lit(seen) if isinstance(seen, int) else seen
    level = df.select(F.array().cast("array<string>").alias("path"), F.try_parse_json(quoted(col)).alias("v"), seen.cast("bigint").alias("seen")).where("v IS NOT NULL")
    maps = None if known is None else known.where(F.try_element_at("path", F.lit(-1)) == VALUES).select(F.slice("path", F.lit(1), F.size("path") - 1).alias("map_path")).distinct()
    found = None
    while True:
        typed = level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), r"^[A-Z_]+", 0))
        rows = typed.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("seen").alias("first_seen")).checkpoint()
        found = rows if found is None else found.unionByName(rows)
        if rows.where(F.col("kind").isin("OBJECT", "ARRAY")).isEmpty():
            return found
        entries = typed.where("kind = 'OBJECT'").select("path", "seen", F.explode(F.try_variant_get("v", "$", "MAP<STRING,VARIANT>")).alias("key", "v"))
        keys = entries.groupBy("path").agg(F.approx_count_distinct("key").alias("keys")).where(F.col("keys") > most_keys).select(F.col("path").alias("map_path"))
        wide = (keys if maps is None else keys.unionByName(maps).distinct()).checkpoint()
        marked = entries.join(wide, entries["path"] == wide["map_path"], "left")
        step = F.when(F.col("map_path").isNull(), F.concat(F.lit("."), "key")).otherwise(VALUES)
        below = marked.select(F.array_append("path", step).alias("path"), "v", "seen")
        elements = typed.where("kind = 'ARRAY'").select(F.array_append("path", F.lit(ELEMENTS)).alias("path"), F.explode(F.try_variant_get("v", "$", "ARRAY<VARIANT>")).alias("v"), "seen")
        level = below.unionByName(elements).checkpoint()


def merge_lattices(*parts: DataFrame) -> DataFrame:
    """The rows of several batches as one; the same whatever their order."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))


def lattice_schema(lattice: DataFrame) -> StructType:
    """The type of the objects that the rows describe; fields in order of first sighting, then of name.

    Numbers widen, an object whose keys were data in any batch is a map, and values of kinds that have no common
    type are text. Rows come to the driver, as many as the schema has parts.
    """
    kinds: dict[tuple, set] = defaultdict(set)
    first: dict[tuple, int] = {}
    children: dict[tuple, set] = defaultdict(set)
    for row in lattice.collect():
        path = tuple(row.path)
        kinds[path].add(row.kind)
        first[path] = min(first.get(path, row.first_seen), row.first_seen)
        for depth in range(len(path)):
            children[path[:depth]].add(path[: depth + 1])
            first.setdefault(path[: depth + 1], row.first_seen)

    def kind_of(paths: Sequence[tuple]) -> DataType:
        """The type of values that stand at any of these paths."""
        own = {k for p in paths for k in kinds[p]} - {"VOID"}
        below = [c for p in paths for c in children[p]]
        if own == {"OBJECT"}:
            if any(c[-1] == VALUES for c in below):
                return MapType(StringType(), kind_of(below))
            named = defaultdict(list)
            for c in below:
                named[c[-1][1:]].append(c)
            order = sorted(named, key=lambda name: (min(first[c] for c in named[name]), name))
            return StructType([StructField(name, kind_of(named[name])) for name in order])
        if own == {"ARRAY"}:
            return ArrayType(kind_of(below) if below else StringType())
        return _scalar(own)

    found = kind_of([()])
    return found if isinstance(found, StructType) else StructType([])


def _scalar(own: set[str]) -> DataType:
    if own and own <= {"BIGINT"}:
        return LongType()
    if own and own <= {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}:
        return DoubleType()
    if own == {"BOOLEAN"}:
        return BooleanType()
    if own == {"TIMESTAMP"}:
        return TimestampType()
    return StringType()


class EvolvingTable:
    """JSON micro-batches stored by the schema known when they came, and read by the newest one.

    `upsert` is the function of `foreachBatch`. It notes the batch's lattice, merges it with those of earlier batches and
    parses by the result, so keys and types that appear while a stream runs are taken up at once. A repeated batch replaces
    what it wrote.
    """

    def __init__(self, path: str, col: str, keep: Sequence[str] = (), most_keys: int = MOST_KEYS):
        self.path, self.col, self.keep, self.most_keys = path, col, list(keep), most_keys

    def lattice(self, spark, before: int | None = None) -> DataFrame:
        stored = spark.read.schema(f"{LATTICE}, batch BIGINT").option("basePath", f"{self.path}/lattice").parquet(f"{self.path}/lattice")
        return merge_lattices((stored if before is None else stored.where(F.col("batch") < before)).drop("batch"))

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = None if batch_id == 0 else self.lattice(spark, batch_id)
        rows = lattice_of(batch, self.col, batch_id, known, self.most_keys)
        merge_lattices(rows).write.mode("overwrite").parquet(f"{self.path}/lattice/batch={batch_id}")
        schema = lattice_schema(self.lattice(spark, batch_id + 1))
        parsed = batch.select(*[quoted(c) for c in self.keep], F.from_json(quoted(self.col), schema).alias("v"))
        parsed.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def read(self, spark) -> DataFrame:
        """All rows by the newest schema: `keep`, then its fields."""
        schema = lattice_schema(self.lattice(spark))
        batches = sorted(r.batch for r in spark.read.schema("batch BIGINT").option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows").select("batch").distinct().collect())
        by_schema: dict[str, list[str]] = defaultdict(list)
        for batch in batches:
            where = f"{self.path}/rows/batch={batch}"
            by_schema[spark.read.parquet(where).schema.json()].append(where)
        out = None
        for paths in by_schema.values():
            rows = spark.read.parquet(*paths)
            part = rows.select(*self.keep, _as(F.col("v"), rows.schema["v"].dataType, schema).alias("v"))
            out = part if out is None else out.unionByName(part)
        return out.select(*self.keep, "v.*")


def _as(col: Column, have: DataType, want: DataType) -> Column:
    """A value of an older schema in a newer one, which holds all that the older one does."""
    if have == want:
        return col
    if isinstance(have, StructType) and isinstance(want, StructType):
        old = {f.name: f.dataType for f in have.fields}
        fields = [(_as(col[f.name], old[f.name], f.dataType) if f.name in old else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, StructType) and isinstance(want, MapType):
        # Keys the row lacks are NULL in a struct and absent from a map.
        entries = [F.struct(F.lit(f.name).alias("key"), _as(col[f.name], f.dataType, want.valueType).alias("value")) for f in have.fields]
        return F.when(col.isNotNull(), F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())))
    if isinstance(have, MapType) and isinstance(want, MapType):
        return F.transform_values(col, lambda _, v: _as(v, have.valueType, want.valueType))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(col, lambda e: _as(e, have.elementType, want.elementType))
    if isinstance(have, (StructType, MapType, ArrayType)):
        return F.to_json(col)
    return col.cast(want)
