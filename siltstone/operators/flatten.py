"""Nested columns to flat ones."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from .columns import needs_text, quoted


def expand_struct(df: DataFrame, col: str, prefix: str = "", renames: dict[str, str] | None = None) -> DataFrame:
    """All other columns plus the fields of struct `col`, prefixed, or renamed where `renames` says so."""
    renames = renames or {}
    fields = df.schema[col].dataType.fieldNames()
    kept = [c for c in df.columns if c != col]
    names = [renames.get(f, prefix + f) for f in fields]
    _no_collision(kept + names)
    return df.select(*[quoted(c) for c in kept], *[quoted(col)[f].alias(n) for f, n in zip(fields, names)])


def fully_flatten(df: DataFrame, cast_strings: bool = True, arrays: str = "explode") -> DataFrame:
    """Structs become `parent_child` columns, arrays of structs `name_exploded` rows, until none is left.

    `arrays="json"` keeps arrays of structs as JSON text, so the row count does not change. With
    `cast_strings` every column ends as a string; maps and VARIANT then become JSON text.
    """
    if arrays not in ("explode", "json"):
        raise ValueError("arrays must be 'explode' or 'json'")
    while True:
        df = _expand_all_structs(df)
        nested = [f.name for f in df.schema.fields if _is_struct_array(f.dataType)]
        if not nested or arrays == "json":
            break
        # One generator per projection: Spark allows no more, and each adds its own rows.
        for name in nested:
            others = [c for c in df.columns if c != name]
            _no_collision([*others, name + "_exploded"])
            df = df.select(*[quoted(c) for c in others], F.explode_outer(quoted(name)).alias(name + "_exploded"))
    if cast_strings:
        df = df.select(*[_as_text(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
    return df


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[_as_text(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _is_struct_array(data_type: DataType) -> bool:
    return isinstance(data_type, ArrayType) and isinstance(data_type.elementType, StructType)


def _as_text(col: Column, data_type: DataType) -> Column:
    if isinstance(data_type, StringType):
        return col
    if needs_text(data_type) or isinstance(data_type, StructType) or _is_struct_array(data_type):
        return F.to_json(col)
    return col.cast("string")


def _expand_all_structs(df: DataFrame) -> DataFrame:
    if not any(isinstance(f.dataType, StructType) for f in df.schema.fields):
        return df
    columns = [pair for f in df.schema.fields for pair in _leaves(quoted(f.name), f.name, f.dataType)]
    _no_collision([name for name, _ in columns])
    return df.select(*[col.alias(name) for name, col in columns])


def _leaves(col: Column, name: str, data_type: DataType) -> Iterator[tuple[str, Column]]:
    if isinstance(data_type, StructType):
        for field in data_type.fields:
            yield from _leaves(col.getField(field.name), f"{name.replace('.', '_')}_{field.name}", field.dataType)
    else:
        yield name, col


def _no_collision(names: list[str]) -> None:
    lowered = [n.lower() for n in names]
    twice = sorted({n for n in names if lowered.count(n.lower()) > 1})
    if twice:
        raise ValueError(f"flattening gives the same column name twice: {twice}")
