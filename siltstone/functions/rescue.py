"""Telling apart unparseable text from valid JSON that does not fit the declared schema.

Most rows fit their schema, so a cheap test comes first: the text that describes the VARIANT's type must
match a pattern made from the schema, which knows all keys, and the typed parse must have met no value it could not
read. Only rows that fail it are taken apart field by field.

Text is corrupt when it is not JSON. It is rescued when it parses, but holds a key the schema
lacks, a non-null value whose typed parse is NULL, or is no object at all. The schema is walked
while the plan is built, so the result is a single Column expression and no data leaves Spark.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .jsoncols import bound

VARIANT_MAP = "MAP<STRING,VARIANT>"


def corrupt_text(text: Column, parsed: Column) -> Column:
    """The text itself when it is not NULL and is not JSON, else NULL; `parsed` is `try_parse_json(text)`."""
    return F.when(parsed.isNull(), text)


def variant_map(parsed: Column) -> Column:
    """A JSON object as a map from key to VARIANT; NULL for anything else."""
    return F.try_variant_get(parsed, "$", VARIANT_MAP)


def rescued_json(text: Column, parsed: Column, raw: Column, typed: Column, schema: StructType) -> Column:
    """JSON text of everything in `text` that `typed` (its parse by `schema`) lost, else NULL.

    `parsed` is `try_parse_json(text)` and `raw` is `variant_map(parsed)`. They are read once per field, as
    is `typed`, so all should be columns that are already there rather than expressions.
    """
    no_object = raw.isNull() & parsed.isNotNull()
    return F.when(no_object, text).otherwise(F.to_json(_lost_in_struct(raw, typed, schema)))


def shape_pattern(schema: StructType) -> str | None:
    """A pattern of the type texts (`schema_of_variant`) of all objects that hold known keys only.

    None if a name needs quoting there. Values in place of objects, and objects in place of values, do not match.
    """
    inner = _object_pattern(schema)
    return None if inner is None else f"^{inner}$"


# The type of a value that is no object and holds none.
_VALUE = r"(?:ARRAY<)*(?!OBJECT|VARIANT)[A-Z0-9_]+(?:\(\d+,\d+\))?>*"


def _object_pattern(struct: StructType) -> str | None:
    fields = []
    for f in sorted(struct.fields, key=lambda f: f.name.encode()):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", f.name):
            return None
        kind, nested = _VALUE, f.dataType
        depth = 0
        while isinstance(nested, ArrayType):
            nested, depth = nested.elementType, depth + 1
        if isinstance(nested, StructType):
            inner = _object_pattern(nested)
            if inner is None:
                return None
            # NULL, an empty array, or one that holds objects.
            kind = "(?:" + "|".join(["VOID", *("ARRAY<" * d + "VOID" + ">" * d for d in range(1, depth + 1)), "ARRAY<" * depth + inner + ">" * depth]) + ")"
        fields.append(f"(?:{re.escape(f.name)}: {kind}(?:, |(?=>)))?")
    return "OBJECT<" + "".join(fields) + ">"


def _lost_in_struct(raw: Column, typed: Column, schema: StructType) -> Column:
    known = schema.fieldNames()
    unknown = F.map_filter(raw, lambda key, _: ~key.isin(known))
    entries = F.array(
        *[
            F.struct(F.lit(f.name).alias("key"), _lost_in_value(raw[f.name], typed[f.name], f.dataType).alias("value"))
            for f in schema.fields
        ]
    )
    lost = F.map_concat(unknown, F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    return bound(lost, lambda found: F.when(F.size(found) > 0, found))


def _lost_in_value(raw: Column, typed: Column, data_type: DataType) -> Column:
    whole = F.when(typed.isNull() & ~F.is_variant_null(raw), raw)
    if isinstance(data_type, StructType):
        inner = bound(
            F.try_variant_get(raw, "$", VARIANT_MAP), lambda fields: _lost_in_struct(fields, typed, data_type)
        )
        return F.coalesce(whole, F.to_variant_object(inner))
    if isinstance(data_type, ArrayType) and isinstance(data_type.elementType, StructType):
        element = data_type.elementType
        inner = F.zip_with(
            F.try_variant_get(raw, "$", f"ARRAY<{VARIANT_MAP}>"), typed, lambda r, t: _lost_in_struct(r, t, element)
        )
        some = bound(inner, lambda items: F.when(F.exists(items, lambda item: item.isNotNull()), items))
        return F.coalesce(whole, F.to_variant_object(some))
    return whole
