"""Column builders over JSON text, maps and VARIANT."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from .times import epoch_ts

STRING_MAP = "MAP<STRING,STRING>"


def parse_struct(col: Column, schema: str | StructType) -> Column:
    return F.from_json(col, schema)


def parse_map(col: Column) -> Column:
    """JSON object to a string map; nested values stay JSON text."""
    return F.from_json(col, STRING_MAP)


def parse_variant(col: Column) -> Column:
    return F.try_parse_json(col)


def variant_path(col: Column, path: str, data_type: str) -> Column:
    """`v:a.b::TYPE` access; a value that does not fit the type is NULL."""
    return F.try_variant_get(col, "$." + path, data_type)


def json_path(col: Column, path: str) -> Column:
    """Path access on a JSON text column."""
    return F.get_json_object(col, "$." + path)


def extra_keys(map_col: Column, known: Iterable[str]) -> Column:
    """The entries of a map whose keys are not in `known`."""
    known = list(known)
    return F.map_filter(map_col, lambda key, _: ~key.isin(known))


def project_keys(map_col: Column, spec: dict[str, tuple[str, str]]) -> list[Column]:
    """Typed columns for known keys: `{output: (key, type)}`; type `epoch` is epoch seconds."""
    columns = []
    for name, (key, data_type) in spec.items():
        value = map_col[key]
        if data_type == "epoch":
            value = epoch_ts(value)
        elif data_type.lower() != "string":
            value = value.try_cast(data_type)
        columns.append(value.alias(name))
    return columns


# The keys a record element is known to have, and the declared shape of its options.
RECORD_KEYS = ["id", "name", "optionData", "priority", "type"]
OPTIONS = "STRUCT<checkBoxes: ARRAY<STRING>, data: STRING, fixedText: STRING>"


def structure_records(col: Column) -> Column:
    """JSON array text of records to an array of typed structs; absent or malformed gives an empty array.

    The text is parsed once, to maps of texts; of an element only its options are parsed further.
    """

    def record(entry: Column) -> Column:
        def with_options(options: Column) -> Column:
            return F.struct(
                entry["id"].alias("record_id"),
                entry["name"].alias("record_name"),
                F.coalesce(options["checkBoxes"], F.array().cast("array<string>")).alias("option_checkBoxes"),
                options["data"].alias("option_data"),
                options["fixedText"].try_cast("boolean").alias("option_fixedText"),
                entry["priority"].try_cast("int").alias("priority"),
                entry["type"].alias("type"),
                extra_keys(entry, RECORD_KEYS).alias("record_extra"),
            )

        return bound(F.when(entry["optionData"].isNotNull(), F.from_json(entry["optionData"], OPTIONS)), with_options)

    entries = F.coalesce(F.from_json(col, "ARRAY<MAP<STRING,STRING>>"), F.array().cast("array<map<string,string>>"))
    return F.transform(entries, record)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` reads it."""
    return F.transform(F.array(value), use)[0]
