"""Nested rows to one table per array of structs, and back.

A table holds the row's keys, the element's positions (one per array on the way down) and the element itself, in which every inner
array of structs is replaced by its length. Sibling arrays stand in tables of their own, so they do not multiply; lengths tell
a NULL array from an empty one and elements may be NULL, so the rows come back exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StructField, StructType

from .columns import quoted

ROOT = ""
ELEMENT = "element"
POSITIONS = "positions"


def _is_nested(data_type: DataType) -> bool:
    return isinstance(data_type, ArrayType) and isinstance(data_type.elementType, StructType)


def _arrays(struct: StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], StructType]]:
    """Paths of the arrays of structs in a struct that stand in no other array, with their element types."""
    for f in struct.fields:
        if _is_nested(f.dataType):
            yield (*path, f.name), f.dataType.elementType
        elif isinstance(f.dataType, StructType):
            yield from _arrays(f.dataType, (*path, f.name))


def _field(col: Column, path: Sequence[str]) -> Column:
    return reduce(lambda c, name: c.getField(name), path, col)


def _with_sizes(col: Column, struct: StructType) -> Column:
    """The struct with lengths in place of its arrays of structs; NULL stays NULL."""
    fields = []
    for f in struct.fields:
        value = col.getField(f.name)
        if _is_nested(f.dataType):
            value = F.when(value.isNotNull(), F.size(value))
        elif isinstance(f.dataType, StructType):
            value = _with_sizes(value, f.dataType)
        fields.append(value.alias(f.name))
    return F.when(col.isNotNull(), F.struct(*fields))


def sized(struct: StructType) -> StructType:
    """The type of `_with_sizes`."""
    kinds = [IntegerType() if _is_nested(f.dataType) else sized(f.dataType) if isinstance(f.dataType, StructType) else f.dataType for f in struct.fields]
    return StructType([StructField(f.name, kind) for f, kind in zip(struct.fields, kinds)])


def shred(df: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Tables by array path, such as `lines` or `lines.parts`; the rows themselves, with lengths, under ``.

    `keys` must identify a row. Every table reads only its own path of the source.
    """
    rest = StructType([f for f in df.schema.fields if f.name not in keys])
    if {POSITIONS, ELEMENT} & set(keys):
        raise ValueError(f"a key may not be called {POSITIONS} or {ELEMENT}")
    whole = F.struct(*[quoted(f.name) for f in rest.fields])
    tables = {ROOT: df.select(*[quoted(k) for k in keys], _with_sizes(whole, rest).alias(ELEMENT)).select(*keys, f"{ELEMENT}.*")}

    def below(rows: DataFrame, struct: StructType, path: str) -> None:
        for names, element in _arrays(struct):
            here = ".".join([path, *names]).strip(".")
            exploded = rows.select(*keys, POSITIONS, F.posexplode(_field(F.col(ELEMENT), names)).alias("__at", "__e"))
            inner = exploded.select(*keys, F.array_append(POSITIONS, F.col("__at")).alias(POSITIONS), F.col("__e").alias(ELEMENT))
            tables[here] = inner.select(*keys, POSITIONS, _with_sizes(F.col(ELEMENT), element).alias(ELEMENT))
            below(inner, element, here)

    start = F.array().cast("array<int>")
    below(df.select(*[quoted(k) for k in keys], start.alias(POSITIONS), whole.alias(ELEMENT)), rest, ROOT)
    return tables


def reassemble(tables: Mapping[str, DataFrame], schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The rows that `shred` took apart; `schema` is theirs. One shuffle per table, by key and positions."""
    rest = StructType([f for f in schema.fields if f.name not in keys])

    def filled(rows: DataFrame, struct: StructType, path: str) -> DataFrame:
        """`rows` (keys, positions, element) with the arrays of `element` put back."""
        found = list(_arrays(struct))
        lists = {}
        for number, (names, element) in enumerate(found):
            here = ".".join([path, *names]).strip(".")
            inner = filled(tables[here], element, here)
            last = F.element_at(POSITIONS, -1)
            grouped = inner.groupBy(*keys, F.slice(POSITIONS, F.lit(1), F.size(POSITIONS) - 1).alias(POSITIONS))
            # Positions are unique, so sorting never compares elements; they may be of types without order.
            listed = grouped.agg(F.collect_list(F.struct(last.alias("at"), F.col(ELEMENT).alias("e"))).alias("__l"))
            ordered = F.array_sort("__l", lambda a, b: a["at"] - b["at"])
            side = listed.select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(POSITIONS).alias("__p"), F.transform(ordered, lambda x: x["e"]).alias(f"__l{number}"))
            on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(side[f"__k{i}"]) for i, k in enumerate(keys)]) & (rows[POSITIONS] == side["__p"])
            rows = rows.join(side, on, "left").drop(*[f"__k{i}" for i in range(len(keys))], "__p")
            lists[names] = F.col(f"__l{number}")

        def rebuilt(col: Column, kind: StructType, at: tuple[str, ...]) -> Column:
            fields = []
            for f in kind.fields:
                value, here = col.getField(f.name), (*at, f.name)
                if here in lists:
                    value = F.when(value > 0, lists[here]).when(value == 0, F.array().cast(f.dataType))
                elif isinstance(f.dataType, StructType) and any(p[: len(here)] == here for p in lists):
                    value = rebuilt(value, f.dataType, here)
                fields.append(value.alias(f.name))
            return F.when(col.isNotNull(), F.struct(*fields))

        return rows.select(*keys, POSITIONS, (rebuilt(F.col(ELEMENT), struct, ()) if found else F.col(ELEMENT)).alias(ELEMENT))

    root = tables[ROOT]
    packed = root.select(*[quoted(k) for k in keys], F.array().cast("array<int>").alias(POSITIONS), F.struct(*[quoted(f.name) for f in rest.fields]).alias(ELEMENT))
    whole = filled(packed, rest, ROOT)
    return whole.select(*[quoted(f.name) if f.name in keys else F.col(ELEMENT).getField(f.name).alias(f.name) for f in schema.fields])
