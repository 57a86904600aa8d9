"""Small helpers several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def as_column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def computed_once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add columns that later filters read but do not recompute.

    A filter on a projected column is normally pushed below the projection with the expression
    copied into it, so a parse would run once per reference. Filters are not pushed into a
    generator, and filters on all other columns still pass it.
    """
    row = F.struct(*[col.alias(name) for name, col in columns.items()])
    return df.select(*[quoted(c) for c in (df.columns if keep is None else keep)], F.inline(F.array(row)))


def needs_text(data_type: DataType) -> bool:
    """Whether a type holds maps or VARIANT, which can be neither compared nor hashed."""
    if isinstance(data_type, (MapType, VariantType)):
        return True
    if isinstance(data_type, ArrayType):
        return needs_text(data_type.elementType)
    if isinstance(data_type, StructType):
        return any(needs_text(f.dataType) for f in data_type.fields)
    return False


def comparable(df: DataFrame, name: str) -> Column:
    """The column itself, or its JSON text where the type has no equality."""
    if not needs_text(df.schema[name].dataType):
        return quoted(name)
    return F.to_json(_sorted_maps(quoted(name), df.schema[name].dataType))


def _sorted_maps(col: Column, data_type: DataType) -> Column:
    """Maps become key-sorted arrays of entries, so equal maps give equal text."""
    if isinstance(data_type, MapType):
        entries = F.array_sort(F.transform(F.map_keys(col), lambda k: F.struct(k.alias("k"), F.to_json(
            F.struct(col[k].alias("v"))).alias("v"))))
        return entries
    if isinstance(data_type, ArrayType) and needs_text(data_type.elementType):
        return F.transform(col, lambda e: F.struct(_sorted_maps(e, data_type.elementType).alias("e")))
    if isinstance(data_type, StructType) and needs_text(data_type):
        return F.when(col.isNotNull(), F.struct(*[_sorted_maps(col[f.name], f.dataType).alias(f.name) for f in data_type.fields]))
    return col


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A 64-bit hash of a row's values, used only to order rows that tie on everything else."""
    return F.xxhash64(*[comparable(df, c) for c in (columns or df.columns)])
