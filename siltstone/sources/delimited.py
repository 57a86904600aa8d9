"""Delimited text with rescue by field.

Spark's own reader marks a whole line as malformed. Here lines are read as text and cut where a separator stands outside of
quotes, then laid beside the schema: a field that does not fit its type, and fields beyond the last column, go to
`_rescued_data` by name, and all others keep their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.columns import computed_once
from ..operators.payload import RESCUED

QUOTE = '"'


def split_fields(line: Column, sep: str) -> Column:
    """The fields of a line, quotes included; a separator between quotes ends no field."""
    pieces = F.split(line, _literal(sep))

    def add(state: Column, piece: Column) -> Column:
        field = F.when(state["open"].isNull(), piece).otherwise(F.concat(state["open"], F.lit(sep), piece))
        quotes = F.length(field) - F.length(F.replace(field, F.lit(QUOTE), F.lit("")))
        unfinished = field.startswith(QUOTE) & (quotes % 2 == 1)
        done = F.when(unfinished, state["done"]).otherwise(F.array_append(state["done"], field))
        return F.struct(done.alias("done"), F.when(unfinished, field).alias("open"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))
    # A quote that is never closed leaves the rest of the line as one field.
    return F.aggregate(pieces, start, add, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"])))


def _literal(sep: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in sep)


def field_text(field: Column) -> Column:
    """The value of a field: quotes undone, NULL if it is empty and not quoted."""
    quoted = (F.length(field) >= 2) & field.startswith(QUOTE) & field.endswith(QUOTE)
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit(QUOTE * 2), F.lit(QUOTE))
    return F.when(quoted, inner).when(field != "", field)


def rescue_fields(lines: DataFrame, schema: StructType, sep: str = "\t", line: str = "value") -> DataFrame:
    """All other columns, those of `schema`, and `_rescued_data`.

    `_rescued_data` is a JSON object of texts: unfit values by their column, surplus fields as `_c` and their number. A line with
    too few fields has NULL in the last columns.
    """
    others = [c for c in lines.columns if c != line]
    split = computed_once(lines, {"__fields": split_fields(F.col(line), sep)}, others)
    texts = computed_once(split, {"__texts": F.transform("__fields", field_text)}, others)
    typed, lost = [], []
    for at, f in enumerate(schema.fields):
        text = F.get("__texts", at)
        value = text if isinstance(f.dataType, StringType) else text.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            lost.append(F.when(text.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("key"), text.alias("value"))))
    width = len(schema.fields)
    surplus = F.transform(
        F.slice("__texts", F.lit(width + 1), F.greatest(F.size("__texts") - width, F.lit(0))),
        lambda text, at: F.struct(F.concat(F.lit("_c"), (at + width).cast("string")).alias("key"), text.alias("value")),
    )
    unfit = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<struct<key:string,value:string>>")
    found = F.concat(unfit, surplus)
    rescued = F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found)))
    return texts.select(*others, *typed, rescued.alias(RESCUED))


def stream_delimited_fields(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = "\t", header: bool = True, encoding: str = "UTF-8", **options: str
) -> DataFrame:
    """Stream delimited text by a declared schema, unfit and surplus fields rescued one by one.

    With `header`, lines that read like the header are left out, wherever a file was cut. A line break ends a row also between quotes.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.readStream.options(encoding=encoding, **options).text(path)
    if header:
        names = F.transform(split_fields(F.col("value"), sep), field_text)
        first = schema.fieldNames()[0]
        # The names are compared only on lines that begin like them.
        like = F.col("value").startswith(first) | F.col("value").startswith(QUOTE + first)
        lines = lines.where(~(like & (names == F.array(*[F.lit(n) for n in schema.fieldNames()]))))
    return rescue_fields(lines, schema, sep)
