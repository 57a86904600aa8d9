"""Clustering on several columns by a Hilbert curve.

Sorting by a list of columns serves filters on the first one only. Here every column is turned into its quantile rank, so that
skewed values spread evenly, and the ranks into a place on a Hilbert curve, which keeps rows that are close in all columns close
together. Files and row groups cut from the curve then have narrow ranges in every column, and filters on
any of them skip most of the table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from ..operators.columns import quoted, row_digest

# Ranks per column are 2 ** BITS.
BITS = 8
PLACE = "__place"
BORDERS = "_curve"


def _number(df: DataFrame, name: str) -> Column:
    """A number that grows with the column's value; of text, the first six bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(quoted(name).cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(quoted(name)).cast("double")
    if isinstance(kind, (NumericType, BooleanType)):
        return quoted(name).cast("int" if isinstance(kind, BooleanType) else "double").cast("double")
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(F.encode(quoted(name), "utf-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"cannot cluster on {name} of type {kind.simpleString()}")


def rank_borders(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Per column the 2 ** bits - 1 quantiles that part its ranks; all that comes to the driver. One aggregation."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(_number(df, c), shares, 20 * 2**bits).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: list(found[f"q{i}"] or []) for i, c in enumerate(columns)}


def _rank(number: Column, borders: Sequence[float], bits: int) -> Column:
    """How many borders are not above the number, by halving; NULL ranks first."""
    held = F.array(*[F.lit(float(b)) for b in borders])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(held, at + step - 1) <= number, step).otherwise(0))
    return F.coalesce(found, F.lit(0)) if borders else F.lit(0)


def with_place(df: DataFrame, borders: dict[str, list[float]], bits: int = BITS, name: str = PLACE) -> DataFrame:
    """Add the row's place on the curve through the ranks of the columns of `borders`.

    Each step is a projection of its own, so nothing is computed twice and all stays in generated code.
    """
    axes = [f"__x{i}" for i in range(len(borders))]
    if len(axes) * bits > 62:
        raise ValueError("too many columns or bits for a 64-bit place")
    out = df.withColumns({x: _rank(_number(df, c), held, bits) for x, (c, held) in zip(axes, borders.items())})
    x0 = F.col(axes[0])
    # From ranks to the transposed curve index: undo rotations and reflections, from the highest bit down.
    for bit in reversed(range(1, bits)):
        low = (1 << bit) - 1
        for x in axes:
            turned = F.col(x).bitwiseAND(1 << bit) != 0
            swap = x0.bitwiseXOR(F.col(x)).bitwiseAND(low)
            first = F.when(turned, x0.bitwiseXOR(low)).otherwise(x0.bitwiseXOR(swap))
            if x == axes[0]:
                out = out.withColumn(x, F.when(turned, x0.bitwiseXOR(low)).otherwise(x0))
            else:
                out = out.withColumns({axes[0]: first, x: F.when(turned, F.col(x)).otherwise(F.col(x).bitwiseXOR(swap))})
    # Gray code.
    for before, x in zip(axes, axes[1:]):
        out = out.withColumn(x, F.col(x).bitwiseXOR(F.col(before)))
    last, flip = F.col(axes[-1]), F.lit(0)
    for bit in reversed(range(1, bits)):
        flip = flip.bitwiseXOR(F.when(last.bitwiseAND(1 << bit) != 0, (1 << bit) - 1).otherwise(0))
    out = out.withColumn("__t", flip)
    out = out.withColumns({x: F.col(x).bitwiseXOR(F.col("__t")) for x in axes})
    place = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for x in axes:
            one = F.shiftright(F.col(x), bit).bitwiseAND(1).cast("long")
            place = F.shiftleft(place, 1).bitwiseOR(one)
    return out.withColumn(name, place).drop(*axes, "__t")


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int | None = None,
    mode: str = "overwrite",
    bits: int = BITS,
    partition_by: Sequence[str] = (),
    folder: str | None = None,
) -> None:
    """Write Parquet in the order of the curve through `columns`.

    The borders of ranks are kept beside the table. With `mode="append"` new rows are laid out by the same borders in files of
    their own, and no file already there is written again; with `folder`, such as `batch=7`, they replace that folder below
    the table, so a repeated micro-batch changes nothing. A row hash comes last in the range, so rows of one
    place that are too many for a file are spread.
    """
    spark = df.sparkSession
    borders = stored_borders(spark, path) if mode == "append" else None
    fresh = borders is None
    if fresh:
        borders = rank_borders(df, columns, bits)
    elif list(borders) != list(columns):
        raise ValueError(f"the table is clustered on {list(borders)}")
    placed = with_place(df, borders, bits)
    order = [*[quoted(c) for c in partition_by], F.col(PLACE), row_digest(df)]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    written = ranged.sortWithinPartitions(*order[:-1]).drop(PLACE).write.partitionBy(*partition_by)
    written.mode(mode if folder is None else "overwrite").parquet(path if folder is None else f"{path}/{folder}")
    if fresh:
        row = spark.createDataFrame([(json.dumps(borders),)], "borders string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/{BORDERS}")


def stored_borders(spark: SparkSession, path: str) -> dict[str, list[float]] | None:
    """The borders a table was written by, or None if there is no such table."""
    try:
        return json.loads(spark.read.text(f"{path}/{BORDERS}").first()[0])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
