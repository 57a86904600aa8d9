"""Casts that give NULL instead of raising under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_cast(col: Column, data_type: str) -> Column:
    return col.try_cast(data_type)


def epoch_ts(col: Column) -> Column:
    """Epoch seconds, as a number or as text, to a timestamp."""
    return F.timestamp_seconds(col.try_cast("bigint"))


def parse_ts(col: Column, fmt: str) -> Column:
    """Text in a datetime pattern such as `M/d/yyyy HH:mm:ss` to a timestamp."""
    return F.try_to_timestamp(col, F.lit(fmt))
