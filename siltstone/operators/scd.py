"""Slowly changing dimensions of type 1 and 2 from a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.ordered import Timeline
from .changes import CHANGE_TYPE
from .columns import as_column, comparable, quoted, row_digest

# Names of the validity columns and the open end of an interval.
EFFECTIVE_FROM = "EffectiveFrom"
EFFECTIVE_TO = "EffectiveTo"
IS_CURRENT = "IsCurrent"
OPEN_END = "9999-12-31"

LIVE = "__live"
TIE = "__tie"


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def usable(keys: Sequence[str], sequence: Sequence[str]) -> Column:
    """TRUE for rows with no NULL in key or sequence."""
    condition = F.lit(True)
    for name in [*keys, *sequence]:
        condition = condition & quoted(name).isNotNull()
    return condition


def unusable_changes(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str]) -> DataFrame:
    """Rows no target can take: a NULL in the key or in the sequence. They belong in quarantine."""
    return changes.where(~usable(_names(keys), _names(sequence_by)))


def _prepare(changes: DataFrame, keys: list[str], sequence: list[str], delete_when, tie_break) -> DataFrame:
    wanted = usable(keys, sequence)
    if CHANGE_TYPE in changes.columns:
        wanted = wanted & (F.coalesce(quoted(CHANGE_TYPE), F.lit("")) != "update_preimage")
    live = F.lit(True) if delete_when is None else ~F.coalesce(as_column(delete_when), F.lit(False))
    # At an equal sequence a live row wins over a delete, then the larger row hash wins: the
    # outcome does not depend on arrival order.
    return changes.where(wanted).withColumns({LIVE: live, TIE: row_digest(changes, tie_break)})


def apply_scd1(
    changes: DataFrame,
    keys: str | Sequence[str],
    sequence_by: str | Sequence[str],
    delete_when: Column | str | None = None,
    except_cols: Sequence[str] = (),
    at: Column | None = None,
    deleted_flag: str | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of every key; a key whose latest change is a delete is left out.

    Spark keeps one row per key in every task before the shuffle, so a key with many changes
    costs no more than any other. With `deleted_flag`, deleted keys stay in, marked by a column of
    that name. `tie_break` names the columns whose hash decides between rows of equal sequence, by
    default all of them.
    """
    keys, sequence = _names(keys), _names(sequence_by)
    rows = _prepare(changes, keys, sequence, delete_when, tie_break)
    newest_first = [quoted(c).desc() for c in [*sequence, LIVE, TIE]]
    rank = F.row_number().over(Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*newest_first))
    latest = rows.withColumn("__rank", rank).where(F.col("__rank") == 1)
    if deleted_flag is None:
        latest = latest.where(quoted(LIVE))
    columns = [quoted(c) for c in changes.columns if c not in except_cols]
    if at is not None:
        columns.append(at.alias("processedTime"))
    if deleted_flag is not None:
        columns.append((~quoted(LIVE)).alias(deleted_flag))
    return latest.select(*columns)


def apply_scd2(
    changes: DataFrame,
    keys: str | Sequence[str],
    sequence_by: str | Sequence[str],
    delete_when: Column | str | None = None,
    except_cols: Sequence[str] = (),
    track: Sequence[str] | None = None,
    valid_from: str | None = None,
    at: Column | None = None,
    open_end: str = OPEN_END,
    hot_rows: int | None = None,
    tie_break: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Every change opens a version [EffectiveFrom, EffectiveTo) and closes the one before.

    A delete closes the open version and is not kept itself. With `track`, a row that repeats
    the tracked values of the row before it opens no version. `valid_from` is the column giving
    the interval bounds, by default the last sequence column. `tie_break` is as for type 1;
    `count_on` is a cheaper frame to look for keys with very many rows in, such as the raw feed.
    """
    keys, sequence = _names(keys), _names(sequence_by)
    start = valid_from or sequence[-1]
    rows = _prepare(changes, keys, sequence, delete_when, tie_break)
    here = F.struct(*[quoted(c) for c in sequence])
    line = Timeline.of(rows, keys, [*sequence, LIVE, TIE], hot_rows, count_on)
    # Of rows with equal sequence only the last one counts.
    line = line.with_neighbours(after={"__next": here})
    line = line.where(F.col("__next").isNull() | (F.col("__next") != here))
    if track is not None:
        state = F.struct(quoted(LIVE), *[comparable(changes, c).alias(f"t{i}") for i, c in enumerate(track)])
        line = line.with_neighbours(before={"__before": state})
        line = line.where(F.col("__before").isNull() | (F.col("__before") != state))
    line = line.with_neighbours(after={"__until": quoted(start)})
    versions = line.where(quoted(LIVE)).frame()
    columns = [quoted(c) for c in changes.columns if c not in except_cols]
    columns += validity(quoted(start), F.col("__until"), changes.schema[start].dataType.simpleString(), open_end)
    if at is not None:
        columns.append(at.alias("processedTime"))
    return versions.select(*columns)


def validity(start: Column, until: Column, data_type: str, open_end: str = OPEN_END) -> list[Column]:
    """The three validity columns; where bounds are no times, an open end is NULL."""
    last = F.lit(open_end if data_type.startswith(("timestamp", "date")) else None)
    return [
        start.alias(EFFECTIVE_FROM),
        F.coalesce(until, last.cast(data_type)).alias(EFFECTIVE_TO),
        until.isNull().alias(IS_CURRENT),
    ]


def validity_columns(df: DataFrame, start: str = "ingestTime", open_end: str = OPEN_END) -> DataFrame:
    """The append-only form: every row is open and current."""
    data_type = df.schema[start].dataType.simpleString()
    return df.select("*", *validity(quoted(start), F.lit(None), data_type, open_end))
