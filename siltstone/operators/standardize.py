"""Column names, text and duplicates brought to one form."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from .columns import comparable, needs_text, quoted

# The characters the encoding step removes.
CONTROL_AND_LATIN1 = r"[\x00-\x1F\x7F-\xFF]"
CONTROL_ONLY = r"[\x00-\x1F\x7F]"
# What a charset cannot hold; the others hold everything a Spark string can.
MISSING_FROM = {"US-ASCII": r"[^\x00-\x7F]", "ISO-8859-1": r"[^\x00-\xFF]"}
FULL_CHARSETS = ["UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"]


def _replace(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """One projection with some columns replaced, in place."""
    return df.select(*[changed[c].alias(c) if c in changed else quoted(c) for c in df.columns])


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names; each run of non-word characters becomes one underscore. Raises where two become one."""
    names = [re.sub(r"\W+", "_", c.lower()) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"cleaned names are not unique: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.select(*[quoted(c).alias(n) for c, n in zip(df.columns, names)])


def trim_strings(df: DataFrame) -> DataFrame:
    return _replace(df, {c: F.trim(quoted(c)) for c in _text_columns(df)})


def lower_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _replace(df, {c: F.lower(quoted(c)) for c in cols})


def title_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _replace(df, {c: F.initcap(quoted(c)) for c in cols})


def standardize_encoding(
    df: DataFrame, charset: str = "UTF-8", strip_latin1: bool = True, null_to_empty: bool = True
) -> DataFrame:
    """Text columns limited to a charset and freed of control characters; NULL becomes the empty string.

    Characters the charset lacks become `?`. Encoding and decoding by a charset that lacks none
    changes nothing, so it is left out.
    """
    charset = charset.upper()
    if charset not in MISSING_FROM and charset not in FULL_CHARSETS:
        raise ValueError(f"charset must be one of {[*MISSING_FROM, *FULL_CHARSETS]}")
    pattern = CONTROL_AND_LATIN1 if strip_latin1 else CONTROL_ONLY

    def clean(name: str) -> Column:
        col = F.coalesce(quoted(name), F.lit("")) if null_to_empty else quoted(name)
        if charset in MISSING_FROM:
            col = F.regexp_replace(col, MISSING_FROM[charset], "?")
        return F.regexp_replace(col, pattern, "")

    return _replace(df, {c: clean(c) for c in _text_columns(df)})


def dedupe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per `cols`. Copies collapse map-side, before the shuffle.

    Maps and VARIANT have no equality, so rows holding them are compared by JSON text.
    """
    names = list(cols or df.columns)
    awkward = [c for c in names if needs_text(df.schema[c].dataType)]
    if not awkward:
        return df.dropDuplicates(names)
    helpers = {f"__same{i}": comparable(df, c) for i, c in enumerate(awkward)}
    plain = [c for c in names if c not in awkward]
    return df.withColumns(helpers).dropDuplicates([*plain, *helpers]).drop(*helpers)


def dedupe_stream(df: DataFrame, event_time: str, delay: str, cols: Sequence[str]) -> DataFrame:
    """De-duplication of a stream with bounded state: copies may arrive up to `delay` apart."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(cols))


def dedupe_stream_exact(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """De-duplication of a stream without a watermark: copies any distance apart leave the row that came first.

    State holds 128 bits per distinct row and nothing else. It grows with the distinct rows, so run the stream with
    state on disk (`streaming.keyed.with_rocksdb`), whose Bloom filters answer most look-ups without reading it.
    """
    values = [v for c in (cols or df.columns) for v in (comparable(df, c), quoted(c).isNull())]
    digests = {f"__digest{seed}": F.xxhash64(F.lit(seed), *values) for seed in (1, 2)}
    return df.withColumns(digests).dropDuplicates(list(digests)).drop(*digests)


def standardize(df: DataFrame) -> DataFrame:
    """Names, then duplicates, then trimming, then encoding."""
    return df.transform(clean_column_names).transform(dedupe).transform(trim_strings).transform(standardize_encoding)


def coalesce_variants(df: DataFrame, spec: Mapping[str, Sequence[str]], missing: str = "raise") -> DataFrame:
    """One column per target name from whichever of its name variants exist.

    A target without any variant raises, or is NULL with `missing="null"`.
    """
    have = set(df.columns)
    absent = [name for name, variants in spec.items() if not have.intersection(variants)]
    if absent and missing != "null":
        raise ValueError(f"no variant of {absent} among the columns")

    def pick(variants: Sequence[str]) -> Column:
        found = [quoted(v) for v in variants if v in have]
        return F.coalesce(*found) if found else F.lit(None)

    return df.select(*[pick(variants).alias(name) for name, variants in spec.items()])
