"""Text repair for JSON payloads that went through a CSV writer, and path parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns the results depend on.
CONTROL_CHARACTERS = r"[\x00-\x1F\x7F]"
ESCAPED_NUL = "\\u0000"
BATCH_PREFIX = r"\d{4}/\d+/\d+/[\d\-]+"


def _drop_nul(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPED_NUL), F.lit("")), F.lit("\x00"), F.lit(""))


def repair_json(col: Column) -> Column:
    """Undo CSV quoting of a JSON object; text that is not quoted passes through.

    The outer quotes go only when the trimmed text starts with `"{` and ends with `}"`. A
    backslash before a quote is taken away only if the text would not parse otherwise, so
    properly escaped quotes inside values survive.
    """
    trimmed = F.trim(col)
    quoted = trimmed.startswith('"{') & trimmed.endswith('}"')
    inner = F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)
    undoubled = _drop_nul(F.replace(inner, F.lit('""'), F.lit('"')))
    escaped = undoubled.contains('\\"') & F.try_parse_json(undoubled).isNull()
    repaired = F.when(escaped, F.replace(undoubled, F.lit('\\"'), F.lit('"'))).otherwise(undoubled)
    return F.when(quoted, repaired).otherwise(_drop_nul(col))


def unquote_json(col: Column) -> Column:
    """The plain unquoting step alone: quoted objects lose quotes and doubling, others are kept."""
    quoted = col.startswith('"{') & col.endswith('}"')
    inner = F.substring(col, F.lit(2), F.length(col) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(col)


def strip_control(col: Column) -> Column:
    """Remove control characters and the six-character text `\\u0000`."""
    return F.replace(F.regexp_replace(col, CONTROL_CHARACTERS, ""), F.lit(ESCAPED_NUL), F.lit(""))


def batch_prefix(path: Column) -> Column:
    """The `yyyy/m/d/hh-mm` piece of a file path, NULL when the path has none."""
    return F.nullif(F.regexp_extract(path, BATCH_PREFIX, 0), F.lit(""))
