from .jsoncols import (
    extra_keys,
    json_path,
    parse_map,
    parse_struct,
    parse_variant,
    project_keys,
    structure_records,
    variant_path,
)
from .rescue import corrupt_text, rescued_json, variant_map
from .text import batch_prefix, repair_json, strip_control, unquote_json
from .times import epoch_ts, parse_ts, safe_cast

__all__ = [
    "batch_prefix",
    "corrupt_text",
    "epoch_ts",
    "extra_keys",
    "json_path",
    "parse_map",
    "parse_struct",
    "parse_ts",
    "parse_variant",
    "project_keys",
    "repair_json",
    "rescued_json",
    "safe_cast",
    "strip_control",
    "structure_records",
    "unquote_json",
    "variant_map",
    "variant_path",
]
