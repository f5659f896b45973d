"""Column -> Column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from tallycheck.functions.text import (
    clean_text,
    composite_key,
    lenient_key,
    match_name,
    normalize_geo,
    apply_alias,
    repair_unclosed_paren,
    classify_in,
    normalize_header,
    strip_ws,
)
from tallycheck.functions.numbers import whole_number, safe_ratio, scalar_ratio, percent
from tallycheck.functions.dates import (
    parse_first,
    parse_instant,
    to_local,
    minute_bucket,
)
from tallycheck.functions.flags import parse_flag, is_active

__all__ = [
    "clean_text", "composite_key", "lenient_key", "match_name", "normalize_geo",
    "apply_alias", "repair_unclosed_paren", "classify_in", "normalize_header",
    "strip_ws", "whole_number", "safe_ratio", "scalar_ratio", "percent", "parse_first",
    "parse_instant", "to_local", "minute_bucket", "parse_flag", "is_active",
]
