"""Text helpers: whitespace cleaning, keys, name and geography normalisation."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck import fixed

ColumnOrName = Column | str

# Whitespace as Python's str.strip() sees it (Unicode White_Space plus the
# information separators \x1c-\x1f), derived by rule rather than listed.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_WS = r"[\s\x1c-\x1f]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of every kind (not just spaces):
    ``btrim`` with the explicit whitespace set, no regular expression.

    Like every helper here it refers to its input once, so helpers can be
    nested without the expression tree growing multiplicatively."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_text(c: ColumnOrName) -> Column:
    """Trim all surrounding whitespace; blank or whitespace-only text becomes null."""
    return F.nullif(strip_ws(c), F.lit(""))


def composite_key(*cols: ColumnOrName, sep: str = "|") -> Column:
    """Parts joined by ``sep``; null as soon as one part is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def lenient_key(*cols: ColumnOrName, sep: str = "|") -> Column:
    """Parts joined by ``sep`` with a missing part written as the empty string."""
    return composite_key(*[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols], sep=sep)


def match_name(c: ColumnOrName) -> Column:
    """Upper case, trimmed, inner whitespace runs collapsed to one space."""
    return F.regexp_replace(strip_ws(F.upper(_col(c))), rf"(?U){_WS}+", " ")


def _map_literal(mapping: Mapping[str, str]) -> Column:
    args: list[Column] = []
    for k, v in mapping.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def normalize_geo(c: ColumnOrName, overrides: Mapping[str, str] = fixed.GEO_OVERRIDES) -> Column:
    """Geographic name for matching: null -> '', control characters and anything
    outside A-Z, 0-9 and whitespace become spaces, upper case, single spaces,
    trimmed, then the fixed override table."""
    kept = F.regexp_replace(F.upper(_col(c)), fixed.GEO_NOT_KEPT, " ")
    s = F.coalesce(strip_ws(F.regexp_replace(kept, r"(?U)\s+", " ")), F.lit(""))
    if not overrides:
        return s
    return F.coalesce(_map_literal(overrides)[s], s)


def apply_alias(c: ColumnOrName, aliases: Mapping[str, str] = fixed.GEO_ALIASES) -> Column:
    """Verified alias of upper(trim(name)) if there is one, else the name unchanged."""
    col = _col(c)
    return F.coalesce(_map_literal(aliases)[F.upper(strip_ws(col))], col)


def repair_unclosed_paren(c: ColumnOrName) -> Column:
    """Append ')' when the text after the last '(' is non-empty and has no ')'."""
    text = _col(c)
    tail = F.substring_index(text, "(", -1)
    is_open = text.contains("(") & (F.length(tail) > 0) & ~tail.contains(")")
    return F.when(is_open, F.concat(text, F.lit(")"))).otherwise(text)


def classify_in(c: ColumnOrName, codes: Iterable[str], inside: str, outside: str) -> Column:
    """``inside`` when the value is one of ``codes``; ``outside`` otherwise (null too)."""
    return F.when(_col(c).isin(*codes), F.lit(inside)).otherwise(F.lit(outside))


def normalize_header(raw: str) -> str:
    """'  party-name ' -> 'PARTY_NAME'; 'a/b' -> 'A_B': the parts between
    separators, joined by one underscore. Column names are metadata: this is
    plain Python on the driver."""
    spaced = "".join(" " if ch in fixed.HEADER_SEPARATORS else ch for ch in str(raw))
    return "_".join(spaced.upper().split())
