"""Strict whole-number parsing and safe ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck.functions.text import ColumnOrName, _col, strip_ws

_DIGITS = r"\d+(?:_\d+)*"
_NUM_TEXT = rf"(?U)^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


def whole_number(c: ColumnOrName) -> Column:
    """Text -> BIGINT, strictly.

    Blank -> null; thousands commas removed; plain integers are cast exactly;
    decimal or exponent forms ('12.0', '1e3', digit groups '1_000') are
    accepted only when the value is whole; fractions, words, 'inf', 'nan',
    '1d' and values outside BIGINT -> null. Negative numbers are kept.

    Fast path: text without a '.' goes straight to an integer cast (which
    trims ASCII blanks and rejects anything but an optional sign and digits).
    Only the rest is trimmed of all whitespace, shape-checked and parsed. Whether
    it is whole is decided on the double, which keeps '1e-20' apart from 0; the
    value is then read as an exact decimal.
    """
    t = F.replace(_col(c).cast("string"), F.lit(","), F.lit(""))
    plain = F.when(~t.contains("."), t.try_cast("bigint"))
    u = F.replace(strip_ws(t), F.lit("_"), F.lit(""))
    whole = F.when(strip_ws(t).rlike(_NUM_TEXT), u.try_cast("double"))
    other = F.when(whole == F.floor(whole), u.try_cast("decimal(38,18)").try_cast("bigint"))
    return F.coalesce(plain, other)


def scalar_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 4) -> Column:
    """num / den rounded half-even on the exact binary value of the quotient, as
    scalar rounding does (a tie in decimal notation is seldom one in binary);
    0.0 unless the denominator is above 0. For small tables: it formats text."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    q, unit = n / d, 10.0 ** -scale
    text = F.replace(F.format_number(q, scale), F.lit(","), F.lit("")).cast("double")
    # the formatter takes the first tie, half a unit, for an exact one
    half = float(f"5e-{scale + 1}")
    above = q >= half if Decimal(half) > Decimal(f"5e-{scale + 1}") else q > half
    first = F.when(above, F.lit(unit)).otherwise(F.lit(0.0))
    return F.when(d > 0, F.when((q >= 0) & (q < unit), first).otherwise(text)).otherwise(F.lit(0.0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 4,
               positive_only: bool = False) -> Column:
    """round_half_even(num / den, scale) on decimal notation; 0.0 when the denominator is 0 or null
    (or, with ``positive_only``, not above 0)."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    ok = d > 0 if positive_only else (d.isNotNull() & (d != 0))
    return F.when(ok, F.bround(n / d, scale)).otherwise(F.lit(0.0))


def percent(rate: ColumnOrName, scale: int = 2) -> Column:
    """rate x 100, rounded half-even to ``scale`` places (from the rounded rate)."""
    return F.bround(_col(rate) * F.lit(100.0), scale)
