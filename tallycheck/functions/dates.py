"""Date and time helpers. Everything returns TIMESTAMP_NTZ (wall-clock) values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions.text import ColumnOrName, _col, strip_ws


_FIELD = {"yyyy": r"\d{4}", "M": r"\d{1,2}", "d": r"\d{1,2}", "H": r"\d{1,2}", "m": r"\d{1,2}",
          "s": r"\d{1,2}"}


def layout_shape(fmt: str) -> str:
    """Regular expression of the texts a datetime pattern can accept (letters
    become digit runs, quoted text and separators stay literal)."""
    out, i = "^", 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            j = fmt.index("'", i + 1)
            out += re.escape(fmt[i + 1:j])
            i = j + 1
        elif ch.isalpha():
            j = i
            while j < len(fmt) and fmt[j] == ch:
                j += 1
            out += _FIELD.get(fmt[i:j], _FIELD.get(ch, r"\d+"))
            i = j
        else:
            out += re.escape(ch)
            i += 1
    return out + "$"


def parse_first(c: ColumnOrName, formats: Sequence[str] = fixed.RECEPTION_DATE_FORMATS) -> Column:
    """First layout that parses the whole text wins; none -> null. Input is not trimmed.

    Each layout is tried only on texts of its shape, so the parser is not
    asked (and made to fail) once per layout for every row. ``try_to_timestamp``
    reads the text as session-local wall time; the cast back to TIMESTAMP_NTZ
    returns that same wall time (the session runs in UTC).
    """
    col = _col(c).cast("string")
    tries = [F.when(col.rlike(layout_shape(f)), F.try_to_timestamp(col, F.lit(f))) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_instant(c: ColumnOrName, formats: Sequence[str] = fixed.INSTANT_FORMATS) -> Column:
    """Date and time text -> UTC wall time; bad text -> null.

    ISO-8601 text (with or without offset) first, then the month-first
    ``formats``. Text without an offset is UTC (the session time zone is UTC).
    A date is required: a bare time would take the day of the run."""
    text = strip_ws(_col(c).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(text))
    ts = F.coalesce(iso.cast("timestamp_ntz"), parse_first(text, formats))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts)


def to_local(c: ColumnOrName, zone: str = fixed.LOCAL_TIME_ZONE) -> Column:
    """UTC wall time -> wall time in ``zone`` (fixed offset or region id)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c).cast("timestamp_ntz"))


def minute_bucket(c: ColumnOrName) -> Column:
    """Floor to the minute, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("minute", _col(c)).cast("timestamp_ntz")
