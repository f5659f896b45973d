"""Boolean flag parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions.text import ColumnOrName, _col, strip_ws


def parse_flag(c: ColumnOrName, true_tokens: Sequence[str] = fixed.FLAG_TRUE,
               false_tokens: Sequence[str] = fixed.FLAG_FALSE) -> Column:
    """Trimmed, lower-cased text -> true / false; anything else (blank too) -> null."""
    t = F.lower(strip_ws(_col(c).cast("string")))
    return (F.when(t.isin(*true_tokens), F.lit(True))
            .when(t.isin(*false_tokens), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def is_active(c: ColumnOrName, tokens: Sequence[str] = fixed.ACTIVE_TOKENS) -> Column:
    """upper(text) is an "active" token. Not trimmed; null -> false."""
    return F.coalesce(F.upper(_col(c)).isin(*tokens), F.lit(False))
