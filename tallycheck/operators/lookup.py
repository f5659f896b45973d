"""Lookups against reference tables: anti (orphans), semi, in-set flag and the
canonical inner join.

No join carries a hint: statistics choose the strategy when a query is planned
and AQE revises it with the sizes it meets, so building a query runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(left_on: Sequence[str], right_on: Sequence[str] | None) -> list[tuple[str, str]]:
    right_on = list(right_on) if right_on is not None else list(left_on)
    if len(right_on) != len(left_on):
        raise ValueError("left_on and right_on differ in length")
    return list(zip(left_on, right_on))


def _keys_as(df: DataFrame, pairs: list[tuple[str, str]], prefix: str) -> DataFrame:
    return df.select(*[F.col(r).alias(f"{prefix}{i}") for i, (_, r) in enumerate(pairs)])


def _cond(df: DataFrame, pairs: list[tuple[str, str]], prefix: str, null_safe: bool = False) -> Column:
    parts = []
    for i, (l, _) in enumerate(pairs):
        lc, rc = df[l], F.col(f"{prefix}{i}")
        parts.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    return reduce(lambda a, b: a & b, parts)


def orphans(df: DataFrame, parent: DataFrame, left_on: Sequence[str],
            right_on: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``parent`` (left anti join).

    A null key part on the left has no partner and is reported, as a "not in
    the set" test would. Null parent keys never match anything (unlike NOT IN)."""
    pairs = _pairs(left_on, right_on)
    keys = _keys_as(parent, pairs, "_k").distinct()
    return df.join(keys, _cond(df, pairs, "_k"), "left_anti")


def present(df: DataFrame, parent: DataFrame, left_on: Sequence[str],
            right_on: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``parent`` (left semi join)."""
    pairs = _pairs(left_on, right_on)
    keys = _keys_as(parent, pairs, "_k").distinct()
    return df.join(keys, _cond(df, pairs, "_k", null_safe), "left_semi")


def flag_in(df: DataFrame, parent: DataFrame, left_on: Sequence[str], flag: str,
            right_on: Sequence[str] | None = None) -> DataFrame:
    """Add boolean ``flag``: key found in ``parent``; never null."""
    pairs = _pairs(left_on, right_on)
    keys = _keys_as(parent, pairs, "_k").dropna().distinct().withColumn("_hit", F.lit(True))
    out = df.join(keys, _cond(df, pairs, "_k"), "left")
    return out.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop(
        "_hit", *[f"_k{i}" for i in range(len(pairs))])


def canonical_join(children: DataFrame, parents: DataFrame, key: str,
                   parent_cols: Sequence[str], prefix: str = "ER_") -> DataFrame:
    """Inner join children to their (canonical) parents; parent columns are
    brought in with ``prefix`` so nothing collides. Children of non-canonical
    parents drop out; a null key matches nothing."""
    slim = parents.select(F.col(key), *[F.col(c).alias(prefix + c) for c in parent_cols if c != key])
    return children.join(slim, key, "inner")
