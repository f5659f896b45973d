"""Data-quality checks. Each returns a lazy DataFrame of *problem rows*; zero
rows means the check passes. All are parameterised by column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions.text import lenient_key
from tallycheck.operators.lookup import orphans, present


def _issue(df: DataFrame, issue: str | Column) -> DataFrame:
    return df.withColumn("QA_ISSUE", issue if isinstance(issue, Column) else F.lit(issue))


def _all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


def duplicate_rows(df: DataFrame, keys: Sequence[str], carry: Sequence[str] = (),
                   issue: str = fixed.DUPLICATE_RESULT_KEY) -> DataFrame:
    """Distinct (keys + carry) of every row whose key occurs more than once.
    Nulls in key parts compare equal, as in a "duplicated" test.

    Map-side aggregation first: a hot key collapses to one row per distinct
    (key, carry) and map task before any shuffle. Keys alone are one
    aggregate; with ``carry`` the repeated keys are semi-joined (null-safe) back
    onto the pre-aggregated rows, a join AQE can split if one key is skewed.
    """
    keys = list(keys)
    if not carry:
        return _issue(df.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys), issue)
    rows = df.groupBy(*keys, *carry).agg(F.count(F.lit(1)).alias("_n"))
    repeated = rows.groupBy(*keys).agg(F.sum("_n").alias("_t")).filter(F.col("_t") > 1)
    out = present(rows, repeated, keys, null_safe=True)
    return _issue(out.select(*keys, *carry), issue)


def duplicate_count(df: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """``n``: the number of rows that :func:`duplicate_rows` returns. Nothing is joined
    back: the rows of a key are counted while they are combined."""
    rows = df.groupBy(*keys, *carry).agg(F.count(F.lit(1)).alias("_n"))
    repeated = rows.groupBy(*keys).agg(F.sum("_n").alias("_t"), F.count(F.lit(1)).alias("_m")).filter(F.col("_t") > 1)
    return repeated.agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("n"))


def inconsistent_count(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``n``: the number of rows that :func:`inconsistent_values` returns, all fields
    counted in one aggregate: a group has more than one value of a field where the
    least and the greatest differ, so that the values needn't be listed."""
    n = range(len(fields))
    g = df.filter(_all_not_null(keys)).groupBy(*keys).agg(
        *[F.min(f).alias(f"_a{i}") for i, f in enumerate(fields)], *[F.max(f).alias(f"_z{i}") for i, f in enumerate(fields)])
    return g.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, [
        F.coalesce((F.col(f"_a{i}") != F.col(f"_z{i}")).cast("int"), F.lit(0)) for i in n])), F.lit(0)).alias("n"))


def missing_from(df: DataFrame, parent: DataFrame, left_on: Sequence[str], right_on: Sequence[str] | None,
                 select: Sequence[str], issue: str, distinct: bool = True) -> DataFrame:
    """Rows whose key is not found in ``parent`` (null keys count as not found).

    With ``distinct``, the distinct keys are looked up: rows are combined by key before
    anything is joined, so that a hot key is one row a task. Where other columns
    are selected too, the rows of the keys not found are taken after that."""
    left_on, select = list(left_on), list(select)
    if not distinct:
        return _issue(orphans(df, parent, left_on, right_on).select(*select), issue)
    missing = orphans(df.select(*left_on).distinct(), parent, left_on, right_on)
    if set(select) != set(left_on):
        missing = present(df, missing, left_on, null_safe=True).select(*select).distinct()
    return _issue(missing.select(*select), issue)


def inconsistent_values(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Groups (null keys left out) where a field that should repeat carries more
    than one distinct non-null value, one row per group and field."""
    g = value_counts(df.filter(_all_not_null(keys)), keys, fields)
    rows = F.array(*[F.struct(F.col(f"_n{i}").alias("DISTINCT_COUNT"), F.lit(f).alias("FIELD_CHECKED"))
                     for i, f in enumerate(fields)])
    t = g.select(*keys, F.inline(rows)).filter(F.col("DISTINCT_COUNT") > 1)
    return t.select(*keys, "DISTINCT_COUNT",
                    F.concat(F.lit(fixed.INCONSISTENT_PREFIX), F.col("FIELD_CHECKED")).alias("QA_ISSUE"),
                    "FIELD_CHECKED")


def value_counts(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per group: ``_n0``, ``_n1``, ... distinct non-null values of each field and
    ``_v0``, ``_v1``, ... the value where there is just one.

    The input is read once. What repeats is combined before it is shuffled, which
    leaves one row of most groups; then each field's values are listed once, dealt
    out by value, so that a hot group isn't one task, and counted by group."""
    n, keys = range(len(fields)), list(keys)
    once = df.groupBy(*keys, *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)]).agg(F.lit(1).alias("_one"))
    if len(fields) == 1:  # listed already
        values = once.withColumnRenamed("_f0", "_x0")
        counted = values.groupBy(*keys).agg(F.count("_x0").alias("_n0"), F.min("_x0").alias("_v0"))
        return counted.withColumn("_v0", F.when(F.col("_n0") == 1, F.col("_v0")))
    own = lambda i: F.struct(*[F.when(F.lit(i == j), F.col(f"_f{j}")).alias(f"_x{j}") for j in n])
    values = once.select(*keys, F.inline(F.array(*map(own, n)))).groupBy(*keys, *[f"_x{i}" for i in n]).agg(F.lit(1).alias("_one"))
    counted = values.groupBy(*keys).agg(*[F.count(f"_x{i}").alias(f"_n{i}") for i in n], *[F.min(f"_x{i}").alias(f"_v{i}") for i in n])
    return counted.withColumns({f"_v{i}": F.when(F.col(f"_n{i}") == 1, F.col(f"_v{i}")) for i in n})


def invalid_values(df: DataFrame, carry: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per (row, field) where the field is null or negative. The bad
    value sits in the field's own column; the others are null. One scan."""
    bad = {f: F.col(f).isNull() | (F.col(f) < 0) for f in fields}
    hit = df.filter(reduce(lambda a, b: a | b, bad.values()))
    flags = F.array(*[F.struct(F.lit(f).alias("FIELD_CHECKED"), bad[f].alias("_bad")) for f in fields])
    t = hit.select(*carry, *fields, F.inline(flags)).filter(F.col("_bad"))
    return t.select(*carry,
                    *[F.when(F.col("FIELD_CHECKED") == f, F.col(f)).alias(f) for f in fields],
                    F.concat(F.lit(fixed.INVALID_PREFIX), F.col("FIELD_CHECKED")).alias("QA_ISSUE"),
                    "FIELD_CHECKED")


def null_or_negative(df: DataFrame, select: Sequence[str], field: str, issue: str) -> DataFrame:
    """Rows whose ``field`` is null or below zero."""
    return _issue(df.filter(F.col(field).isNull() | (F.col(field) < 0)).select(*select), issue)


def rows_where(df: DataFrame, predicate: Column, select: Sequence[str] | None, issue: str) -> DataFrame:
    """Rows matching ``predicate`` (e.g. a null id), optionally projected."""
    out = df.filter(predicate)
    return _issue(out.select(*select) if select is not None else out, issue)


def required_blanks(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Every null in a required column: (DATASET, COLUMN, ROW_KEY, QA_ISSUE).

    ``tables`` maps a dataset name to (frame, required columns, key columns);
    ROW_KEY is the row's key columns joined by '|' (nulls written as '').
    Required columns absent from a frame are skipped."""
    parts = []
    for name, (df, required, key_cols) in tables.items():
        req = [c for c in required if c in df.columns]
        if not req:
            continue
        hit = df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in req]))
        flags = F.array(*[F.struct(F.lit(c).alias("COLUMN"), F.col(c).isNull().alias("_null")) for c in req])
        t = hit.select(lenient_key(*key_cols).alias("ROW_KEY"), F.inline(flags)).filter(F.col("_null"))
        parts.append(t.select(F.lit(name).alias("DATASET"), "COLUMN", "ROW_KEY",
                              F.lit(fixed.REQUIRED_VALUE_BLANK).alias("QA_ISSUE")))
    if not parts:
        raise ValueError("no table has a required column to check")
    return reduce(lambda a, b: a.unionByName(b), parts)


def rule_counts(df: DataFrame, source: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """(SOURCE, QA_ISSUE, COUNT) for each rule that matches at least one row.
    All rules are counted in one pass (one ``count_if`` each)."""
    one = df.agg(*[F.count_if(p).alias(f"_r{i}") for i, (_, p) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(source).alias("SOURCE"), F.lit(label).alias("QA_ISSUE"),
                              F.col(f"_r{i}").alias("COUNT")) for i, (label, _) in enumerate(rules)])
    return one.select(F.inline(rows)).filter(F.col("COUNT") > 0)


def count_above(df: DataFrame, key: str, counted: str, count_name: str, issue: str,
                threshold: int = 1) -> DataFrame:
    """Groups (null key left out) with more than ``threshold`` non-null ``counted``."""
    g = (df.filter(F.col(key).isNotNull()).groupBy(key)
         .agg(F.count(counted).alias(count_name)).filter(F.col(count_name) > threshold))
    return _issue(g, issue)


def scope_readiness(scope: DataFrame, scope_key: str, contests: DataFrame, contest_key: str,
                    ballot_map: DataFrame, map_key: str, require_scope: bool) -> DataFrame:
    """Scope is populated (when required), every scope contest is known and has
    a ballot map. A contest can fail both. Output (QA_ISSUE, CONTEST_CODE)."""
    codes = scope.select(F.col(scope_key).alias("CONTEST_CODE")).filter(F.col("CONTEST_CODE").isNotNull())
    unknown = orphans(codes, contests, ["CONTEST_CODE"], [contest_key])
    no_map = orphans(codes, ballot_map, ["CONTEST_CODE"], [map_key])
    out = (unknown.select(F.lit(fixed.SCOPE_CONTEST_UNKNOWN_IN_MASTER).alias("QA_ISSUE"), "CONTEST_CODE")
           .unionByName(no_map.select(F.lit(fixed.SCOPE_CONTEST_HAS_NO_BALLOT_MAP).alias("QA_ISSUE"),
                                      "CONTEST_CODE")))
    if require_scope:
        spark = SparkSession.getActiveSession() or scope.sparkSession
        empty = scope.agg(F.count(F.lit(1))).scalar() == 0
        missing = (spark.range(1).filter(empty)
                   .select(F.lit(fixed.PRODUCTION_SCOPE_MISSING).alias("QA_ISSUE"),
                           F.lit(None).cast("string").alias("CONTEST_CODE")))
        out = missing.unionByName(out)
    return out


def unmapped_choices(qr_side: DataFrame, valid: str, select: Sequence[str]) -> DataFrame:
    """Distinct rows whose mapping flag is not true (null counts as not valid)."""
    bad = qr_side.filter(~F.coalesce(F.col(valid), F.lit(False)))
    return _issue(bad.select(*select).distinct(), fixed.QR_BALLOT_CHOICE_UNMAPPED)


def outside_scope(qr_side: DataFrame, valid: str, contest: str, scope: DataFrame, scope_key: str) -> DataFrame:
    """Distinct contests of valid rows that are not in the scope. Nothing is
    reported when the scope is empty."""
    scope_rows = scope.agg(F.count(F.lit(1))).scalar()
    valid_rows = qr_side.filter(F.coalesce(F.col(valid), F.lit(False))).select(contest)
    out = orphans(valid_rows, scope, [contest], [scope_key])
    return _issue(out.filter(scope_rows > 0).distinct(), fixed.MAPPED_QR_CONTEST_OUTSIDE_SCOPE)
