"""Dashboard rollups over a reconciliation result and the expected universe.

All of them are single-pass aggregates: conditional counts (``count_if``) in one
``groupBy`` instead of one pass per status, fixed-row tables produced with
``inline`` from a one-row aggregate (no literal table, no cross join), and
global numbers attached as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions.dates import minute_bucket, to_local
from tallycheck.functions.numbers import percent, safe_ratio, scalar_ratio
from tallycheck.operators.checks import value_counts
from tallycheck.operators.reconcile import status_sort

ENTITY = "CLUSTERED_PRECINCT_ID"


def _in_scope(comparison: DataFrame, scope_flag: str) -> DataFrame:
    return comparison.filter(F.col(scope_flag) == F.lit(True))


def reporting_by_entity(universe: DataFrame, facts: DataFrame, *, universe_key: str,
                        fact_key: str, contest: str, received: str,
                        crosswalk: DataFrame | None = None,
                        crosswalk_cols: Sequence[str] = ("CLUSTER_ID", "DISTRICT_CODE", "DISTRICT_NAME"),
                        environment: str = fixed.PRODUCTION) -> DataFrame:
    """One row per expected entity (unreported ones included) with result row
    count, distinct contests, first and last reception, reporting flags."""
    agg = (facts.filter(F.col(fact_key).isNotNull())
           .groupBy(F.col(fact_key).alias(universe_key))
           .agg(F.count(F.lit(1)).alias("RESULT_ROW_COUNT"),
                F.count_distinct(contest).alias("DISTINCT_CONTEST_COUNT"),
                F.min(received).alias("FIRST_RECEPTION_DATETIME"),
                F.max(received).alias("LAST_RECEPTION_DATETIME")))
    df = universe.join(agg, universe_key, "left")
    extra: list[str] = []
    if crosswalk is not None:
        cid, *rest = crosswalk_cols
        xw = crosswalk.select(F.col(cid).alias(universe_key), *rest).distinct()
        df = df.join(xw, universe_key, "left")
        extra = list(rest)
    reported = F.col("RESULT_ROW_COUNT").isNotNull()
    df = df.withColumns({
        "IS_REPORTED": reported,
        "REPORTING_STATUS": F.when(reported, F.lit(fixed.REPORTED)).otherwise(F.lit(fixed.NOT_REPORTED)),
        "EXPECTED_PRECINCT_COUNT": F.lit(1),
        "REPORTED_PRECINCT_COUNT": reported.cast("int"),
        "UNREPORTED_PRECINCT_COUNT": (~reported).cast("int"),
        "RECORD_SCOPE": F.lit(fixed.SCOPE_REPORTING),
        "ENVIRONMENT": F.lit(environment),
    })
    base = [c for c in universe.columns]
    out = [F.col(c).alias(ENTITY) if c == universe_key else F.col(c) for c in base]
    return df.select(*out, "RESULT_ROW_COUNT", "DISTINCT_CONTEST_COUNT",
                     "FIRST_RECEPTION_DATETIME", "LAST_RECEPTION_DATETIME", *extra,
                     "IS_REPORTED", "REPORTING_STATUS", "EXPECTED_PRECINCT_COUNT",
                     "REPORTED_PRECINCT_COUNT", "UNREPORTED_PRECINCT_COUNT",
                     "RECORD_SCOPE", "ENVIRONMENT")


def status_summary(comparison: DataFrame, scope_flag: str = "IS_QR_VERIFICATION_SCOPE",
                   environment: str = fixed.PRODUCTION, reference_rates: bool = False) -> DataFrame:
    """Always four rows (one per status, sort 1..4) over the in-scope rows,
    with in-scope totals repeated on each row and the rates derived from them.

    ``reference_rates=True`` reproduces the reference's published output, where
    the per-status rates (overall, match, mismatch and their percents) always
    come out as 0.0; the default computes the rates it documents."""
    s = _in_scope(comparison, scope_flag)
    csv, qr = F.col("CSV_EXISTS"), F.col("QR_EXISTS")
    status = F.col("COMPARISON_STATUS")
    one = s.agg(
        F.count(F.lit(1)).alias("TOTAL_COMPARISON_ROWS"),
        F.count_if(csv).alias("TOTAL_CSV_ROWS"),
        F.count_if(qr).alias("TOTAL_QR_ROWS"),
        F.count_if(csv & qr).alias("TOTAL_BOTH_PRESENT"),
        *[F.count_if(status == st).alias(f"_n{i}") for i, st in enumerate(fixed.STATUSES)],
    )
    rows = F.array(*[F.struct(F.lit(st).alias("COMPARISON_STATUS"),
                              F.lit(i + 1).alias("STATUS_SORT"),
                              F.col(f"_n{i}").alias("STATUS_COUNT"))
                     for i, st in enumerate(fixed.STATUSES)])
    t = one.select("*", F.inline(rows))
    n, both = F.col("STATUS_COUNT"), F.col("TOTAL_BOTH_PRESENT")
    t = t.withColumns({
        "TOTAL_IN_SCOPE_CSV": F.col("TOTAL_CSV_ROWS"),
        "OVERALL_STATUS_RATE": scalar_ratio(n, "TOTAL_COMPARISON_ROWS"),
        "MATCH_RATE": scalar_ratio(F.when(F.col("COMPARISON_STATUS") == fixed.MATCHED, n).otherwise(0),
                                 both),
        "MISMATCH_RATE": scalar_ratio(F.when(F.col("COMPARISON_STATUS") == fixed.MISMATCH, n).otherwise(0),
                                    both),
        "QR_WITH_CSV_RATE": scalar_ratio(both, "TOTAL_QR_ROWS"),
        "CSV_WITH_QR_RATE": scalar_ratio(both, "TOTAL_CSV_ROWS"),
    })
    if reference_rates:
        t = t.withColumns({c: F.lit(0.0) for c in ("OVERALL_STATUS_RATE", "MATCH_RATE", "MISMATCH_RATE")})
    t = t.withColumns({
        "OVERALL_STATUS_PCT": percent("OVERALL_STATUS_RATE"),
        "MATCH_PCT": percent("MATCH_RATE"),
        "MISMATCH_PCT": percent("MISMATCH_RATE"),
        "RECORD_SCOPE": F.lit(fixed.SCOPE_STATUS_SUMMARY),
        "ENVIRONMENT": F.lit(environment),
    })
    return t.select("COMPARISON_STATUS", "STATUS_SORT", "STATUS_COUNT", "TOTAL_COMPARISON_ROWS",
                    "TOTAL_CSV_ROWS", "TOTAL_IN_SCOPE_CSV", "TOTAL_QR_ROWS", "TOTAL_BOTH_PRESENT",
                    "OVERALL_STATUS_RATE", "MATCH_RATE", "MISMATCH_RATE", "QR_WITH_CSV_RATE",
                    "CSV_WITH_QR_RATE", "OVERALL_STATUS_PCT", "MATCH_PCT", "MISMATCH_PCT",
                    "RECORD_SCOPE", "ENVIRONMENT")


def status_counts(comparison: DataFrame) -> DataFrame:
    """Rows per COMPARISON_STATUS, in status order."""
    return (comparison.groupBy("COMPARISON_STATUS").agg(F.count(F.lit(1)).alias("ROW_COUNT"))
            .orderBy(F.col("COMPARISON_STATUS").asc_nulls_last()))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(TABLE_NAME, ROW_COUNT) of every table, all counted in one job (a union
    of one-row aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("ROW_COUNT")).select(F.lit(name).alias("TABLE_NAME"), "ROW_COUNT")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _precinct_status() -> Column:
    has_csv, has_qr = F.col("HAS_CSV"), F.col("HAS_QR")
    problem = ((F.col("MISMATCH_ROW_COUNT") > 0) | (F.col("CSV_ONLY_ROW_COUNT") > 0)
               | (F.col("QR_ONLY_ROW_COUNT") > 0))
    return (F.when(has_csv & ~has_qr, F.lit(fixed.CSV_ONLY))
            .when(has_qr & ~has_csv, F.lit(fixed.QR_ONLY))
            .when(has_csv & has_qr & problem, F.lit(fixed.MISMATCH))
            .when(has_csv & has_qr, F.lit(fixed.MATCHED))
            .otherwise(F.lit(fixed.CSV_ONLY)))


def entity_status(comparison: DataFrame, entity: str = ENTITY,
                  scope_flag: str = "IS_QR_VERIFICATION_SCOPE",
                  environment: str = fixed.PRODUCTION) -> DataFrame:
    """One row per entity (in-scope rows only): presence and status counts,
    total / max absolute difference, the entity's status and its rates."""
    s = _in_scope(comparison, scope_flag).filter(F.col(entity).isNotNull())
    csv, qr, status = F.col("CSV_EXISTS"), F.col("QR_EXISTS"), F.col("COMPARISON_STATUS")
    diff = F.abs(F.col("VOTE_DIFFERENCE"))
    g = s.groupBy(entity).agg(
        F.count_if(csv).alias("CSV_ROW_COUNT"),
        F.count_if(qr).alias("QR_ROW_COUNT"),
        F.count_if(csv & qr).alias("BOTH_PRESENT_COUNT"),
        F.count_if(F.col("IS_MATCHED")).alias("MATCHED_ROW_COUNT"),
        F.count_if(F.col("IS_MISMATCH")).alias("MISMATCH_ROW_COUNT"),
        F.count_if(status == fixed.CSV_ONLY).alias("CSV_ONLY_ROW_COUNT"),
        F.count_if(status == fixed.QR_ONLY).alias("QR_ONLY_ROW_COUNT"),
        F.coalesce(F.sum(diff), F.lit(0)).cast("bigint").alias("TOTAL_ABS_VOTE_DIFF"),
        F.max(diff).cast("bigint").alias("MAX_ABS_VOTE_DIFF"),
    )
    g = g.withColumns({"HAS_CSV": F.col("CSV_ROW_COUNT") > 0, "HAS_QR": F.col("QR_ROW_COUNT") > 0})
    g = g.withColumn("PRECINCT_STATUS", _precinct_status())
    both = F.col("BOTH_PRESENT_COUNT")
    return g.withColumns({
        "STATUS_SORT": status_sort(F.col("PRECINCT_STATUS")),
        "MATCH_RATE": safe_ratio("MATCHED_ROW_COUNT", both),
        "MISMATCH_RATE": safe_ratio("MISMATCH_ROW_COUNT", both),
        "QR_FOUND_IN_CSV_RATE": safe_ratio(both, "QR_ROW_COUNT"),
        "CSV_COVERED_BY_QR_RATE": safe_ratio(both, "CSV_ROW_COUNT"),
        "RECORD_SCOPE": F.lit(fixed.SCOPE_BY_PRECINCT),
        "ENVIRONMENT": F.lit(environment),
    })


def kpi_summary(universe: DataFrame, universe_key: str, canonical: DataFrame, canonical_key: str,
                by_entity: DataFrame, environment: str = fixed.PRODUCTION) -> DataFrame:
    """Four rows (one per entity status) with three separate denominators:
    expected entities, scanned entities, comparable entities (both sides)."""
    expected = universe.agg(F.count_distinct(universe_key)).scalar()
    scanned = canonical.agg(F.count_distinct(canonical_key)).scalar()
    st = F.col("PRECINCT_STATUS")
    one = by_entity.agg(
        F.count(F.lit(1)).alias("TOTAL_VERIFICATION_PRECINCTS"),
        F.count_if(F.col("HAS_CSV") & F.col("HAS_QR")).alias("TOTAL_COMPARABLE_PRECINCTS"),
        *[F.count_if(st == s).alias(f"_n{i}") for i, s in enumerate(fixed.STATUSES)],
    ).select("*", expected.alias("TOTAL_PRECINCTS"), scanned.alias("TOTAL_SCANNED_PRECINCTS"))
    rows = F.array(*[F.struct(F.lit(s).alias("VERIFICATION_STATUS"), F.lit(i + 1).alias("STATUS_SORT"),
                              F.col(f"_n{i}").alias("PRECINCT_COUNT"))
                     for i, s in enumerate(fixed.STATUSES)])
    t = one.select("*", F.inline(rows))
    comparable = F.col("TOTAL_COMPARABLE_PRECINCTS")
    rate = scalar_ratio("PRECINCT_COUNT", comparable)
    cov = scalar_ratio("TOTAL_SCANNED_PRECINCTS", "TOTAL_PRECINCTS")
    t = t.withColumns({
        "UNSEEN_PRECINCT_COUNT": F.when(F.col("TOTAL_VERIFICATION_PRECINCTS") > 0,
                                        F.col("TOTAL_PRECINCTS") - F.col("TOTAL_SCANNED_PRECINCTS"))
                                  .otherwise(F.col("TOTAL_PRECINCTS")),
        "QR_COVERAGE_RATE": cov,
        "QR_COVERAGE_PCT": percent(cov),
        "MATCH_RATE": F.when(F.col("VERIFICATION_STATUS") == fixed.MATCHED, rate),
        "MISMATCH_RATE": F.when(F.col("VERIFICATION_STATUS") == fixed.MISMATCH, rate),
        "RECORD_SCOPE": F.lit(fixed.SCOPE_KPI),
        "ENVIRONMENT": F.lit(environment),
    })
    return t.select("VERIFICATION_STATUS", "STATUS_SORT", "PRECINCT_COUNT", "TOTAL_PRECINCTS",
                    "TOTAL_VERIFICATION_PRECINCTS", "UNSEEN_PRECINCT_COUNT", "TOTAL_SCANNED_PRECINCTS",
                    "TOTAL_COMPARABLE_PRECINCTS", "QR_COVERAGE_RATE", "QR_COVERAGE_PCT", "MATCH_RATE",
                    "MISMATCH_RATE", "RECORD_SCOPE", "ENVIRONMENT")


def minute_counts(first: DataFrame, local: str) -> DataFrame:
    """Entities per minute of their (only) local receipt time ``local``."""
    return first.groupBy(minute_bucket(local).alias("TIME_BUCKET")).agg(F.count(F.lit(1)).alias("QR_RECEIVED_COUNT"))


def timeline_of_minutes(minutes: DataFrame, *, universe: DataFrame, universe_key: str,
                        environment: str = fixed.PRODUCTION, refresh_timestamp: bool = True) -> DataFrame:
    """The coverage timeline of minute counts (TIME_BUCKET, QR_RECEIVED_COUNT).

    The running numbers are computed per local day (a window partitioned by
    date) plus the totals of the earlier days (a window over one row per day),
    so no single task ever holds more than one day of minute buckets.
    """
    per_min = minutes.select("TIME_BUCKET", "QR_RECEIVED_COUNT", F.to_date("TIME_BUCKET").alias("RECEIVED_DATE"),
                             F.hour("TIME_BUCKET").alias("RECEIVED_HOUR"))
    days = per_min.groupBy("RECEIVED_DATE").agg(F.sum("QR_RECEIVED_COUNT").alias("_day_n"),
                                                F.count(F.lit(1)).alias("_day_b"))
    before = Window.orderBy("RECEIVED_DATE").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("RECEIVED_DATE",
                       F.coalesce(F.sum("_day_n").over(before), F.lit(0)).alias("_prior_n"),
                       F.coalesce(F.sum("_day_b").over(before), F.lit(0)).alias("_prior_b"))
    in_day = Window.partitionBy("RECEIVED_DATE").orderBy("TIME_BUCKET")
    running = in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = per_min.join(days, "RECEIVED_DATE")
    expected = universe.agg(F.count_distinct(universe_key)).scalar()
    t = t.withColumns({
        "CUMULATIVE_QR_RECEIVED": (F.col("_prior_n") + F.sum("QR_RECEIVED_COUNT").over(running)).cast("bigint"),
        "TIMELINE_INDEX": (F.col("_prior_b") + F.row_number().over(in_day)).cast("bigint"),
        "TOTAL_EXPECTED_PRECINCTS": expected,
    })
    cov = safe_ratio("CUMULATIVE_QR_RECEIVED", "TOTAL_EXPECTED_PRECINCTS")
    t = t.withColumns({"QR_COVERAGE_RATE": cov, "QR_COVERAGE_PCT": percent(cov)})
    cols = ["TIME_BUCKET", "QR_RECEIVED_COUNT", "RECEIVED_DATE", "RECEIVED_HOUR",
            "CUMULATIVE_QR_RECEIVED", "TOTAL_EXPECTED_PRECINCTS", "QR_COVERAGE_RATE",
            "QR_COVERAGE_PCT", "TIMELINE_INDEX"]
    extra = {"RECORD_SCOPE": F.lit(fixed.SCOPE_TIMELINE), "ENVIRONMENT": F.lit(environment)}
    if refresh_timestamp:
        extra = {"REFRESH_TIMESTAMP_UTC": F.current_timestamp(), **extra}
    return t.withColumns(extra).select(*cols, *extra.keys())


def timeline(canonical: DataFrame, *, entity: str, received: str, universe: DataFrame,
             universe_key: str, zone: str = fixed.LOCAL_TIME_ZONE,
             environment: str = fixed.PRODUCTION, refresh_timestamp: bool = True) -> DataFrame:
    """Coverage over time: first receipt per entity (local time), counted per
    minute, with the running total and 1-based index in minute order."""
    first = (canonical.filter(F.col(entity).isNotNull() & F.col(received).isNotNull())
             .groupBy(entity).agg(F.min(to_local(received, zone)).alias("_first")))
    return timeline_of_minutes(minute_counts(first, "_first"), universe=universe, universe_key=universe_key,
                               environment=environment, refresh_timestamp=refresh_timestamp)


def safe_singles(df: DataFrame, keys: Sequence[str], fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per group: number of distinct non-null values of each field, and the value
    itself only when there is exactly one (repeated totals must not be summed).

    ``fields`` maps a column to (distinct-count name, safe-value name)."""
    g = df.filter(F.lit(True) if not keys else
                  F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    counted = value_counts(g, keys, list(fields))
    return counted.select(*keys, *[F.col(f"_n{i}").alias(n) for i, (n, _) in enumerate(fields.values())],
                          *[F.col(f"_v{i}").alias(v) for i, (_, v) in enumerate(fields.values())])
