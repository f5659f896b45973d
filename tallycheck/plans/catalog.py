"""Query catalogue over the driver tables: one Spark query per operator, each
with an independent SQL statement (DuckDB dialect) that computes the same
answer straight from the source columns.

Spark side: the real library jobs run on the all-text views of
:mod:`tallycheck.plans.fixtures`. SQL side: written from the parquet tables
without re-parsing any decorated text, so the two stay independent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.functions import (
    apply_alias,
    clean_text,
    composite_key,
    lenient_key,
    normalize_geo,
    parse_first,
    parse_flag,
    scalar_ratio,
    whole_number,
)
from tallycheck.operators import gate, ordering, rollups
from tallycheck.operators.reconcile import duplicate_keys
from tallycheck.plans import election
from tallycheck.plans import fixtures as X
from tallycheck.session import configure, deletes_shuffles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            configure(spark)
            return fn(spark, d)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


STATUS_SORT_SQL = ("CAST(CASE {c} WHEN 'MATCHED' THEN 1 WHEN 'MISMATCH' THEN 2 "
                   "WHEN 'CSV_ONLY' THEN 3 WHEN 'QR_ONLY' THEN 4 END AS INTEGER)")
SCOPE_SQL = "('R', 'Z')"


def ratio_sql(n: str, d: str, positive_only: bool = True) -> str:
    """``positive_only``: the scalar form, rounded on the exact binary quotient
    (fixed-point formatting does that); else the column form, on decimal notation."""
    if positive_only:
        return f"CASE WHEN {d} > 0 THEN CAST(format('{{:.4f}}', CAST({n} AS DOUBLE) / {d}) AS DOUBLE) ELSE 0.0 END"
    return f"CASE WHEN {d} <> 0 THEN round_even(CAST({n} AS DOUBLE) / {d}, 4) ELSE 0.0 END"


# =========================================================================== reconciliation

CMP_SQL = f"""
csv AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS p, l_returnflag AS c, CAST(l_linenumber AS VARCHAR) AS k,
         CASE WHEN MAX(l_discount) >= 0.1 THEN NULL ELSE CAST(SUM(l_quantity) AS BIGINT) END AS v
  FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linenumber),
fmap AS (SELECT DISTINCT l_returnflag AS c, l_linenumber AS pos FROM lineitem WHERE l_returnflag <> 'N'),
canon AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
qraw AS (
  SELECT l_orderkey AS er, l_returnflag AS c, l_linenumber AS pos, CAST(SUM(l_quantity) AS BIGINT) AS v
  FROM lineitem WHERE l_tax > 0 GROUP BY l_orderkey, l_returnflag, l_linenumber
  UNION ALL
  SELECT o_orderkey, 'A', 1, 1 FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)),
qr AS (
  SELECT CAST(q.er AS VARCHAR) AS p, q.c, CAST(q.pos AS VARCHAR) AS k, q.v
  FROM qraw q JOIN canon ON canon.o_orderkey = q.er JOIN fmap m ON m.c = q.c AND m.pos = q.pos),
j AS (
  SELECT COALESCE(csv.p, qr.p) AS p, COALESCE(csv.c, qr.c) AS c, COALESCE(csv.k, qr.k) AS k,
         csv.v AS csv_v, qr.v AS qr_v, csv.p IS NOT NULL AS csv_e, qr.p IS NOT NULL AS qr_e
  FROM csv FULL OUTER JOIN qr ON csv.p = qr.p AND csv.c = qr.c AND csv.k = qr.k),
cls AS (
  SELECT *, c IN {SCOPE_SQL} AS in_scope,
    CASE WHEN csv_e AND qr_e THEN
           CASE WHEN csv_v IS NULL OR qr_v IS NULL THEN 'MISMATCH' WHEN csv_v = qr_v THEN 'MATCHED'
                ELSE 'MISMATCH' END
         WHEN csv_e THEN 'CSV_ONLY' ELSE 'QR_ONLY' END AS st,
    CASE WHEN csv_e AND qr_e THEN
           CASE WHEN csv_v IS NULL OR qr_v IS NULL THEN 'MISSING_VOTE_VALUE' WHEN csv_v = qr_v THEN 'VOTES_EQUAL'
                ELSE 'VOTES_DIFFER' END
         WHEN csv_e THEN CASE WHEN c IN {SCOPE_SQL} THEN 'QR_CHOICE_MISSING_FOR_IN_SCOPE_CSV_ROW'
                              ELSE 'CSV_CONTEST_OUTSIDE_QR_SCOPE' END
         ELSE 'CSV_CHOICE_MISSING' END AS reason
  FROM j),
cmp AS (
  SELECT p || '|' || c || '|' || k AS FINAL_COMPARISON_KEY, p AS CLUSTERED_PRECINCT_ID, c AS CONTEST_CODE,
         k AS CANDIDATE_CODE, c || '|' || k AS CONTEST_CANDIDATE_KEY, st AS COMPARISON_STATUS,
         reason AS COMPARISON_REASON, {STATUS_SORT_SQL.format(c='st')} AS STATUS_SORT,
         in_scope AS IS_QR_VERIFICATION_SCOPE, csv_e AS CSV_EXISTS, qr_e AS QR_EXISTS,
         st = 'MATCHED' AS IS_MATCHED, st = 'MISMATCH' AS IS_MISMATCH, csv_v AS CSV_VOTES, qr_v AS QR_VOTES,
         CASE WHEN csv_e AND qr_e THEN COALESCE(qr_v, 0) - COALESCE(csv_v, 0) END AS VOTE_DIFFERENCE,
         'CLUSTERED_PRECINCT_CONTEST_CANDIDATE' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
  FROM cls)"""


@query("reconcile", f"WITH {CMP_SQL} SELECT * FROM cmp")
def q_reconcile(spark, d):
    """Guarded full outer join of the transmitted
    tally against the mapped QR tally, every row explained."""
    return X.comparison(spark, d)


@query("reconcile_missing_value",
       f"WITH {CMP_SQL} SELECT * FROM cmp WHERE COMPARISON_REASON = 'MISSING_VOTE_VALUE'")
def q_reconcile_missing_value(spark, d):
    """Both sides present, the transmitted tally unreadable (null votes)
    -> MISMATCH / MISSING_VOTE_VALUE, difference counted with the null as 0."""
    return X.comparison(spark, d).filter(F.col("COMPARISON_REASON") == fixed.MISSING_VOTE_VALUE)


STATUS_SUMMARY_SQL = f"""
WITH {CMP_SQL},
sc AS (SELECT * FROM cmp WHERE IS_QR_VERIFICATION_SCOPE),
tot AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (WHERE CSV_EXISTS) AS nc, COUNT(*) FILTER (WHERE QR_EXISTS) AS nq,
               COUNT(*) FILTER (WHERE CSV_EXISTS AND QR_EXISTS) AS nb FROM sc),
sts(s, o) AS (VALUES ('MATCHED', 1), ('MISMATCH', 2), ('CSV_ONLY', 3), ('QR_ONLY', 4)),
cnt AS (SELECT s, o, (SELECT COUNT(*) FROM sc WHERE sc.COMPARISON_STATUS = sts.s) AS n FROM sts),
r AS (
  SELECT s, o, n, t, nc, nq, nb,
         {ratio_sql('n', 't')} AS r_all,
         {ratio_sql("CASE WHEN s = 'MATCHED' THEN n ELSE 0 END", 'nb')} AS r_m,
         {ratio_sql("CASE WHEN s = 'MISMATCH' THEN n ELSE 0 END", 'nb')} AS r_mm,
         {ratio_sql('nb', 'nq')} AS r_qc, {ratio_sql('nb', 'nc')} AS r_cq
  FROM cnt, tot)
SELECT s AS COMPARISON_STATUS, CAST(o AS INTEGER) AS STATUS_SORT, n AS STATUS_COUNT, t AS TOTAL_COMPARISON_ROWS,
       nc AS TOTAL_CSV_ROWS, nc AS TOTAL_IN_SCOPE_CSV, nq AS TOTAL_QR_ROWS, nb AS TOTAL_BOTH_PRESENT,
       r_all AS OVERALL_STATUS_RATE, r_m AS MATCH_RATE, r_mm AS MISMATCH_RATE, r_qc AS QR_WITH_CSV_RATE,
       r_cq AS CSV_WITH_QR_RATE, round_even(r_all * 100, 2) AS OVERALL_STATUS_PCT,
       round_even(r_m * 100, 2) AS MATCH_PCT, round_even(r_mm * 100, 2) AS MISMATCH_PCT,
       'IN_SCOPE_CHOICE_LEVEL_VERIFICATION' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
FROM r"""


@query("status_summary", STATUS_SUMMARY_SQL)
def q_status_summary(spark, d):
    """Four status rows over the in-scope comparison."""
    return rollups.status_summary(X.comparison(spark, d))


@query("status_value_counts",
       f"WITH {CMP_SQL} SELECT COMPARISON_STATUS, COUNT(*) AS ROW_COUNT FROM cmp GROUP BY COMPARISON_STATUS")
def q_status_value_counts(spark, d):
    """A10 O1: rows per comparison status."""
    return rollups.status_counts(X.comparison(spark, d))


ENTITY_SQL = f"""
e AS (
  SELECT CLUSTERED_PRECINCT_ID,
         COUNT(*) FILTER (WHERE CSV_EXISTS) AS CSV_ROW_COUNT, COUNT(*) FILTER (WHERE QR_EXISTS) AS QR_ROW_COUNT,
         COUNT(*) FILTER (WHERE CSV_EXISTS AND QR_EXISTS) AS BOTH_PRESENT_COUNT,
         COUNT(*) FILTER (WHERE IS_MATCHED) AS MATCHED_ROW_COUNT,
         COUNT(*) FILTER (WHERE IS_MISMATCH) AS MISMATCH_ROW_COUNT,
         COUNT(*) FILTER (WHERE COMPARISON_STATUS = 'CSV_ONLY') AS CSV_ONLY_ROW_COUNT,
         COUNT(*) FILTER (WHERE COMPARISON_STATUS = 'QR_ONLY') AS QR_ONLY_ROW_COUNT,
         CAST(COALESCE(SUM(ABS(VOTE_DIFFERENCE)), 0) AS BIGINT) AS TOTAL_ABS_VOTE_DIFF,
         CAST(MAX(ABS(VOTE_DIFFERENCE)) AS BIGINT) AS MAX_ABS_VOTE_DIFF
  FROM cmp WHERE IS_QR_VERIFICATION_SCOPE AND CLUSTERED_PRECINCT_ID IS NOT NULL
  GROUP BY CLUSTERED_PRECINCT_ID),
f AS (SELECT *, CSV_ROW_COUNT > 0 AS HAS_CSV, QR_ROW_COUNT > 0 AS HAS_QR FROM e),
es AS (
  SELECT *, CASE WHEN HAS_CSV AND NOT HAS_QR THEN 'CSV_ONLY' WHEN HAS_QR AND NOT HAS_CSV THEN 'QR_ONLY'
                 WHEN HAS_CSV AND HAS_QR AND (MISMATCH_ROW_COUNT > 0 OR CSV_ONLY_ROW_COUNT > 0
                                              OR QR_ONLY_ROW_COUNT > 0) THEN 'MISMATCH'
                 WHEN HAS_CSV AND HAS_QR THEN 'MATCHED' ELSE 'CSV_ONLY' END AS PRECINCT_STATUS
  FROM f)"""


ENTITY_STATUS_SQL = f"""
WITH {CMP_SQL}, {ENTITY_SQL}
SELECT *, {STATUS_SORT_SQL.format(c='PRECINCT_STATUS')} AS STATUS_SORT,
       {ratio_sql('MATCHED_ROW_COUNT', 'BOTH_PRESENT_COUNT', False)} AS MATCH_RATE,
       {ratio_sql('MISMATCH_ROW_COUNT', 'BOTH_PRESENT_COUNT', False)} AS MISMATCH_RATE,
       {ratio_sql('BOTH_PRESENT_COUNT', 'QR_ROW_COUNT', False)} AS QR_FOUND_IN_CSV_RATE,
       {ratio_sql('BOTH_PRESENT_COUNT', 'CSV_ROW_COUNT', False)} AS CSV_COVERED_BY_QR_RATE,
       'IN_SCOPE_PRECINCT_VERIFICATION' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
FROM es"""


@query("entity_status", ENTITY_STATUS_SQL)
def q_entity_status(spark, d):
    """One verification row per precinct."""
    return rollups.entity_status(X.comparison(spark, d))


@query("kpi_summary", f"""
WITH {CMP_SQL}, {ENTITY_SQL},
k AS (SELECT COUNT(*) AS nv, COUNT(*) FILTER (WHERE HAS_CSV AND HAS_QR) AS ncmp FROM es),
u AS (SELECT COUNT(DISTINCT CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_orderkey END) AS nexp FROM orders),
sn AS (SELECT COUNT(DISTINCT o_orderkey) AS nscan FROM orders WHERE o_orderstatus <> 'P'),
sts(s, o) AS (VALUES ('MATCHED', 1), ('MISMATCH', 2), ('CSV_ONLY', 3), ('QR_ONLY', 4)),
cnt AS (SELECT s, o, (SELECT COUNT(*) FROM es WHERE es.PRECINCT_STATUS = sts.s) AS n FROM sts),
r AS (SELECT *, {ratio_sql('nscan', 'nexp')} AS cov, {ratio_sql('n', 'ncmp')} AS rate FROM cnt, k, u, sn)
SELECT s AS VERIFICATION_STATUS, CAST(o AS INTEGER) AS STATUS_SORT, n AS PRECINCT_COUNT, nexp AS TOTAL_PRECINCTS,
       nv AS TOTAL_VERIFICATION_PRECINCTS, CASE WHEN nv > 0 THEN nexp - nscan ELSE nexp END AS UNSEEN_PRECINCT_COUNT,
       nscan AS TOTAL_SCANNED_PRECINCTS, ncmp AS TOTAL_COMPARABLE_PRECINCTS, cov AS QR_COVERAGE_RATE,
       round_even(cov * 100, 2) AS QR_COVERAGE_PCT, CASE WHEN s = 'MATCHED' THEN rate END AS MATCH_RATE,
       CASE WHEN s = 'MISMATCH' THEN rate END AS MISMATCH_RATE,
       'PRECINCT_LEVEL_VERIFICATION_SUMMARY' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
FROM r""")
def q_kpi_summary(spark, d):
    """Precinct KPI rows with expected / scanned / comparable denominators."""
    by_precinct = rollups.entity_status(X.comparison(spark, d))
    canon = election.er_canonical(X.ers_orders(spark, d))
    return rollups.kpi_summary(X.precincts(spark, d), "ACM_ID", canon, "CLUSTERED_PRECINCT_ID", by_precinct)


@query("map_positions", """
WITH fmap AS (SELECT DISTINCT l_returnflag AS c, l_linenumber AS pos FROM lineitem WHERE l_returnflag <> 'N'),
qraw AS (
  SELECT l_orderkey AS er, l_returnflag AS c, l_linenumber AS pos, CAST(SUM(l_quantity) AS BIGINT) AS v
  FROM lineitem WHERE l_tax > 0 GROUP BY l_orderkey, l_returnflag, l_linenumber
  UNION ALL
  SELECT o_orderkey, 'A', 1, 1 FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)),
q AS (SELECT qraw.* FROM qraw JOIN orders o ON o.o_orderkey = qraw.er WHERE o.o_orderstatus <> 'P'),
m AS (SELECT q.*, CASE WHEN fmap.c IS NOT NULL THEN CAST(q.pos AS VARCHAR) END AS cand
      FROM q LEFT JOIN fmap ON fmap.c = q.c AND fmap.pos = q.pos)
SELECT CAST(er AS VARCHAR) AS ER_ID, c AS QR_RACE_CODE, CAST(pos AS BIGINT) AS BALLOT_POSITION, v AS QR_VOTES,
       CAST(er AS VARCHAR) AS CLUSTERED_PRECINCT_ID, c AS CONTEST_CODE, cand AS CANDIDATE_CODE,
       c || '|' || COALESCE(cand, '') AS CONTEST_CANDIDATE_KEY,
       CAST(er AS VARCHAR) || '|' || c || '|' || COALESCE(cand, '') AS COMPARISON_KEY,
       cand IS NOT NULL AS MAPPING_VALID
FROM m""")
def q_map_positions(spark, d):
    """Canonical QR rows mapped through the ballot map."""
    return X.qr_side(spark, d).select(
        "ER_ID", "QR_RACE_CODE", "BALLOT_POSITION", "QR_VOTES", "CLUSTERED_PRECINCT_ID", "CONTEST_CODE",
        "CANDIDATE_CODE", "CONTEST_CANDIDATE_KEY", "COMPARISON_KEY", "MAPPING_VALID")


@query("canonical_join", """
WITH qraw AS (
  SELECT l_orderkey AS er, l_returnflag AS c, l_linenumber AS pos, CAST(SUM(l_quantity) AS BIGINT) AS v
  FROM lineitem WHERE l_tax > 0 GROUP BY l_orderkey, l_returnflag, l_linenumber
  UNION ALL
  SELECT o_orderkey, 'A', 1, 1 FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
SELECT CAST(er AS VARCHAR) AS ER_ID, c AS QR_RACE_CODE, CAST(pos AS BIGINT) AS BALLOT_POSITION, v AS QR_VOTES,
       CAST(er AS VARCHAR) AS CLUSTERED_PRECINCT_ID, o.o_orderdate AS ER_RECEIVED_AT, true AS IS_CANONICAL,
       'CANONICAL' AS SUBMISSION_STATUS
FROM qraw JOIN orders o ON o.o_orderkey = qraw.er WHERE o.o_orderstatus <> 'P'""")
def q_canonical_join(spark, d):
    """QR rows of canonical ERs with the ER's columns prefixed."""
    return X.qr_tally_canonical(spark, d).select(
        "ER_ID", "QR_RACE_CODE", "BALLOT_POSITION", "QR_VOTES", "CLUSTERED_PRECINCT_ID", "ER_RECEIVED_AT",
        "IS_CANONICAL", "SUBMISSION_STATUS")


# =========================================================================== rollups

PRECINCTS_SQL = """
pm AS (
  SELECT CASE WHEN o_totalprice < 20000 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS ACM_ID,
         CAST(NULL AS VARCHAR) AS REGION, o_orderstatus AS PROVINCE, o_orderpriority AS MUNICIPALITY,
         CAST(o_custkey AS VARCHAR) AS BARANGAY, CAST(o_custkey AS VARCHAR) AS POLLING_PLACE,
         CAST(NULL AS VARCHAR) AS CLUSTERED_PRECINCT,
         CAST(round_even(o_totalprice - 100000.0, 0) AS BIGINT) AS REGISTERED_VOTERS, o_orderkey
  FROM orders)"""

REPORTING_SQL = f"""
WITH {PRECINCTS_SQL},
res AS (SELECT CAST(l_orderkey AS VARCHAR) AS pc, l_returnflag AS cc,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS rdt FROM lineitem),
g AS (SELECT pc, COUNT(*) AS n, COUNT(DISTINCT cc) AS nd, MIN(rdt) AS f, MAX(rdt) AS l FROM res GROUP BY pc)
SELECT pm.ACM_ID AS CLUSTERED_PRECINCT_ID, REGION, PROVINCE, MUNICIPALITY, BARANGAY, POLLING_PLACE,
       CLUSTERED_PRECINCT, REGISTERED_VOTERS, g.n AS RESULT_ROW_COUNT, g.nd AS DISTINCT_CONTEST_COUNT,
       g.f AS FIRST_RECEPTION_DATETIME, g.l AS LAST_RECEPTION_DATETIME{{xcols}},
       g.n IS NOT NULL AS IS_REPORTED,
       CASE WHEN g.n IS NOT NULL THEN 'REPORTED' ELSE 'NOT_REPORTED' END AS REPORTING_STATUS,
       1 AS EXPECTED_PRECINCT_COUNT, CAST(g.n IS NOT NULL AS INTEGER) AS REPORTED_PRECINCT_COUNT,
       CAST(g.n IS NULL AS INTEGER) AS UNREPORTED_PRECINCT_COUNT,
       'EXPECTED_CLUSTERED_PRECINCT' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
FROM pm LEFT JOIN g ON pm.ACM_ID = g.pc{{xjoin}}"""


@query("reporting_by_entity", REPORTING_SQL.format(xcols="", xjoin=""))
def q_reporting_by_entity(spark, d):
    """Every expected precinct, reported or not."""
    return rollups.reporting_by_entity(X.precincts(spark, d), X.results_lines(spark, d), universe_key="ACM_ID",
                                       fact_key="PRECINCT_CODE", contest="CONTEST_CODE",
                                       received="RECEPTION_DATETIME")


@query("reporting_with_district", REPORTING_SQL.format(
    xcols=", x.DISTRICT_CODE, x.DISTRICT_NAME",
    xjoin=""" LEFT JOIN (SELECT DISTINCT CAST(o.o_orderkey AS VARCHAR) AS CLUSTER_ID,
                                CAST(n.n_nationkey AS VARCHAR) AS DISTRICT_CODE, n.n_name AS DISTRICT_NAME
                         FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                         JOIN nation n ON n.n_nationkey = c.c_nationkey) x ON x.CLUSTER_ID = pm.ACM_ID"""))
def q_reporting_with_district(spark, d):
    """The reporting table with the district crosswalk (precinct -> nation)."""
    o, c, n = X.table(spark, d, "orders"), X.table(spark, d, "customer"), X.table(spark, d, "nation")
    xw = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
          .select(X.s("o_orderkey").alias("CLUSTER_ID"), X.s("n_nationkey").alias("DISTRICT_CODE"),
                  F.col("n_name").alias("DISTRICT_NAME")))
    return rollups.reporting_by_entity(X.precincts(spark, d), X.results_lines(spark, d), universe_key="ACM_ID",
                                       fact_key="PRECINCT_CODE", contest="CONTEST_CODE",
                                       received="RECEPTION_DATETIME", crosswalk=xw)


@query("timeline", f"""
WITH er AS (SELECT user_id, ts FROM events WHERE event_type IN ('click', 'view', 'signup')
            AND user_id IS NOT NULL AND ts IS NOT NULL),
f AS (SELECT user_id, MIN(ts + INTERVAL 8 HOUR) AS fl FROM er GROUP BY user_id),
b AS (SELECT date_trunc('minute', fl) AS TIME_BUCKET, COUNT(*) AS QR_RECEIVED_COUNT FROM f GROUP BY 1),
w AS (SELECT *, CAST(SUM(QR_RECEIVED_COUNT) OVER (ORDER BY TIME_BUCKET ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND CURRENT ROW) AS BIGINT) AS CUMULATIVE_QR_RECEIVED,
                CAST(ROW_NUMBER() OVER (ORDER BY TIME_BUCKET) AS BIGINT) AS TIMELINE_INDEX,
                (SELECT COUNT(DISTINCT c_custkey) FROM customer) AS TOTAL_EXPECTED_PRECINCTS FROM b)
SELECT TIME_BUCKET, QR_RECEIVED_COUNT, CAST(TIME_BUCKET AS DATE) AS RECEIVED_DATE,
       CAST(hour(TIME_BUCKET) AS INTEGER) AS RECEIVED_HOUR, CUMULATIVE_QR_RECEIVED, TOTAL_EXPECTED_PRECINCTS,
       {ratio_sql('CUMULATIVE_QR_RECEIVED', 'TOTAL_EXPECTED_PRECINCTS', False)} AS QR_COVERAGE_RATE,
       round_even({ratio_sql('CUMULATIVE_QR_RECEIVED', 'TOTAL_EXPECTED_PRECINCTS', False)} * 100, 2)
         AS QR_COVERAGE_PCT,
       TIMELINE_INDEX, 'FIRST_QR_RECEIPT_PER_CLUSTERED_PRECINCT' AS RECORD_SCOPE, 'Production' AS ENVIRONMENT
FROM w""")
def q_timeline(spark, d):
    """First canonical receipt per precinct, UTC+8
    minute buckets, running coverage against all customers."""
    canon = election.er_canonical(X.ers_events(spark, d))
    return rollups.timeline(canon, entity="CLUSTERED_PRECINCT_ID", received="RECEIVED_AT",
                            universe=X.table(spark, d, "customer"), universe_key="c_custkey",
                            refresh_timestamp=False)


LINES_SQL = """
r AS (SELECT CAST(l_orderkey AS VARCHAR) AS pc, l_returnflag AS cc, CAST(l_linenumber AS VARCHAR) AS kc,
             CAST(l_suppkey AS VARCHAR) AS party, CAST(l_quantity AS BIGINT) AS votes,
             CAST(round(l_tax * 100) AS BIGINT) AS nv, CAST(round(l_discount * 100) AS BIGINT) AS uv,
             CAST(round((l_tax - l_discount) * 100) AS BIGINT) AS ov, l_linenumber AS ln, l_shipdate,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS rdt FROM lineitem)"""


@query("safe_singles", f"""
WITH {LINES_SQL}
SELECT pc AS PRECINCT_CODE, cc AS CONTEST_CODE, COUNT(DISTINCT nv) AS N_DISTINCT_VOTERS,
       COUNT(DISTINCT uv) AS N_DISTINCT_UNDER, COUNT(DISTINCT ov) AS N_DISTINCT_OVER,
       COUNT(DISTINCT rdt) AS N_DISTINCT_DATETIME,
       CASE WHEN COUNT(DISTINCT nv) = 1 THEN MAX(nv) END AS NUMBER_VOTERS_SAFE,
       CASE WHEN COUNT(DISTINCT uv) = 1 THEN MAX(uv) END AS UNDER_VOTES_SAFE,
       CASE WHEN COUNT(DISTINCT ov) = 1 THEN MAX(ov) END AS OVER_VOTES_SAFE,
       CASE WHEN COUNT(DISTINCT rdt) = 1 THEN MAX(rdt) END AS RECEPTION_DATETIME_SAFE
FROM r GROUP BY pc, cc""")
def q_safe_singles(spark, d):
    """One safe row per precinct + contest (repeated totals never summed)."""
    return election.precinct_contest_summary(X.results_lines(spark, d))


# =========================================================================== cleaning

@query("results_snapshot", f"""
WITH {LINES_SQL}
SELECT pc AS PRECINCT_CODE, cc AS CONTEST_CODE, kc AS CANDIDATE_CODE, party AS PARTIES_CODE,
       votes AS VOTES_AMOUNT, CAST(ln AS BIGINT) AS TOTALIZATION_ORDER, nv AS NUMBER_VOTERS, uv AS UNDER_VOTES,
       ov AS OVER_VOTES,
       CASE ln WHEN 1 THEN strftime(l_shipdate, '%m-%d-%Y:%H:%M:%S')
               WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
               WHEN 3 THEN strftime(l_shipdate, '%m/%d/%Y %H:%M:%S')
               WHEN 4 THEN strftime(l_shipdate, '%-m/%-d/%Y %-H:%M')
               WHEN 5 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
               WHEN 6 THEN strftime(l_shipdate, '%Y-%-m-%-d')
               ELSE strftime(l_shipdate, '%d.%m.%Y') END AS RECEPTION_DATE,
       rdt AS RECEPTION_DATETIME, cc || '|' || kc AS CONTEST_CANDIDATE_KEY, 'lineitem.parquet' AS SOURCE_FILE,
       'Production' AS ENVIRONMENT
FROM r""")
def q_results_snapshot(spark, d):
    """The results feed cleaned under its contract."""
    return X.results_lines(spark, d)


@query("clean_text_nulls", """
SELECT p_partkey, CASE WHEN p_size >= 40 THEN NULL ELSE p_name END AS CLEAN_NAME FROM part""")
def q_clean_text_nulls(spark, d):
    """Whitespace of every kind trimmed, blank -> null."""
    p = X.table(spark, d, "part")
    size = F.col("p_size")
    dirty = (F.when(size < 10, F.concat(F.lit("  "), "p_name", F.lit("\t")))
             .when(size <= 20, F.concat(F.lit("\n"), "p_name", F.lit(" ")))
             .when(size <= 25, F.concat(F.lit("　"), "p_name", F.lit(" \r")))
             .when(size < 40, F.col("p_name"))
             .when(size <= 45, F.lit(""))
             .otherwise(F.lit(" \t  ")))
    return p.select("p_partkey", dirty.alias("_raw")).select("p_partkey", clean_text("_raw").alias("CLEAN_NAME"))


@query("whole_number", """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN l_orderkey * 1000 + l_linenumber
                         WHEN 2 THEN CAST(l_quantity AS BIGINT)
                         WHEN 3 THEN CAST(l_quantity AS BIGINT) * 100
                         WHEN 4 THEN CASE WHEN l_extendedprice = floor(l_extendedprice)
                                          THEN CAST(l_extendedprice AS BIGINT) END
                         WHEN 5 THEN -l_partkey END AS PARSED
FROM lineitem""")
def q_whole_number(spark, d):
    """Strict whole numbers from thousands-separated, decimal, exponent,
    fractional, negative, junk and blank texts."""
    li = X.table(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    text = (F.when(ln == 1, F.format_number(F.col("l_orderkey") * 1000 + ln, 0))
            .when(ln == 2, X.s("l_quantity"))
            .when(ln == 3, F.concat(X.s(F.col("l_quantity").cast("bigint")), F.lit("e2")))
            .when(ln == 4, X.s("l_extendedprice"))
            .when(ln == 5, F.concat(F.lit("-"), X.s("l_partkey"), F.lit(" ")))
            .when(ln == 6, F.concat(F.lit("n/a "), "l_returnflag"))
            .otherwise(F.lit("   ")))
    raw = li.select("l_orderkey", "l_linenumber", text.alias("_raw"))
    return raw.select("l_orderkey", "l_linenumber", whole_number("_raw").alias("PARSED"))


@query("parse_dates", """
SELECT o_orderkey, CASE WHEN dayofweek(o_orderdate) = 6 THEN NULL ELSE o_orderdate END AS RECEPTION_DATETIME
FROM orders""")
def q_parse_dates(spark, d):
    """X11: first matching layout of six; the seventh layout is rejected."""
    o = X.table(spark, d, "orders")
    text = X.reception_text("o_orderdate", F.dayofweek("o_orderdate"))
    raw = o.select("o_orderkey", text.alias("_raw"))
    return raw.select("o_orderkey", parse_first("_raw").alias("RECEPTION_DATETIME"))


@query("flag_parse", """
SELECT event_id, CASE event_type WHEN 'error' THEN true WHEN 'purchase' THEN NULL ELSE false END AS IS_DUPLICATE
FROM events""")
def q_flag_parse(spark, d):
    """Trimmed, case-insensitive true/false/1/0; anything else -> null."""
    e = X.table(spark, d, "events")
    raw = e.select("event_id", X.flag_text(F.col("event_type")).alias("_raw"))
    return raw.select("event_id", parse_flag("_raw").alias("IS_DUPLICATE"))


@query("geo_normalize", """
SELECT c_custkey,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'COTABATO CITY' WHEN 'BUILDING' THEN 'SPECIAL GEOGRAPHIC AREA'
                         WHEN 'AUTOMOBILE' THEN '' WHEN 'FURNITURE' THEN replace(upper(c_name), '#', ' ') || ' X'
                         ELSE replace(upper(c_name), '#', ' ') END AS GEO_NAME
FROM customer""")
def q_geo_normalize(spark, d):
    """Geographic names upper-cased, punctuation and control characters
    blanked, spaces collapsed, fixed overrides applied."""
    c = X.table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    dirty = (F.when(seg == "MACHINERY", F.lit("City of  Cotabato"))
             .when(seg == "BUILDING", F.lit("special geographic areas!"))
             .when(seg == "AUTOMOBILE", F.lit(None).cast("string"))
             .when(seg == "FURNITURE", F.concat(F.lit("\t"), "c_name", F.lit("\u0001x ")))
             .otherwise(F.lower("c_name")))
    return c.select("c_custkey", dirty.alias("_raw")).select("c_custkey", normalize_geo("_raw").alias("GEO_NAME"))


@query("geo_alias", """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'TAGOLOAN II' WHEN 'MACHINERY' THEN 'Tagoloan II'
                                    ELSE c_name END AS ALIASED_NAME
FROM customer""")
def q_geo_alias(spark, d):
    """Verified aliases applied on upper(trim(name)); other names unchanged."""
    c = X.table(spark, d, "customer")
    seg = F.col("c_mktsegment")
    name = (F.when(seg == "HOUSEHOLD", F.lit(" tagoloan ")).when(seg == "MACHINERY", F.lit("Tagoloan II"))
            .otherwise(F.col("c_name")))
    return c.select("c_custkey", name.alias("_raw")).select("c_custkey", apply_alias("_raw").alias("ALIASED_NAME"))


CANDIDATES_SQL = """
part_ AS (SELECT * REPLACE (p_name || ' ' || CAST(p_partkey // 2 AS VARCHAR) AS p_name) FROM part),
cm AS (
  SELECT p_brand AS CONTEST_CODE, CAST(p_partkey AS VARCHAR) AS CANDIDATE_CODE,
         CASE p_type WHEN 'ECONOMY' THEN p_name || ' (' || p_brand || ')' WHEN 'SMALL' THEN p_name || ' ('
                     WHEN 'LARGE' THEN p_name || ' (' || p_brand || ')' WHEN 'MEDIUM' THEN p_name || ' (x)'
                     ELSE p_name END AS CANDIDATE_NAME,
         p_type AS PARTIES_CODE, p_brand || '|' || CAST(p_partkey AS VARCHAR) AS CONTEST_CANDIDATE_KEY
  FROM part_)"""


@query("name_repair", f"WITH {CANDIDATES_SQL} SELECT * FROM cm")
def q_name_repair(spark, d):
    """Candidates master with unclosed brackets repaired."""
    return election.clean_candidates(X.raw_candidates_parts(spark, d))


@query("classify_scope", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '01295000' WHEN '2-HIGH' THEN '01795000'
                            ELSE o_orderpriority END AS CONTEST_CODE,
       o_orderstatus AS CONTEST_NAME, o_custkey AS NUM_SEATS,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Region-wide' ELSE 'Local district' END
         AS CONTEST_SCOPE
FROM orders""")
def q_classify_scope(spark, d):
    """Contests master with region-wide / local-district scope."""
    return election.clean_contests(X.raw_contests_orders(spark, d))


@query("composite_key", """
SELECT l_orderkey, l_linenumber,
       l_returnflag || '|' || CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END
         AS CONTEST_CANDIDATE_KEY,
       CAST(l_orderkey AS VARCHAR) || '|' || l_returnflag || '|'
         || COALESCE(CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END, '')
         AS COMPARISON_KEY
FROM lineitem""")
def q_composite_key(spark, d):
    """Strict key (null if a part is null) and lenient key (missing part as '')."""
    li = X.table(spark, d, "lineitem")
    cand = F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(X.s("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber",
                     composite_key("l_returnflag", cand).alias("CONTEST_CANDIDATE_KEY"),
                     lenient_key(X.s("l_orderkey"), "l_returnflag", cand).alias("COMPARISON_KEY"))


@query("header_contract", """
SELECT CAST(c_custkey AS VARCHAR) AS ACM_ID, CAST(NULL AS VARCHAR) AS REGION, c_mktsegment AS PROVINCE,
       CAST(c_nationkey AS VARCHAR) AS MUNICIPALITY, c_name AS BARANGAY, CAST(NULL AS VARCHAR) AS POLLING_PLACE,
       CAST(NULL AS VARCHAR) AS CLUSTERED_PRECINCT,
       CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(c_acctbal AS BIGINT) END AS REGISTERED_VOTERS
FROM customer""")
def q_header_contract(spark, d):
    """Messy headers normalised and aliased, optional columns added."""
    return election.clean_precincts(X.raw_precincts_customer(spark, d))


@query("precincts_master", f"""
WITH {PRECINCTS_SQL}
SELECT ACM_ID, REGION, PROVINCE, MUNICIPALITY, BARANGAY, POLLING_PLACE, CLUSTERED_PRECINCT, REGISTERED_VOTERS
FROM pm""")
def q_precincts_master(spark, d):
    """Precincts with blank ids and separator-formatted counts."""
    return X.precincts(spark, d)


@query("canonical_filter", """
SELECT CAST(event_id AS VARCHAR) AS ER_ID, CAST(user_id AS VARCHAR) AS CLUSTERED_PRECINCT_ID,
       false AS IS_DUPLICATE, ts AS RECEIVED_AT, CAST(floor(value) AS BIGINT) AS BALLOTS_COUNTED,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS REGISTERED_VOTERS, true AS IS_CANONICAL,
       'CANONICAL' AS SUBMISSION_STATUS, 'Production' AS ENVIRONMENT, 'PRODUCTION' AS DATA_STATUS
FROM events WHERE event_type IN ('click', 'view', 'signup')""")
def q_canonical_filter(spark, d):
    """Canonical (non-duplicate) ER submissions."""
    return election.er_canonical(X.ers_events(spark, d)).select(
        "ER_ID", "CLUSTERED_PRECINCT_ID", "IS_DUPLICATE", "RECEIVED_AT", "BALLOTS_COUNTED", "REGISTERED_VOTERS",
        "IS_CANONICAL", "SUBMISSION_STATUS", "ENVIRONMENT", "DATA_STATUS")


@query("active_scope", """
SELECT DISTINCT o_orderpriority AS CONTEST_CODE, 'VERIFIED' AS SCOPE_STATUS, 'FILE' AS SOURCE_AUTHORITY,
       false AS IS_MOCK_SCOPE
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def q_active_scope(spark, d):
    """Active scope rows, one per contest."""
    o = X.table(spark, d, "orders")
    st = F.col("o_orderstatus")
    raw = o.select(F.col("o_orderpriority").alias("contest code"),
                   F.when(st == "F", F.lit("yes")).when(st == "O", F.lit("Active")).otherwise(F.lit("no"))
                   .alias("Active"))
    return election.load_scope(spark, raw)


PARTS_MAP_SQL = f"""
{CANDIDATES_SQL},
rw AS (SELECT p_brand AS cc, p_size AS pos, upper(p_name) AS nm,
              CASE WHEN p_size > 25 THEN 'CANDIDATE' END AS et FROM part_ WHERE p_type = 'PROMO'),
bm AS (
  SELECT rw.cc AS CONTEST_CODE, CAST(rw.pos AS BIGINT) AS BALLOT_POSITION, cm.CANDIDATE_CODE,
         COALESCE(rw.et, 'REGION_WIDE') AS CHOICE_TYPE, 'COMELEC_REGION_WIDE_VERIFIED' AS MAPPING_SOURCE,
         false AS IS_MOCK_MAP
  FROM rw LEFT JOIN cm ON cm.CONTEST_CODE = rw.cc AND upper(cm.CANDIDATE_NAME) = rw.nm
  UNION ALL
  SELECT p_brand, CAST(p_size AS BIGINT), CAST(p_partkey AS VARCHAR), 'DISTRICT', 'APPROVED_DISTRICT_MAP', false
  FROM part WHERE p_type = 'STANDARD')"""


@query("ballot_map", f"WITH {PARTS_MAP_SQL} SELECT * FROM bm")
def q_ballot_map(spark, d):
    """Region-wide names matched to candidates + district map."""
    return X.parts_map(spark, d)


def order_sql(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


@query("ballot_map_order", f"""
WITH {PARTS_MAP_SQL}
SELECT *, row_number() OVER (ORDER BY {order_sql('CONTEST_CODE', 'BALLOT_POSITION', 'CANDIDATE_CODE', 'CHOICE_TYPE',
                                                 'MAPPING_SOURCE', 'IS_MOCK_MAP')}) AS MAP_ROW FROM bm""")
def q_ballot_map_order(spark, d):
    """Each row's place in the ballot map's global order."""
    return ordering.with_positions(X.parts_map(spark, d), ["CONTEST_CODE", "BALLOT_POSITION"], "MAP_ROW")


@query("status_counts_order", f"""
WITH {CMP_SQL},
c AS (SELECT COMPARISON_STATUS, COUNT(*) AS ROW_COUNT FROM cmp GROUP BY COMPARISON_STATUS)
SELECT *, row_number() OVER (ORDER BY COMPARISON_STATUS ASC NULLS LAST) AS STATUS_ROW FROM c""")
def q_status_counts_order(spark, d):
    """The status counts with their places in status order."""
    return ordering.with_positions(rollups.status_counts(X.comparison(spark, d)), ["COMPARISON_STATUS"], "STATUS_ROW")


@query("comparison_order", f"""
WITH {CMP_SQL}
SELECT COMPARISON_STATUS, ABS(VOTE_DIFFERENCE) AS ABS_DIFFERENCE,
       row_number() OVER (ORDER BY COMPARISON_STATUS ASC NULLS LAST, ABS(VOTE_DIFFERENCE) ASC NULLS LAST) AS PLACE
FROM cmp""")
def q_comparison_order(spark, d):
    """Every compared row's place by status and size of the difference;
    few keys, so that single ones hold a large share of all rows."""
    cmp = X.comparison(spark, d).select("COMPARISON_STATUS", F.abs("VOTE_DIFFERENCE").alias("ABS_DIFFERENCE"))
    return ordering.with_positions(cmp, ["COMPARISON_STATUS", "ABS_DIFFERENCE"], "PLACE")


@query("table_row_counts", f"""
WITH {CMP_SQL}
SELECT 'results_snapshot' AS TABLE_NAME, COUNT(*) AS ROW_COUNT FROM lineitem
UNION ALL SELECT 'precincts_master', COUNT(*) FROM orders
UNION ALL SELECT 'mobile_election_returns', COUNT(*) FROM events
UNION ALL SELECT 'mobile_election_returns_canonical', COUNT(*) FROM events
          WHERE event_type IN ('click', 'view', 'signup')
UNION ALL SELECT 'verification_comparison', COUNT(*) FROM cmp""")
def q_table_row_counts(spark, d):
    """Row count of every table of a run, one job."""
    ers = X.ers_events(spark, d)
    return rollups.row_counts({
        "results_snapshot": X.results_lines(spark, d), "precincts_master": X.precincts(spark, d),
        "mobile_election_returns": ers, "mobile_election_returns_canonical": election.er_canonical(ers),
        "verification_comparison": X.comparison(spark, d)})


# =========================================================================== checks

CHECK_SQL: dict[str, str] = {}


def check(key: str, sql: str):
    CHECK_SQL[key] = sql.strip()
    return query(f"check_{key}", sql)


@check("result_duplicates", f"""
WITH {LINES_SQL},
dk AS (SELECT pc, cc, kc FROM r GROUP BY pc, cc, kc HAVING COUNT(*) > 1)
SELECT DISTINCT r.pc AS PRECINCT_CODE, r.cc AS CONTEST_CODE, r.kc AS CANDIDATE_CODE, r.votes AS VOTES_AMOUNT,
       'DUPLICATE_RESULT_KEY' AS QA_ISSUE
FROM r JOIN dk ON dk.pc = r.pc AND dk.cc = r.cc AND dk.kc = r.kc""")
def q_check_result_duplicates(spark, d):
    """Q1 W1 U1."""
    return _issues(spark, d)["result_duplicates"]


@check("missing_result_precincts", f"""
WITH {PRECINCTS_SQL}
SELECT ACM_ID, 'PRECINCT_NOT_YET_IN_RESULTS' AS QA_ISSUE FROM pm
WHERE ACM_ID IS NULL OR NOT EXISTS (SELECT 1 FROM lineitem l WHERE CAST(l.l_orderkey AS VARCHAR) = pm.ACM_ID)""")
def q_check_missing_result_precincts(spark, d):
    """Q2 J7 (null ids count as missing)."""
    return _issues(spark, d)["missing_result_precincts"]


@check("result_party_unmatched", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS PRECINCT_CODE, l_returnflag AS CONTEST_CODE,
       CAST(l_suppkey AS VARCHAR) AS PARTIES_CODE, 'PARTY_CODE_NOT_IN_MASTER' AS QA_ISSUE
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_acctbal >= 0 AND s.s_suppkey = l.l_suppkey)""")
def q_check_result_party_unmatched(spark, d):
    """Q3 J7 U1."""
    return _issues(spark, d)["result_party_unmatched"]


@check("result_candidate_unmatched", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS PRECINCT_CODE, l_returnflag AS CONTEST_CODE,
       CAST(l_linenumber AS VARCHAR) AS CANDIDATE_CODE,
       l_returnflag || '|' || CAST(l_linenumber AS VARCHAR) AS CONTEST_CANDIDATE_KEY,
       'CONTEST_CANDIDATE_KEY_NOT_IN_MASTER' AS QA_ISSUE
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_linenumber < 7 AND m.l_returnflag = l.l_returnflag
                  AND m.l_linenumber = l.l_linenumber)""")
def q_check_result_candidate_unmatched(spark, d):
    """Q4 J7 U1."""
    return _issues(spark, d)["result_candidate_unmatched"]


@check("result_precinct_unmatched", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS PRECINCT_CODE, 'PRECINCT_NOT_IN_MASTER' AS QA_ISSUE
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_totalprice >= 20000
                                  AND o.o_orderkey = l.l_orderkey)""")
def q_check_result_precinct_unmatched(spark, d):
    """Q5 J7 U1."""
    return _issues(spark, d)["result_precinct_unmatched"]


@check("repeated_contest_totals", f"""
WITH {LINES_SQL},
g AS (SELECT pc, cc, COUNT(DISTINCT nv) AS a, COUNT(DISTINCT uv) AS b, COUNT(DISTINCT ov) AS c
      FROM r GROUP BY pc, cc)
SELECT pc AS PRECINCT_CODE, cc AS CONTEST_CODE, a AS DISTINCT_COUNT, 'INCONSISTENT_NUMBER_VOTERS' AS QA_ISSUE,
       'NUMBER_VOTERS' AS FIELD_CHECKED FROM g WHERE a > 1
UNION ALL
SELECT pc, cc, b, 'INCONSISTENT_UNDER_VOTES', 'UNDER_VOTES' FROM g WHERE b > 1
UNION ALL
SELECT pc, cc, c, 'INCONSISTENT_OVER_VOTES', 'OVER_VOTES' FROM g WHERE c > 1""")
def q_check_repeated_contest_totals(spark, d):
    """One aggregate, unpivoted per field."""
    return _issues(spark, d)["repeated_contest_totals"]


@check("acm_id_duplicates", """
SELECT CAST(o_custkey AS VARCHAR) AS ACM_ID, 'DUPLICATE_ACM_ID' AS QA_ISSUE
FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1""")
def q_check_acm_id_duplicates(spark, d):
    """Precinct ids listed more than once (precincts keyed by customer)."""
    return _issues(spark, d)["acm_id_duplicates"]


@check("acm_id_missing", f"""
WITH {PRECINCTS_SQL}
SELECT ACM_ID, REGION, PROVINCE, MUNICIPALITY, BARANGAY, POLLING_PLACE, CLUSTERED_PRECINCT, REGISTERED_VOTERS,
       'MISSING_ACM_ID' AS QA_ISSUE
FROM pm WHERE ACM_ID IS NULL""")
def q_check_acm_id_missing(spark, d):
    """Q8: whole precinct rows without an id."""
    return _issues(spark, d)["acm_id_missing"]


@check("result_value_invalid", f"""
WITH {LINES_SQL}
SELECT pc AS PRECINCT_CODE, cc AS CONTEST_CODE, kc AS CANDIDATE_CODE, votes AS VOTES_AMOUNT,
       CAST(NULL AS BIGINT) AS NUMBER_VOTERS, CAST(NULL AS BIGINT) AS UNDER_VOTES, CAST(NULL AS BIGINT) AS OVER_VOTES,
       'INVALID_VOTES_AMOUNT' AS QA_ISSUE, 'VOTES_AMOUNT' AS FIELD_CHECKED FROM r WHERE votes IS NULL OR votes < 0
UNION ALL
SELECT pc, cc, kc, NULL, nv, NULL, NULL, 'INVALID_NUMBER_VOTERS', 'NUMBER_VOTERS' FROM r WHERE nv IS NULL OR nv < 0
UNION ALL
SELECT pc, cc, kc, NULL, NULL, uv, NULL, 'INVALID_UNDER_VOTES', 'UNDER_VOTES' FROM r WHERE uv IS NULL OR uv < 0
UNION ALL
SELECT pc, cc, kc, NULL, NULL, NULL, ov, 'INVALID_OVER_VOTES', 'OVER_VOTES' FROM r WHERE ov IS NULL OR ov < 0""")
def q_check_result_value_invalid(spark, d):
    """Null or negative measures, one scan unpivoted."""
    return _issues(spark, d)["result_value_invalid"]


@check("reception_date_invalid", """
SELECT CAST(l_orderkey AS VARCHAR) AS PRECINCT_CODE, l_returnflag AS CONTEST_CODE,
       strftime(l_shipdate, '%d.%m.%Y') AS RECEPTION_DATE, 'UNPARSEABLE_RECEPTION_DATE' AS QA_ISSUE
FROM lineitem WHERE l_linenumber = 7""")
def q_check_reception_date_invalid(spark, d):
    """Q10: reception dates no layout accepts."""
    return _issues(spark, d)["reception_date_invalid"]


@check("registered_voter_invalid", f"""
WITH {PRECINCTS_SQL}
SELECT ACM_ID, REGISTERED_VOTERS, 'INVALID_REGISTERED_VOTERS' AS QA_ISSUE FROM pm
WHERE REGISTERED_VOTERS IS NULL OR REGISTERED_VOTERS < 0""")
def q_check_registered_voter_invalid(spark, d):
    """Q11 F5."""
    return _issues(spark, d)["registered_voter_invalid"]


@check("required_value_blanks", f"""
WITH {PRECINCTS_SQL}
SELECT 'precincts' AS DATASET, 'ACM_ID' AS COLUMN, '' AS ROW_KEY, 'REQUIRED_VALUE_BLANK' AS QA_ISSUE
FROM pm WHERE ACM_ID IS NULL
UNION ALL
SELECT 'precincts', 'REGISTERED_VOTERS', COALESCE(ACM_ID, ''), 'REQUIRED_VALUE_BLANK'
FROM pm WHERE REGISTERED_VOTERS IS NULL""")
def q_check_required_value_blanks(spark, d):
    """Q12: nulls in required columns of the five masters (row key, not position)."""
    return _issues(spark, d)["required_value_blanks"]


@check("mobile_required_values", """
WITH er AS (SELECT event_type, CAST(floor(value) AS BIGINT) AS bc,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) AS rv FROM events),
li AS (SELECT l_tax, l_discount FROM lineitem),
c AS (
  SELECT 'ER' AS SOURCE, 'MISSING_ER_ID' AS QA_ISSUE, 0 AS n, 1 AS o
  UNION ALL SELECT 'ER', 'MISSING_PRECINCT_ID', 0, 2
  UNION ALL SELECT 'ER', 'INVALID_IS_DUPLICATE_FLAG', (SELECT COUNT(*) FROM er WHERE event_type = 'purchase'), 3
  UNION ALL SELECT 'ER', 'BALLOTS_COUNTED_EXCEEDS_REGISTERED_VOTERS', (SELECT COUNT(*) FROM er WHERE bc > rv), 4
  UNION ALL SELECT 'QR', 'MISSING_QR_ER_ID', 0, 5
  UNION ALL SELECT 'QR', 'MISSING_QR_RACE_CODE', 0, 6
  UNION ALL SELECT 'QR', 'INVALID_BALLOT_POSITION', 0, 7
  UNION ALL SELECT 'QR', 'INVALID_QR_VOTES', (SELECT COUNT(*) FROM li WHERE l_tax = 0), 8
  UNION ALL SELECT 'QR', 'NEGATIVE_QR_VOTES', (SELECT COUNT(*) FROM li WHERE l_tax <> 0 AND l_discount = 0), 9)
SELECT SOURCE, QA_ISSUE, n AS COUNT FROM c WHERE n > 0""")
def q_check_mobile_required_values(spark, d):
    """Q13: rule counts per mobile source, only rules that fire."""
    return _issues(spark, d)["mobile_required_values"]


@check("qr_orphan_er", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS ER_ID, 'ORPHAN_QR_ER_ID' AS QA_ISSUE FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_id = l.l_orderkey)""")
def q_check_qr_orphan_er(spark, d):
    """QR rows whose ER id is unknown."""
    return _issues(spark, d)["qr_orphan_er"]


@check("multiple_canonical_er", """
SELECT CAST(user_id AS VARCHAR) AS CLUSTERED_PRECINCT_ID, COUNT(event_id) AS CANONICAL_COUNT,
       'MULTIPLE_CANONICAL_ER_PER_PRECINCT' AS QA_ISSUE
FROM events WHERE event_type IN ('click', 'view', 'signup') AND user_id IS NOT NULL
GROUP BY user_id HAVING COUNT(event_id) > 1""")
def q_check_multiple_canonical_er(spark, d):
    """Q15 A8 F9."""
    return _issues(spark, d)["multiple_canonical_er"]


@check("duplicate_qr_choice", """
SELECT CAST(l_orderkey AS VARCHAR) AS ER_ID, l_returnflag AS QR_RACE_CODE, CAST(l_linenumber AS BIGINT)
       AS BALLOT_POSITION, 'DUPLICATE_QR_CHOICE' AS QA_ISSUE
FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linenumber HAVING COUNT(*) > 1""")
def q_check_duplicate_qr_choice(spark, d):
    """Q16 W1 U1."""
    return _issues(spark, d)["duplicate_qr_choice"]


@check("ballot_map_duplicate_key", f"""
WITH {PARTS_MAP_SQL}
SELECT CONTEST_CODE, BALLOT_POSITION, 'DUPLICATE_BALLOT_MAP_KEY' AS QA_ISSUE FROM bm
GROUP BY CONTEST_CODE, BALLOT_POSITION HAVING COUNT(*) > 1""")
def q_check_ballot_map_duplicate_key(spark, d):
    """Q17 W1 U1 over the parts ballot map (name matches multiply rows)."""
    return _issues(spark, d)["ballot_map_duplicate_key"]


@check("scope_readiness", f"""
WITH sc AS (SELECT * FROM (VALUES ('R'), ('Z')) t(code)),
fmap AS (SELECT DISTINCT l_returnflag AS c FROM lineitem WHERE l_returnflag <> 'N')
SELECT 'SCOPE_CONTEST_UNKNOWN_IN_MASTER' AS QA_ISSUE, code AS CONTEST_CODE FROM sc
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = sc.code)
UNION ALL
SELECT 'SCOPE_CONTEST_HAS_NO_BALLOT_MAP', code FROM sc WHERE NOT EXISTS (SELECT 1 FROM fmap WHERE fmap.c = sc.code)""")
def q_check_scope_readiness(spark, d):
    """Q18: scope contests unknown in the master or without a ballot map."""
    return _issues(spark, d)["scope_readiness"]


@check("unmapped_qr_choices", """
WITH qraw AS (
  SELECT l_orderkey AS er, l_returnflag AS c, l_linenumber AS pos FROM lineitem WHERE l_tax > 0
  GROUP BY l_orderkey, l_returnflag, l_linenumber
  UNION ALL
  SELECT o_orderkey, 'A', 1 FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
SELECT DISTINCT CAST(er AS VARCHAR) AS ER_ID, c AS QR_RACE_CODE, CAST(pos AS BIGINT) AS BALLOT_POSITION,
       'QR_BALLOT_CHOICE_UNMAPPED' AS QA_ISSUE
FROM qraw JOIN orders o ON o.o_orderkey = qraw.er
WHERE o.o_orderstatus <> 'P' AND c = 'N'""")
def q_check_unmapped_qr_choices(spark, d):
    """Q19 F7 U1."""
    return _issues(spark, d)["unmapped_qr_choices"]


@check("qr_outside_scope", """
WITH qraw AS (
  SELECT l_orderkey AS er, l_returnflag AS c FROM lineitem WHERE l_tax > 0
  UNION ALL
  SELECT o_orderkey, 'A' FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
SELECT DISTINCT c AS CONTEST_CODE, 'MAPPED_QR_CONTEST_OUTSIDE_SCOPE' AS QA_ISSUE
FROM qraw JOIN orders o ON o.o_orderkey = qraw.er
WHERE o.o_orderstatus <> 'P' AND c <> 'N' AND c NOT IN ('R', 'Z')""")
def q_check_qr_outside_scope(spark, d):
    """Q20 F7 J7 U1."""
    return _issues(spark, d)["qr_outside_scope"]


@X.shared
def _issues(spark: SparkSession, d: str, together: bool = False) -> election.LazyChecks:
    """The 20 checks over the driver-table views (each built on first use). When they
    run ``together``, the views that several look at are cleaned once and kept."""
    from tallycheck.operators import checks as C

    view = (lambda name: X.kept(spark, d, name)) if together else (lambda name: getattr(X, name)(spark, d))
    ers = view("ers_events")
    out = election.all_checks(
        precincts=view("precincts"),
        candidates=election.clean_candidates(X.raw_roster(spark, d)),
        contests=election.clean_contests(X.raw_contests_flags(spark, d)),
        parties=election.clean_parties(X.raw_parties(spark, d)),
        results=view("results_lines"), ers=ers, ers_canon=election.er_canonical(ers),
        qr=view("qr_lines"), ballot_map=X.flag_map(spark, d), scope=X.scope(spark),
        qr_side=view("qr_side"))
    # Two checks look at other views: duplicate precinct ids need a precinct
    # list whose ids repeat, and duplicate ballot-map keys the name-matched map.
    out["acm_id_duplicates"] = lambda: C.duplicate_rows(
        election.clean_precincts(X.raw_precincts_by_customer(spark, d)).filter(F.col("ACM_ID").isNotNull()),
        ["ACM_ID"], (), fixed.DUPLICATE_ACM_ID)
    out["ballot_map_duplicate_key"] = lambda: C.duplicate_rows(
        X.parts_map(spark, d), ["CONTEST_CODE", "BALLOT_POSITION"], (), fixed.DUPLICATE_BALLOT_MAP_KEY)
    return out


# =========================================================================== gate

def _summary_sql() -> str:
    parts = []
    for i, (key, name, sev) in enumerate(fixed.CHECKS, start=1):
        parts.append(f"SELECT {i} AS CHECK_ORDER, '{name}' AS QA_CHECK, '{sev}' AS SEVERITY, "
                     f"(SELECT COUNT(*) FROM ({CHECK_SQL[key]}) q{i}) AS ISSUE_COUNT")
    counts = "\nUNION ALL\n".join(parts)
    return f"""
WITH counts AS ({counts}),
rows_ AS (
  SELECT CHECK_ORDER, QA_CHECK, SEVERITY, ISSUE_COUNT,
         CASE WHEN ISSUE_COUNT = 0 THEN 'PASS' WHEN SEVERITY = 'BLOCKING' THEN 'BLOCKED'
              WHEN SEVERITY = 'WARNING' THEN 'REVIEW' ELSE 'INFO' END AS STATUS,
         CASE WHEN ISSUE_COUNT = 0 THEN 'No action required'
              WHEN SEVERITY = 'BLOCKING' THEN 'Investigate before publishing'
              WHEN SEVERITY = 'WARNING' THEN 'Review and document discrepancy'
              ELSE 'Monitor — election-in-progress information' END AS ACTION
  FROM counts),
o AS (SELECT COUNT(*) FILTER (WHERE STATUS = 'BLOCKED') AS b, COUNT(*) FILTER (WHERE STATUS = 'REVIEW') AS r,
             MAX(CHECK_ORDER) AS m FROM rows_)
SELECT CAST(CHECK_ORDER AS INTEGER) AS CHECK_ORDER, QA_CHECK, SEVERITY, ISSUE_COUNT, STATUS, ACTION FROM rows_
UNION ALL
SELECT CAST(m + 1 AS INTEGER), 'OVERALL QA STATUS', CASE WHEN b > 0 THEN 'BLOCKING' ELSE 'WARNING' END, b,
       CASE WHEN b > 0 THEN 'BLOCKED' WHEN r > 0 THEN 'READY_WITH_WARNINGS' ELSE 'READY' END,
       CASE WHEN b > 0 THEN 'Resolve all blocking issues before publishing.'
            WHEN r > 0 THEN 'Review warnings before publishing.' ELSE 'QA passed — ready to publish.' END
FROM o"""


def _summary(spark, d) -> DataFrame:
    return gate.summarize(gate.issue_counts(gate.catalogue(_issues(spark, d, True))))


def _gate_sql() -> str:
    return f"""
WITH s AS ({_summary_sql()}),
c AS (SELECT * FROM s WHERE QA_CHECK <> 'OVERALL QA STATUS'),
g AS (SELECT COUNT(*) FILTER (WHERE STATUS = 'BLOCKED') AS bc,
             CAST(COALESCE(SUM(ISSUE_COUNT) FILTER (WHERE STATUS = 'BLOCKED'), 0) AS BIGINT) AS bi,
             COUNT(*) FILTER (WHERE STATUS = 'REVIEW') AS rc,
             CAST(COALESCE(SUM(ISSUE_COUNT) FILTER (WHERE STATUS = 'REVIEW'), 0) AS BIGINT) AS ri,
             COUNT(*) FILTER (WHERE STATUS = 'INFO') AS ic,
             CAST(COALESCE(SUM(ISSUE_COUNT) FILTER (WHERE STATUS = 'INFO'), 0) AS BIGINT) AS ii FROM c)
SELECT 'Production' AS ENVIRONMENT,
       CASE WHEN bc > 0 THEN 'BLOCKED' WHEN rc > 0 THEN 'READY_WITH_WARNINGS' ELSE 'READY' END AS PUBLICATION_STATUS,
       CASE WHEN bc > 0 THEN 'DO_NOT_PUBLISH' WHEN rc > 0 THEN 'REVIEW_BEFORE_PUBLISH' ELSE 'READY_TO_PUBLISH' END
         AS PUBLICATION_DECISION,
       bc AS BLOCKING_CHECK_COUNT, bi AS BLOCKING_ISSUE_COUNT, rc AS REVIEW_CHECK_COUNT, ri AS REVIEW_ISSUE_COUNT,
       ic AS INFO_CHECK_COUNT, ii AS INFO_ISSUE_COUNT,
       CASE WHEN bc > 0 THEN 'Resolve all blocking QA issues before publishing.'
            WHEN rc > 0 THEN 'Review and document warnings before publishing.'
            ELSE 'QA checks passed. Dataset is ready for publication.' END AS REQUIRED_ACTION
FROM g"""


@query("quality_summary", _summary_sql())
def q_quality_summary(spark, d):
    """Every check counted in one job, statuses, OVERALL row."""
    return _summary(spark, d)


@query("publication_gate", _gate_sql())
def q_publication_gate(spark, d):
    """The one-row publication decision (without run id / clock columns)."""
    return gate.decide(_summary(spark, d))


def _samples_sql() -> str:
    parts = []
    for i, (key, name, _) in enumerate(fixed.CHECKS):
        cols = ", ".join(f"'{c}': CAST(\"{c}\" AS VARCHAR)" for c in sorted(CHECK_COLUMNS[key]))
        parts.append(f"""
SELECT '{name}' AS QA_CHECK, SAMPLE_ROW, n AS ISSUE_COUNT, greatest(n - 5, 0) AS OMITTED_COUNT FROM (
  SELECT SAMPLE_ROW, row_number() OVER (ORDER BY SAMPLE_ROW) AS rn, count(*) OVER () AS n
  FROM (SELECT CAST(to_json({{{cols}}}) AS VARCHAR) AS SAMPLE_ROW FROM ({CHECK_SQL[key]}) q{i})) WHERE rn <= 5""")
    return "\nUNION ALL\n".join(parts)


#: Columns of each check's rows.
_UNMATCHED = ["QA_ISSUE", "PRECINCT_CODE", "CONTEST_CODE"]
CHECK_COLUMNS = {
    "result_duplicates": [*_UNMATCHED, "CANDIDATE_CODE", "VOTES_AMOUNT"],
    "missing_result_precincts": ["ACM_ID", "QA_ISSUE"],
    "result_party_unmatched": [*_UNMATCHED, "PARTIES_CODE"],
    "result_candidate_unmatched": [*_UNMATCHED, "CANDIDATE_CODE", "CONTEST_CANDIDATE_KEY"],
    "result_precinct_unmatched": ["PRECINCT_CODE", "QA_ISSUE"],
    "repeated_contest_totals": [*_UNMATCHED, "DISTINCT_COUNT", "FIELD_CHECKED"],
    "acm_id_duplicates": ["ACM_ID", "QA_ISSUE"],
    "acm_id_missing": ["ACM_ID", "REGION", "PROVINCE", "MUNICIPALITY", "BARANGAY", "POLLING_PLACE",
                       "CLUSTERED_PRECINCT", "REGISTERED_VOTERS", "QA_ISSUE"],
    "result_value_invalid": [*_UNMATCHED, "CANDIDATE_CODE", "VOTES_AMOUNT", "NUMBER_VOTERS", "UNDER_VOTES",
                             "OVER_VOTES", "FIELD_CHECKED"],
    "reception_date_invalid": [*_UNMATCHED, "RECEPTION_DATE"],
    "registered_voter_invalid": ["ACM_ID", "REGISTERED_VOTERS", "QA_ISSUE"],
    "required_value_blanks": ["DATASET", "COLUMN", "ROW_KEY", "QA_ISSUE"],
    "mobile_required_values": ["SOURCE", "QA_ISSUE", "COUNT"],
    "qr_orphan_er": ["ER_ID", "QA_ISSUE"],
    "multiple_canonical_er": ["CLUSTERED_PRECINCT_ID", "CANONICAL_COUNT", "QA_ISSUE"],
    "duplicate_qr_choice": ["ER_ID", "QR_RACE_CODE", "BALLOT_POSITION", "QA_ISSUE"],
    "ballot_map_duplicate_key": ["CONTEST_CODE", "BALLOT_POSITION", "QA_ISSUE"],
    "scope_readiness": ["QA_ISSUE", "CONTEST_CODE"],
    "unmapped_qr_choices": ["ER_ID", "QR_RACE_CODE", "BALLOT_POSITION", "QA_ISSUE"],
    "qr_outside_scope": ["CONTEST_CODE", "QA_ISSUE"],
}


@query("issue_samples", _samples_sql())
@deletes_shuffles
def q_issue_samples(spark, d):
    """O2: up to five example rows per check with the number left out."""
    return gate.issue_samples(gate.catalogue(_issues(spark, d, True)), 5)


# =========================================================================== outcomes the tables above don't reach

_GATE_COUNTS = """
       CAST({b} AS BIGINT) AS BLOCKING_CHECK_COUNT, CAST(0 AS BIGINT) AS BLOCKING_ISSUE_COUNT,
       CAST({r} AS BIGINT) AS REVIEW_CHECK_COUNT, CAST({ri} AS BIGINT) AS REVIEW_ISSUE_COUNT,
       CAST(0 AS BIGINT) AS INFO_CHECK_COUNT, CAST(0 AS BIGINT) AS INFO_ISSUE_COUNT"""


@query("gate_review", f"""
WITH n AS (SELECT COUNT(*) AS n FROM ({CHECK_SQL['reception_date_invalid']}) q)
SELECT 'Production' AS ENVIRONMENT, 'READY_WITH_WARNINGS' AS PUBLICATION_STATUS,
       'REVIEW_BEFORE_PUBLISH' AS PUBLICATION_DECISION, {_GATE_COUNTS.format(b=0, r=1, ri='n')},
       'Review and document warnings before publishing.' AS REQUIRED_ACTION FROM n""")
def q_gate_review(spark, d):
    """Only a warning fires."""
    check = gate.Check("reception_date_invalid", "Invalid reception dates", fixed.WARNING,
                       _issues(spark, d)["reception_date_invalid"])
    return gate.decide(gate.summarize(gate.issue_counts([check])))


@query("gate_ready", f"""
SELECT 'Production' AS ENVIRONMENT, 'READY' AS PUBLICATION_STATUS, 'READY_TO_PUBLISH' AS PUBLICATION_DECISION,
       {_GATE_COUNTS.format(b=0, r=0, ri=0)},
       'QA checks passed. Dataset is ready for publication.' AS REQUIRED_ACTION
FROM (SELECT COUNT(*) - COUNT(DISTINCT o_orderkey) AS repeated FROM orders) WHERE repeated = 0""")
def q_gate_ready(spark, d):
    """Order keys are unique, so nothing fires."""
    from tallycheck.operators import checks as C

    unique = C.duplicate_rows(X.ers_orders(spark, d), ["ER_ID"], (), fixed.DUPLICATE_ACM_ID)
    return gate.decide(gate.summarize(gate.issue_counts(gate.catalogue({"acm_id_duplicates": unique}))))


@query("check_scope_empty", """
SELECT 'PRODUCTION_SCOPE_MISSING' AS QA_ISSUE, CAST(NULL AS VARCHAR) AS CONTEST_CODE
FROM (SELECT COUNT(*) FILTER (WHERE o_orderstatus = '?') AS n FROM orders) WHERE n = 0""")
def q_check_scope_empty(spark, d):
    """Q18: no contest of the scope file is active."""
    from tallycheck.operators import checks as C

    raw = X.table(spark, d, "orders").select(F.col("o_orderpriority").alias("CONTEST_CODE"),
                                             F.when(F.col("o_orderstatus") == "?", "yes").otherwise("no").alias("ACTIVE"))
    return C.scope_readiness(election.load_scope(spark, raw), "CONTEST_CODE",
                             election.clean_contests(X.raw_contests_flags(spark, d)), "CONTEST_CODE",
                             X.flag_map(spark, d), "CONTEST_CODE", require_scope=True)


@query("check_mobile_rules", """
WITH er AS (SELECT event_type AS t, CAST(floor(value) AS BIGINT) AS bc, CAST(json_extract_string(props, '$.k') AS BIGINT) AS rv,
                   user_id FROM events),
c AS (
  SELECT 'ER' AS SOURCE, 'MISSING_ER_ID' AS QA_ISSUE, (SELECT COUNT(*) FROM er WHERE t = 'view') AS n
  UNION ALL SELECT 'ER', 'MISSING_PRECINCT_ID', (SELECT COUNT(*) FROM er WHERE t = 'click' OR user_id IS NULL)
  UNION ALL SELECT 'ER', 'INVALID_IS_DUPLICATE_FLAG', (SELECT COUNT(*) FROM er WHERE t = 'purchase')
  UNION ALL SELECT 'ER', 'BALLOTS_COUNTED_EXCEEDS_REGISTERED_VOTERS', (SELECT COUNT(*) FROM er WHERE bc > rv)
  UNION ALL SELECT 'QR', 'MISSING_QR_ER_ID', (SELECT COUNT(*) FROM lineitem WHERE l_linenumber = 1)
  UNION ALL SELECT 'QR', 'MISSING_QR_RACE_CODE', (SELECT COUNT(*) FROM lineitem WHERE l_linenumber = 2)
  UNION ALL SELECT 'QR', 'INVALID_BALLOT_POSITION', (SELECT COUNT(*) FROM lineitem WHERE l_linenumber = 3)
  UNION ALL SELECT 'QR', 'INVALID_QR_VOTES', (SELECT COUNT(*) FROM lineitem WHERE l_linenumber = 4)
  UNION ALL SELECT 'QR', 'NEGATIVE_QR_VOTES', (SELECT COUNT(*) FROM lineitem WHERE l_linenumber = 5 AND l_quantity >= 1))
SELECT SOURCE, QA_ISSUE, n AS COUNT FROM c WHERE n > 0""")
def q_check_mobile_rules(spark, d):
    """Q13: all nine rules fire."""
    return election.mobile_rule_counts(election.clean_mobile_ers(X.raw_ers_blanks(spark, d)),
                                       election.clean_mobile_qr(X.raw_qr_blanks(spark, d)))


@query("scalar_rounding", """
SELECT l_orderkey, l_linenumber, CAST(format('{:.4f}', CAST(l_partkey AS DOUBLE) / 20000) AS DOUBLE) AS OF_20000,
       CAST(format('{:.4f}', CAST(l_orderkey AS DOUBLE) / 100000) AS DOUBLE) AS OF_100000,
       CAST(format('{:.4f}', CAST(l_linenumber AS DOUBLE) / 32) AS DOUBLE) AS OF_32
FROM lineitem""")
def q_scalar_rounding(spark, d):
    """Quotients that end in a decimal 5 are rounded on their binary value."""
    li = X.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", scalar_ratio("l_partkey", F.lit(20000)).alias("OF_20000"),
                     scalar_ratio("l_orderkey", F.lit(100000)).alias("OF_100000"),
                     scalar_ratio("l_linenumber", F.lit(32)).alias("OF_32"))


@query("duplicate_keys", """
SELECT 'CSV' AS SIDE, CAST(l_orderkey AS VARCHAR) AS PRECINCT_CODE, l_returnflag AS CONTEST_CODE FROM lineitem
GROUP BY l_orderkey, l_returnflag HAVING COUNT(*) > 1
UNION ALL
SELECT 'QR', CAST(l_orderkey AS VARCHAR), l_returnflag FROM lineitem
GROUP BY l_orderkey, l_returnflag HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, d):
    """The keys the uniqueness guard would stop on, per side."""
    qr = X.qr_lines(spark, d).select(F.col("ER_ID").alias("PRECINCT_CODE"), F.col("QR_RACE_CODE").alias("CONTEST_CODE"))
    csv = X.results_lines(spark, d).select("PRECINCT_CODE", "CONTEST_CODE")
    return duplicate_keys({"CSV": csv, "QR": qr}, ["PRECINCT_CODE", "CONTEST_CODE"])


# =========================================================================== whole runs, CSV in to publication out

@query("run_comparison", f"WITH {CMP_SQL} SELECT * FROM cmp")
def q_run_comparison(spark, d):
    """The comparison that ``run`` published from raw CSV sources (quotes,
    line breaks, byte order marks, NA tokens), read back from its CSV export."""
    return X.csv_run(spark, d)["verification_comparison"]


@query("run_status_summary", STATUS_SUMMARY_SQL)
def q_run_status_summary(spark, d):
    """The published four status rows."""
    return X.csv_run(spark, d)["dashboard_verification_summary"]


@query("run_entity_status", ENTITY_STATUS_SQL)
def q_run_entity_status(spark, d):
    """The published status of each precinct."""
    return X.csv_run(spark, d)["dashboard_verification_by_precinct"]


@query("run_gate", """
SELECT TRUE AS RUN_ID_FITS, TRUE AS REFRESH_FITS, 'Production' AS ENVIRONMENT, 'DO_NOT_PUBLISH' AS PUBLICATION_DECISION,
       (SELECT COUNT(*) FROM orders WHERE o_totalprice < 20000) > 0 AS BLOCKED_BY_MISSING_IDS""")
def q_run_gate(spark, d):
    """The published gate row; run id and clock by their shape."""
    gate_row, checks = X.csv_run(spark, d)["qa_publication_gate"], X.csv_run(spark, d)["qa_final_summary"]
    missing = checks.filter(F.col("QA_CHECK") == dict((k, n) for k, n, _ in fixed.CHECKS)["acm_id_missing"])
    return gate_row.withColumn("n", missing.agg(F.sum(F.col("ISSUE_COUNT").cast("bigint"))).scalar()).select(
        F.col("RUN_ID").rlike(r"^RUN_\d{8}T\d{6}Z$").alias("RUN_ID_FITS"),
        F.col("REFRESH_TIMESTAMP_UTC").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}(Z|\+00:00)$").alias("REFRESH_FITS"),
        "ENVIRONMENT", "PUBLICATION_DECISION", (F.col("n") > 0).alias("BLOCKED_BY_MISSING_IDS"))


@query("run_without_mobile", f"""
WITH {CMP_SQL}
SELECT 'CSV_ONLY' AS COMPARISON_STATUS, c IN {SCOPE_SQL} AS IS_QR_VERIFICATION_SCOPE, COUNT(*) AS ROW_COUNT,
       CAST(SUM(v) AS BIGINT) AS CSV_VOTES
FROM csv GROUP BY c IN {SCOPE_SQL}""")
def q_run_without_mobile(spark, d):
    """S3: a run whose mobile QR file is missing compares the transmitted rows alone."""
    return (X.csv_run(spark, d, False)["verification_comparison"].groupBy("COMPARISON_STATUS", "IS_QR_VERIFICATION_SCOPE")
            .agg(F.count(F.lit(1)).alias("ROW_COUNT"), F.sum("CSV_VOTES").alias("CSV_VOTES")))
