import datetime as dt


from tallycheck.operators import rollups
from tallycheck.operators.reconcile import reconcile
from tests.conftest import rows
from tests.test_reconcile import KEYS, frames


def comparison(spark, **kw):
    c, q, scope = frames(spark, **kw)
    out = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", scope=scope, scope_on="C", scope_key="CONTEST_CODE")
    return out.withColumnRenamed("P", "CLUSTERED_PRECINCT_ID")


def test_status_summary_four_rows(spark):
    s = rollups.status_summary(comparison(spark))
    got = {r["COMPARISON_STATUS"]: r for r in s.collect()}
    assert list(sorted(got)) == ["CSV_ONLY", "MATCHED", "MISMATCH", "QR_ONLY"]
    m = got["MATCHED"]
    # in scope: 5 rows (p3|N excluded); CSV 4, QR 4, both 3
    assert (m["TOTAL_COMPARISON_ROWS"], m["TOTAL_CSV_ROWS"], m["TOTAL_QR_ROWS"], m["TOTAL_BOTH_PRESENT"]) == (5, 4, 4, 3)
    assert sum(r["STATUS_COUNT"] for r in got.values()) == 5
    assert (m["MATCH_RATE"], m["MISMATCH_RATE"], m["MATCH_PCT"]) == (0.3333, 0.0, 33.33)
    assert got["MISMATCH"]["MISMATCH_RATE"] == 0.6667 and got["MISMATCH"]["MATCH_RATE"] == 0.0
    assert m["QR_WITH_CSV_RATE"] == 0.75 and m["OVERALL_STATUS_RATE"] == 0.2


def test_status_summary_reference_rates(spark):
    s = rollups.status_summary(comparison(spark), reference_rates=True)
    for r in s.collect():
        assert (r["OVERALL_STATUS_RATE"], r["MATCH_RATE"], r["MISMATCH_PCT"]) == (0.0, 0.0, 0.0)
        assert r["QR_WITH_CSV_RATE"] == 0.75


def test_status_summary_empty_input(spark):
    s = rollups.status_summary(comparison(spark, csv=[], qr=[]))
    assert s.count() == 4
    assert {r["STATUS_COUNT"] for r in s.collect()} == {0}


def test_entity_status_and_kpi(spark):
    cmp = comparison(spark)
    e = rollups.entity_status(cmp)
    got = {r["CLUSTERED_PRECINCT_ID"]: r for r in e.collect()}
    assert got["p1"]["PRECINCT_STATUS"] == "MISMATCH" and got["p1"]["TOTAL_ABS_VOTE_DIFF"] == 4
    assert got["p1"]["MAX_ABS_VOTE_DIFF"] == 3 and got["p1"]["MATCH_RATE"] == 0.3333
    assert got["p2"]["PRECINCT_STATUS"] == "CSV_ONLY" and got["p2"]["TOTAL_ABS_VOTE_DIFF"] == 0
    assert got["p2"]["MAX_ABS_VOTE_DIFF"] is None
    assert got["p4"]["PRECINCT_STATUS"] == "QR_ONLY" and "p3" not in got
    # summed precinct counts equal the choice-level summary
    summary = {r["COMPARISON_STATUS"]: r["STATUS_COUNT"] for r in rollups.status_summary(cmp).collect()}
    assert sum(r["MATCHED_ROW_COUNT"] for r in got.values()) == summary["MATCHED"]
    universe = spark.createDataFrame([(p,) for p in ["p1", "p2", "p3", "p4", "p5", None]], "ACM_ID string")
    canon = spark.createDataFrame([("p1",), ("p4",), ("p4",)], "PID string")
    k = {r["VERIFICATION_STATUS"]: r for r in rollups.kpi_summary(universe, "ACM_ID", canon, "PID", e).collect()}
    assert len(k) == 4
    r = k["MISMATCH"]
    assert (r["TOTAL_PRECINCTS"], r["TOTAL_SCANNED_PRECINCTS"], r["UNSEEN_PRECINCT_COUNT"],
            r["TOTAL_VERIFICATION_PRECINCTS"], r["TOTAL_COMPARABLE_PRECINCTS"]) == (5, 2, 3, 3, 1)
    assert r["MISMATCH_RATE"] == 1.0 and r["MATCH_RATE"] is None and k["MATCHED"]["MATCH_RATE"] == 0.0
    assert r["QR_COVERAGE_RATE"] == 0.4 and r["QR_COVERAGE_PCT"] == 40.0


def test_reporting_by_entity(spark):
    universe = spark.createDataFrame([("p1", "R1"), ("p2", "R1"), (None, "R2")], "ACM_ID string, REGION string")
    facts = spark.createDataFrame([("p1", "A", dt.datetime(2025, 5, 13, 8)), ("p1", "B", dt.datetime(2025, 5, 13, 9)),
                                   ("p9", "A", None), (None, "A", None)],
                                  "PRECINCT_CODE string, CONTEST_CODE string, T timestamp_ntz")
    xw = spark.createDataFrame([("p1", "D1", "District 1"), ("p1", "D1", "District 1")],
                               "CLUSTER_ID string, DISTRICT_CODE string, DISTRICT_NAME string")
    out = rollups.reporting_by_entity(universe, facts, universe_key="ACM_ID", fact_key="PRECINCT_CODE",
                                      contest="CONTEST_CODE", received="T", crosswalk=xw)
    got = rows(out, "CLUSTERED_PRECINCT_ID", "RESULT_ROW_COUNT", "DISTINCT_CONTEST_COUNT", "DISTRICT_CODE",
               "REPORTING_STATUS", "UNREPORTED_PRECINCT_COUNT")
    assert got == sorted([("p1", 2, 2, "D1", "REPORTED", 0), ("p2", None, None, None, "NOT_REPORTED", 1),
                          (None, None, None, None, "NOT_REPORTED", 1)], key=repr)


def test_timeline_first_receipt_only(spark):
    ers = spark.createDataFrame([
        ("p1", dt.datetime(2025, 5, 12, 23, 59, 30)), ("p1", dt.datetime(2025, 5, 13, 0, 5)),
        ("p2", dt.datetime(2025, 5, 12, 23, 59, 10)), ("p3", dt.datetime(2025, 5, 13, 16, 1)),
        ("p4", None), (None, dt.datetime(2025, 5, 13, 1))], "P string, T timestamp_ntz")
    universe = spark.createDataFrame([(f"p{i}",) for i in range(1, 11)], "ACM_ID string")
    t = rollups.timeline(ers, entity="P", received="T", universe=universe, universe_key="ACM_ID",
                         refresh_timestamp=False)
    got = rows(t, "TIME_BUCKET", "QR_RECEIVED_COUNT", "RECEIVED_DATE", "RECEIVED_HOUR",
               "CUMULATIVE_QR_RECEIVED", "QR_COVERAGE_RATE", "TIMELINE_INDEX")
    assert got == [(dt.datetime(2025, 5, 13, 7, 59), 2, dt.date(2025, 5, 13), 7, 2, 0.2, 1),
                   (dt.datetime(2025, 5, 14, 0, 1), 1, dt.date(2025, 5, 14), 0, 3, 0.3, 2)]


def test_safe_singles(spark):
    df = spark.createDataFrame([("p", "c1", 5, None), ("p", "c1", 5, 1), ("p", "c2", 5, None), ("p", "c2", 6, None),
                                (None, "c1", 9, 9)], "P string, C string, A int, B int")
    out = rollups.safe_singles(df, ["P", "C"], {"A": ("NA", "A_SAFE"), "B": ("NB", "B_SAFE")})
    assert rows(out, "C", "NA", "A_SAFE", "NB", "B_SAFE") == [("c1", 1, 5, 1, 1), ("c2", 2, None, 0, None)]
