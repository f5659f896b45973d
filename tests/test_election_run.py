"""Full run of the election configuration on small CSV inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.contracts import MissingRequiredColumn
from tallycheck.operators.reconcile import DuplicateKeyError
from tallycheck.plans import election
from tallycheck.sources.files import MissingReference

FILES = {
    "Raw Sources/precincts.csv": """ACM_ID,PRV_NAME,MUN_NAME,BRGY_NAME,Registered Voters,POLLPLACE
 01001 ,Prov A,Mun A,Brgy 1,"1,200",School 1
01002,Prov A,Mun A,Brgy 2,800,School 2
01003,Prov B,Mun B,Brgy 3,-5,
,Prov B,Mun B,Brgy 4,100,
""",
    "Raw Sources/candidates.csv": """Contest Code,Candidate Code,Candidate Name,Parties Code
01295000,C1,Juan Cruz,P1
01295000,C2,"Reyes, Ana (Independent",P2
01807001,C3,Pedro Santos,P1
""",
    "Raw Sources/contest.csv": """CONTEST_CODE,CONTEST_NAME,NUM_SEATS
01295000,Regional Governor,1
01807001,District Rep,1.5
""",
    "Raw Sources/parties.csv": """PARTIES_CODE,PARTIES_NAME
P1,Party One
""",
    "Raw Sources/results.csv": """PRECINCT_CODE,CONTEST_CODE,CANDIDATE_CODE,PARTY_CODE,VOTES_AMOUNT,NUMBER_VOTERS,UNDER_VOTES,OVER_VOTES,RECEPTION_DATE
01001,01295000,C1,P1,100,150,2,0,05-13-2025:08:00:00
01001,01295000,C2,P2,40,150,2,0,2025-05-13 08:00:00
01001,01807001,C3,P1,90,150,1,0,05/13/2025 08:01
01002,01295000,C1,P1,"1,000",900,0,0,2025-05-13T09:00:00
01002,01295000,C2,P2,abc,901,0,0,junk
""",
    "Raw Sources/Mobile App/election_returns.csv": """er_id,clustered_precinct_id,is_duplicate,received_at,registered_voters,ballots_counted
E1,01001,false,2025-05-13T00:05:00Z,1200,150
E2,01001,TRUE,2025-05-13T00:09:00Z,1200,150
E3,01002,0,2025-05-13T01:30:10Z,800,900
E4,01009,x,2025-05-13T01:31:00Z,,
""",
    "Raw Sources/Mobile App/qr_results.csv": """er_id,district_code,candidate_no,votes
E1,01295000,1,100
E1,01295000,2,41
E1,01807001,1,90
E3,01295000,1,1000
E3,01295000,3,7
E2,01295000,1,999
E9,01295000,1,5
""",
    "Reference/Verified/qr_verification_scope.csv": """CONTEST_CODE,ACTIVE,SCOPE_STATUS
01295000,TRUE,TEST_ONLY
01807001,no,TEST_ONLY
""",
    "Reference/Verified/comelec_ballot_choice_reference_verified.csv": """CONTEST_CODE,BALLOT_NO,CANONICAL_BALLOT_NAME,ENTRY_TYPE
01295000,1,JUAN  CRUZ,CANDIDATE
01295000,2,"reyes, ana (independent)",
""",
    "Reference/Verified/qr_district_ballot_position_map.csv": """CONTEST_CODE,BALLOT_POSITION,CANDIDATE_CODE,CANDIDATE_NAME
01807001,1,C3,"Santos, Pedro"
""",
}


def write_inputs(root, drop=(), override=None):
    for rel, text in {**FILES, **(override or {})}.items():
        if rel in drop:
            continue
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(text)


def test_full_run(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_inputs(root)
    r = election.run(spark, root, out)
    cmp = {row["FINAL_COMPARISON_KEY"]: (row["COMPARISON_STATUS"], row["COMPARISON_REASON"], row["VOTE_DIFFERENCE"])
           for row in r.tables["verification_comparison"].collect()}
    assert cmp == {
        "01001|01295000|C1": ("MATCHED", "VOTES_EQUAL", 0),
        "01001|01295000|C2": ("MISMATCH", "VOTES_DIFFER", 1),
        "01001|01807001|C3": ("MATCHED", "VOTES_EQUAL", 0),
        "01002|01295000|C1": ("MATCHED", "VOTES_EQUAL", 0),
        "01002|01295000|C2": ("CSV_ONLY", "QR_CHOICE_MISSING_FOR_IN_SCOPE_CSV_ROW", None),
    }
    issues = {r_["QA_CHECK"]: r_["ISSUE_COUNT"] for r_ in r.summary.collect()}
    assert issues["Precincts not yet in results"] == 2          # 01003 and the blank id
    assert issues["Result party unmatched"] == 2                # P2 in two precinct+contest groups
    assert issues["Invalid result numeric values"] == 1         # 'abc'
    assert issues["Invalid reception dates"] == 1               # 'junk'
    assert issues["Repeated contest totals inconsistent"] == 1  # 900 vs 901
    assert issues["Missing ACM IDs"] == 1 and issues["Invalid registered voter values"] == 1
    assert issues["QR rows with unknown ER ID"] == 1            # E9
    assert issues["Unmapped QR ballot choices"] == 1            # E3 position 3
    assert issues["Mapped QR contests outside configured scope"] == 1   # 01807001 is inactive in scope
    assert issues["Mobile required values invalid"] == 2        # bad flag, ballots > registered
    assert r.decision == "DO_NOT_PUBLISH"
    names = r.tables["candidates_master"].select("CANDIDATE_NAME").collect()
    assert "Reyes, Ana (Independent)" in {n[0] for n in names}
    bmap = {(row["CONTEST_CODE"], row["BALLOT_POSITION"]): row["CANDIDATE_CODE"]
            for row in election.ballot_choice_map(r.tables["candidates_master"],
                                                  election.load_region_wide(spark.read.option("header", True).csv(
                                                      os.path.join(root, election.INPUT_FILES["region_wide"]))),
                                                  spark.range(0).select(F.lit("x").alias("CONTEST_CODE"),
                                                                        F.lit(1).cast("bigint").alias("BALLOT_POSITION"),
                                                                        F.lit("c").alias("CANDIDATE_CODE"),
                                                                        F.lit(False).alias("IS_MOCK_MAP"))).collect()}
    assert bmap == {("01295000", 1): "C1", ("01295000", 2): "C2"}
    timeline = r.tables["dashboard_qr_timeline"].collect()
    assert [(t["QR_RECEIVED_COUNT"], t["CUMULATIVE_QR_RECEIVED"], t["TOTAL_EXPECTED_PRECINCTS"]) for t in timeline] == \
        [(1, 1, 3), (1, 2, 3)]
    for name in ("verification_comparison", "qa_publication_gate", "dashboard_verification_summary"):
        assert r.exported[name] and os.path.isdir(os.path.join(r.folder, name))
    assert r.published and r.folder.startswith(out)
    parts = [f for f in os.listdir(os.path.join(r.folder, "qa_final_summary")) if f.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(r.folder, "qa_final_summary", parts[0])) as fh:
        lines = fh.read().splitlines()
    names = [x.split(",")[0].strip('"') for x in lines[1:]]
    assert lines[0].startswith("QA_CHECK,") and "CHECK_ORDER" not in lines[0]
    assert names == [n for _, n, _ in fixed.CHECKS] + [fixed.OVERALL_CHECK]


def test_missing_mobile_sources_complete_with_csv_only(spark, tmp_path):
    root = str(tmp_path / "in")
    write_inputs(root, drop={"Raw Sources/Mobile App/election_returns.csv"})
    r = election.run(spark, root)
    statuses = {row["COMPARISON_STATUS"] for row in r.tables["verification_comparison"].collect()}
    assert statuses == {"CSV_ONLY"}
    assert r.tables["dashboard_verification_summary"].count() == 4


def test_duplicate_keys_abort_before_export(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    dup = FILES["Raw Sources/results.csv"] + "01001,01295000,C1,P1,100,150,2,0,05-13-2025:08:00:00\n"
    write_inputs(root, override={"Raw Sources/results.csv": dup})
    with pytest.raises(DuplicateKeyError, match="CSV: "):
        election.run(spark, root, out)
    assert not os.path.exists(out)


def test_missing_references_and_columns(spark, tmp_path):
    root = str(tmp_path / "a")
    write_inputs(root, drop={"Reference/Verified/comelec_ballot_choice_reference_verified.csv"})
    with pytest.raises(MissingReference):
        election.run(spark, root)
    root = str(tmp_path / "b")
    write_inputs(root, drop={"Reference/Verified/qr_verification_scope.csv"})
    with pytest.raises(MissingReference):
        election.run(spark, root)
    r = election.run(spark, root, environment="Development")
    assert {x["CONTEST_CODE"] for x in r.tables["verification_comparison"]
            .filter("IS_QR_VERIFICATION_SCOPE").select("CONTEST_CODE").distinct().collect()} <= {"01295000", "01807001"}
    root = str(tmp_path / "c")
    write_inputs(root, override={"Raw Sources/parties.csv": "PARTIES_CODE\nP1\n"})
    with pytest.raises(MissingRequiredColumn, match="PARTIES_NAME"):
        election.run(spark, root)


def test_large_tables_of_a_run_can_be_compressed(spark, tmp_path):
    from tallycheck.sources import published

    root, key = str(tmp_path / "in"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    write_inputs(root)
    before = spark.conf.get(key)
    plain = election.run(spark, root, str(tmp_path / "a"))
    small = election.run(spark, root, str(tmp_path / "b"), compression="gzip")
    assert spark.conf.get(key) == before
    files = lambda r, name: [f for f in os.listdir(os.path.join(r.folder, name)) if f.startswith("part-")]
    assert files(small, "verification_comparison") and all(f.endswith(".csv.gz") for f in files(small, "verification_comparison"))
    assert all(f.endswith(".csv") for f in files(plain, "verification_comparison") + files(small, "qa_final_summary"))
    a, b = (published(spark, str(tmp_path / x)) for x in "ab")
    for name in ("verification_comparison", "mobile_qr_results", "results_snapshot"):
        assert sorted(map(str, a[name].collect())) == sorted(map(str, b[name].collect()))


def test_guard_and_checks_read_the_mapped_rows_once(spark, tmp_path, monkeypatch):
    """The mapped side is written once, the guard is the comparison's own, and each check
    is a query of its own, so no plan of a run holds many others."""
    root = str(tmp_path / "in")
    write_inputs(root)
    kept, listed = [], []
    write, unique = election.write_table, election.assert_unique
    monkeypatch.setattr(election, "write_table", lambda df, path, **x: (kept.append(os.path.basename(path)), write(df, path, **x))[1])
    monkeypatch.setattr(election, "assert_unique", lambda *a: (listed.append(1), unique(*a)))
    r = election.run(spark, root)
    assert {"qr_side", "ballot_map", "candidates", "contests", "parties", "comparison"} <= set(kept) and not listed
    scans = r.issues["unmapped_qr_choices"]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in scans and "csv" not in scans.lower().replace("csv_", "")
    qr = FILES["Raw Sources/Mobile App/qr_results.csv"] + "E1,01295000,2,41\n"
    write_inputs(root, override={"Raw Sources/Mobile App/qr_results.csv": qr})
    with pytest.raises(DuplicateKeyError, match="QR: 1 keys occur more than once, first of them: 01001"):
        election.run(spark, root)
    assert listed == [1]
