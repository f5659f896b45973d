import pytest

from tallycheck.operators import rollups
from tallycheck.plans import election
from tallycheck.streaming import current_timeline, start_timeline
from tallycheck.streaming.timeline import TimelineState, merge_batch


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "ers"
    src.mkdir()
    (src / "a.csv").write_text("ER_ID,CLUSTERED_PRECINCT_ID,IS_DUPLICATE,RECEIVED_AT\n"
                               "E1,p1,false,2025-05-13T00:05:00Z\nE2,p2,false,2025-05-13T00:06:30Z\n"
                               "E3,p2,true,2025-05-13T00:01:00Z\n")
    # another order, another spelling and one column more
    (src / "b.csv").write_text("received at,ELECTION_DATE,is-duplicate,ER_ID,CLUSTERED_PRECINCT_ID\n"
                               "2025-05-13T00:02:00Z,x,0,E4,p1\n2025-05-13T09:00:00Z,x,false,E5,p3\n")
    universe = spark.createDataFrame([(f"p{i}",) for i in range(1, 6)], "ACM_ID string")
    q = start_timeline(spark, str(src), str(tmp_path / "state"), str(tmp_path / "out"), universe, "ACM_ID",
                       str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).drop("REFRESH_TIMESTAMP_UTC")
    every = (spark.read.option("header", True).csv(str(src / "a.csv")).unionByName(
        spark.read.option("header", True).csv(str(src / "b.csv")).drop("ELECTION_DATE").toDF(
            "RECEIVED_AT", "IS_DUPLICATE", "ER_ID", "CLUSTERED_PRECINCT_ID")))
    want = rollups.timeline(election.er_canonical(election.clean_mobile_ers(every)), entity="CLUSTERED_PRECINCT_ID",
                            received="RECEIVED_AT", universe=universe, universe_key="ACM_ID",
                            refresh_timestamp=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert [r["CUMULATIVE_QR_RECEIVED"] for r in got.orderBy("TIME_BUCKET").collect()] == [1, 2, 3]
    now = current_timeline(spark, str(tmp_path / "state"), universe, "ACM_ID", refresh_timestamp=False)
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, want.collect()))


def test_missing_state_stops_the_stream(spark, tmp_path):
    src = tmp_path / "ers"
    src.mkdir()
    head = "ER_ID,CLUSTERED_PRECINCT_ID,IS_DUPLICATE,RECEIVED_AT\n"
    universe = spark.createDataFrame([("p1",), ("p2",)], "ACM_ID string")

    def step():
        start_timeline(spark, str(src), str(tmp_path / "state"), str(tmp_path / "out"), universe, "ACM_ID",
                       str(tmp_path / "ckpt"), available_now=True).awaitTermination(120)

    (src / "a.csv").write_text(head + "E1,p1,false,2025-05-13T00:05:00Z\n")
    step()
    (tmp_path / "state").rename(tmp_path / "elsewhere")
    (src / "b.csv").write_text(head + "E2,p2,false,2025-05-13T00:06:00Z\n")
    with pytest.raises(Exception, match="no state of batch 0"):
        step()


ERS = "ER_ID string, CLUSTERED_PRECINCT_ID string, IS_DUPLICATE string, RECEIVED_AT string"


def _ers(spark, rows):
    return spark.createDataFrame([(f"E{i}", p, dup, at) for i, (p, dup, at) in enumerate(rows)], ERS)


BATCHES = [
    [(f"p{i}", "false", f"2025-05-13T0{i % 8}:05:00Z") for i in range(40)],
    [("p50", "false", "2025-05-20T01:00:00Z"), ("p1", "true", "2025-05-01T01:00:00Z"), ("p2", "false", None),
     (None, "false", "2025-05-13T01:00:00Z")],
    # p50 a week earlier, so that its old day is empty; p3 later, which changes nothing
    [("p50", "false", "2025-05-13T02:00:30Z"), ("p3", "false", "2025-05-14T02:00:00Z")],
    [],
    [("p4", "false", "2025-05-12T23:59:00Z")],
]


def _timelines(spark, state, universe, upto):
    got = current_timeline(spark, state, universe, "ACM_ID", refresh_timestamp=False)
    every = _ers(spark, [r for b in BATCHES[: upto + 1] for r in b])
    want = rollups.timeline(election.er_canonical(election.clean_mobile_ers(every)), entity="CLUSTERED_PRECINCT_ID",
                            received="RECEIVED_AT", universe=universe, universe_key="ACM_ID", refresh_timestamp=False)
    return sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))


def test_batches_rewrite_only_what_they_touch(spark, tmp_path):
    state = TimelineState(spark, str(tmp_path / "state"))
    universe = spark.range(60).selectExpr("concat('p', id) AS ACM_ID")
    assert current_timeline(spark, state.root, universe, "ACM_ID").count() == 0
    parts = []
    for n, batch in enumerate(BATCHES):
        for again in range(2):  # a batch that is run again changes nothing
            days = merge_batch(state, n, _ers(spark, batch) if batch else None, 16, "Asia/Manila")
            got, want = _timelines(spark, state.root, universe, n)
            assert got == want
        parts.append((days, sorted(k for k, b in state.index(n).items() if b == n)))
    assert len([p for p in parts[0][1] if p[0] == "receipts"]) > 8
    assert len([p for p in parts[1][1] if p[0] == "receipts"]) == 1 and parts[1][0] == ["2025-05-20"]
    assert parts[2][0] == ["2025-05-13", "2025-05-20"]
    assert [p for p in parts[2][1] if p[0] == "minutes"] == [("minutes", "2025-05-13")]
    assert parts[3] == ([], [])
    assert ("minutes", "2025-05-20") not in state.index(4)
    # what no batch needs any more is gone: the state of two batches is kept
    kept = {f"{k}/batch={b:012d}" for n in (3, 4) for (k, _), b in state.index(n).items()}
    held = {f"{k.name}/{b.name}" for k in (tmp_path / "state").iterdir() if k.name in ("receipts", "minutes")
            for b in k.iterdir() if any(p.is_dir() for p in b.iterdir())}
    assert held == kept
    assert sorted(p.name for p in (tmp_path / "state" / "index").iterdir()) == [f"batch={n:012d}" for n in (3, 4)]


def test_published_days_follow_the_changes(spark, tmp_path):
    src = tmp_path / "ers"
    src.mkdir()
    universe = spark.range(60).selectExpr("concat('p', id) AS ACM_ID")
    out = str(tmp_path / "out")
    for n, batch in enumerate(BATCHES):
        if not batch:
            continue
        lines = [f"E{i},{p or ''},{dup},{at or ''}" for i, (p, dup, at) in enumerate(batch)]
        (src / f"{n}.csv").write_text("\n".join(["ER_ID,CLUSTERED_PRECINCT_ID,IS_DUPLICATE,RECEIVED_AT", *lines, ""]))
        start_timeline(spark, str(src), str(tmp_path / "state"), out, universe, "ACM_ID", str(tmp_path / "ckpt"),
                       available_now=True).awaitTermination(120)
        _, want = _timelines(spark, str(tmp_path / "state"), universe, n)
        cols = current_timeline(spark, str(tmp_path / "state"), universe, "ACM_ID", refresh_timestamp=False).columns
        assert sorted(map(tuple, spark.read.parquet(out).select(*cols).collect())) == want
