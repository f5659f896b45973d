"""What the plans must not do."""

import pytest

from tallycheck.plans import catalog, fixtures

SMALL = "/root/testdata/sf0.001"
#: Queries in which many checks look at views that are cleaned and written once, or whose rows are dealt to
#: ranges that are written; like whole runs they start jobs.
WRITES = {"quality_summary", "publication_gate", "issue_samples", "ballot_map_order", "status_counts_order",
          "comparison_order"}


def test_building_any_query_runs_no_job(spark):
    fixtures.clear_views()
    sc = spark.sparkContext
    sc.setJobGroup("building", "catalogue queries")
    try:
        # reading a table's schema is Spark's own metadata job; the queries add none
        for name in ("lineitem", "orders", "part", "supplier", "customer", "nation", "region", "events"):
            spark.read.parquet(f"{SMALL}/{name}.parquet")
        before = len(sc.statusTracker().getJobIdsForGroup("building"))
        reads = []
        read = fixtures.table
        fixtures.table = lambda *a, **b: (reads.append(1), read(*a, **b))[1]
        for name, build in catalog.QUERIES.items():
            if name not in WRITES and not name.startswith("run_"):
                build(spark, SMALL)
        jobs = len(sc.statusTracker().getJobIdsForGroup("building")) - before
        assert jobs <= len(reads)
    finally:
        fixtures.table = read
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["safe_singles", "check_repeated_contest_totals"])
def test_distinct_counts_need_no_expand(spark, name):
    assert "Expand" not in catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["safe_singles", "check_repeated_contest_totals"])
def test_distinct_counts_read_once(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_checks_together_scan_and_clean_each_source_once(spark, monkeypatch):
    fixtures.clear_views()
    df = catalog.QUERIES["quality_summary"](spark, SMALL)
    kept = [v for (name, *_), v in fixtures._VIEWS.items() if name == "kept"]
    assert len(kept) == 5  # results, precincts, both mobile sources and the mapped side
    sources = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    # line items and orders are read where a check has a view of its own, never to be cleaned again
    assert sum("l_quantity" in line or "event_id" in line for line in sources) == 0


def test_no_join_carries_a_hint_or_crosses(spark):
    plan = catalog.QUERIES["reconcile"](spark, SMALL)._jdf.queryExecution()
    assert "strategy=broadcast" not in plan.analyzed().toString()
    assert "CartesianProduct" not in plan.executedPlan().toString()


def test_comparison_neither_joins_nor_sorts_its_sides(spark):
    from tests.test_reconcile import KEYS, frames
    from tallycheck.operators.reconcile import reconcile

    c, q, _ = frames(spark)
    plan = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_filters_on_combinations_are_not_run_on_every_line(spark):
    df = fixtures.flag_map(spark, SMALL)
    scan = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert scan and not any("l_linenumber" in x and "_n" not in x for x in scan)


def test_a_task_reads_no_more_of_a_larger_table(spark):
    from tallycheck.session import _AT_MOST, configure

    before = {k: spark.conf.get(k) for k in _AT_MOST}
    try:
        for k, most in _AT_MOST.items():
            spark.conf.set(k, "1g")
            assert configure(spark).conf.get(k) == f"{most}b"
            spark.conf.set(k, "1m")
            assert configure(spark).conf.get(k) == "1m"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
