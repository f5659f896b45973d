from pyspark.sql import functions as F

from tallycheck import fixed
from tallycheck.operators import checks as C
from tallycheck.operators import gate
from tests.conftest import rows


def test_duplicate_rows_nulls_equal(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 10), ("a", 1, 11), ("b", None, 1), ("b", None, 2),
                                ("c", 1, 1)], "k1 string, k2 int, v int")
    got = rows(C.duplicate_rows(df, ["k1", "k2"], ["v"]), "k1", "k2", "v")
    assert got == sorted([("a", 1, 10), ("a", 1, 11), ("b", None, 1), ("b", None, 2)], key=repr)
    assert rows(C.duplicate_rows(df, ["k1", "k2"]), "k1", "k2") == sorted([("a", 1), ("b", None)], key=repr)
    clean = spark.createDataFrame([("a", 1)], "k1 string, k2 int")
    assert C.duplicate_rows(clean, ["k1", "k2"]).count() == 0


def test_missing_from_keeps_null_keys(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,), ("y",)], "k string")
    parent = spark.createDataFrame([("x",), (None,)], "k string")
    assert rows(C.missing_from(df, parent, ["k"], None, ["k"], "ISSUE"), "k") == sorted([(None,), ("y",)], key=repr)
    assert C.missing_from(df, parent, ["k"], None, ["k"], "ISSUE", distinct=False).count() == 3


def test_inconsistent_and_invalid(spark):
    df = spark.createDataFrame([("p", "c", 1, 5), ("p", "c", 2, 5), ("p", "d", 1, None), (None, "c", 1, 9),
                                ("q", "c", None, -1)], "P string, C string, A int, B int")
    inc = C.inconsistent_values(df, ["P", "C"], ["A", "B"])
    assert rows(inc, "P", "C", "DISTINCT_COUNT", "QA_ISSUE", "FIELD_CHECKED") == [("p", "c", 2, "INCONSISTENT_A", "A")]
    bad = C.invalid_values(df, ["P", "C"], ["A", "B"])
    assert rows(bad, "P", "C", "A", "B", "FIELD_CHECKED") == sorted(
        [("p", "d", None, None, "B"), ("q", "c", None, None, "A"), ("q", "c", None, -1, "B")], key=repr)


def test_rule_counts_and_required_blanks(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", -2)], "id string, v int")
    rc = C.rule_counts(df, "ER", [("MISSING", F.col("id").isNull()), ("NEG", F.coalesce(F.col("v") < 0, F.lit(False))),
                                  ("NEVER", F.lit(False))])
    assert rows(rc, "SOURCE", "QA_ISSUE", "COUNT") == [("ER", "MISSING", 1), ("ER", "NEG", 1)]
    rb = C.required_blanks({"t": (df, ["id", "v", "absent"], ["id"])})
    assert rows(rb, "DATASET", "COLUMN", "ROW_KEY") == [("t", "id", ""), ("t", "v", "a")]


def test_scope_readiness_and_outside(spark):
    scope = spark.createDataFrame([("A",), ("Z",)], "CONTEST_CODE string")
    contests = spark.createDataFrame([("A",), ("B",)], "CONTEST_CODE string")
    bmap = spark.createDataFrame([("B",)], "CONTEST_CODE string")
    got = rows(C.scope_readiness(scope, "CONTEST_CODE", contests, "CONTEST_CODE", bmap, "CONTEST_CODE", True),
               "QA_ISSUE", "CONTEST_CODE")
    assert got == sorted([("SCOPE_CONTEST_UNKNOWN_IN_MASTER", "Z"), ("SCOPE_CONTEST_HAS_NO_BALLOT_MAP", "A"),
                          ("SCOPE_CONTEST_HAS_NO_BALLOT_MAP", "Z")], key=repr)
    empty = spark.createDataFrame([], "CONTEST_CODE string")
    got = rows(C.scope_readiness(empty, "CONTEST_CODE", contests, "CONTEST_CODE", bmap, "CONTEST_CODE", True))
    assert got == [(fixed.PRODUCTION_SCOPE_MISSING, None)]
    assert C.scope_readiness(empty, "CONTEST_CODE", contests, "CONTEST_CODE", bmap, "CONTEST_CODE", False).count() == 0
    qr = spark.createDataFrame([("A", True), ("B", True), ("C", None), ("D", False)], "CONTEST_CODE string, V boolean")
    assert rows(C.outside_scope(qr, "V", "CONTEST_CODE", scope, "CONTEST_CODE"), "CONTEST_CODE") == [("B",)]
    assert C.outside_scope(qr, "V", "CONTEST_CODE", empty, "CONTEST_CODE").count() == 0
    assert rows(C.unmapped_choices(qr, "V", ["CONTEST_CODE"]), "CONTEST_CODE") == sorted([("C",), ("D",)], key=repr)


def test_count_above(spark):
    df = spark.createDataFrame([("p", "e1"), ("p", "e2"), ("q", "e3"), (None, "e4"), (None, "e5"), ("r", None),
                                ("r", None)], "P string, E string")
    assert rows(C.count_above(df, "P", "E", "N", "X"), "P", "N") == [("p", 2)]


def _decide(spark, counts):
    issues = {k: spark.range(n) for k, n in counts.items()}
    checks = [gate.Check(k, k, sev, issues[k]) for k, sev in [("a", fixed.BLOCKING), ("b", fixed.WARNING),
                                                              ("c", fixed.INFO)]]
    summary = gate.summarize(gate.issue_counts(checks))
    return summary, gate.decide(summary).first()


def test_gate_truth_table(spark):
    s, g = _decide(spark, {"a": 2, "b": 1, "c": 4})
    assert (g["PUBLICATION_STATUS"], g["PUBLICATION_DECISION"], g["BLOCKING_CHECK_COUNT"], g["BLOCKING_ISSUE_COUNT"],
            g["REVIEW_ISSUE_COUNT"], g["INFO_ISSUE_COUNT"]) == ("BLOCKED", "DO_NOT_PUBLISH", 1, 2, 1, 4)
    overall = s.filter(F.col("QA_CHECK") == fixed.OVERALL_CHECK).first()
    assert (overall["STATUS"], overall["SEVERITY"], overall["ISSUE_COUNT"]) == ("BLOCKED", "BLOCKING", 1)
    s, g = _decide(spark, {"a": 0, "b": 3, "c": 0})
    assert (g["PUBLICATION_STATUS"], g["PUBLICATION_DECISION"]) == ("READY_WITH_WARNINGS", "REVIEW_BEFORE_PUBLISH")
    overall = s.filter(F.col("QA_CHECK") == fixed.OVERALL_CHECK).first()
    assert (overall["STATUS"], overall["SEVERITY"], overall["ISSUE_COUNT"]) == ("READY_WITH_WARNINGS", "WARNING", 0)
    s, g = _decide(spark, {"a": 0, "b": 0, "c": 9})
    assert (g["PUBLICATION_STATUS"], g["PUBLICATION_DECISION"], g["INFO_CHECK_COUNT"]) == ("READY", "READY_TO_PUBLISH", 1)
    statuses = {r["QA_CHECK"]: r["STATUS"] for r in s.collect()}
    assert statuses == {"a": "PASS", "b": "PASS", "c": "INFO", fixed.OVERALL_CHECK: "READY"}


def test_issue_samples(spark):
    issues = {"a": spark.range(12).withColumnRenamed("id", "K"), "b": spark.range(0), "c": spark.range(3)}
    checks = [gate.Check(k, k.upper(), fixed.BLOCKING, df) for k, df in issues.items()]
    s = gate.issue_samples(checks, 5)
    got = {}
    for r in s.collect():
        got.setdefault(r["QA_CHECK"], []).append(r)
    assert sorted(got) == ["A", "C"]
    assert len(got["A"]) == 5 and {r["ISSUE_COUNT"] for r in got["A"]} == {12}
    assert {r["OMITTED_COUNT"] for r in got["A"]} == {7} and {r["OMITTED_COUNT"] for r in got["C"]} == {0}
    # deterministic: the first rows in JSON order
    assert sorted(r["SAMPLE_ROW"] for r in got["A"]) == sorted(f'{{"K":"{i}"}}' for i in [0, 1, 10, 11, 2])


def _listed_by_one_query(checks):
    return sorted((r["QA_CHECK"], r["ISSUE_COUNT"]) for r in gate.issue_counts(checks).collect())


def test_checks_counted_apart_are_the_same(spark):
    from tallycheck.session import deletes_shuffles

    df = spark.createDataFrame([(None, -1), ("a", None), ("a", 2), ("b", 3)], "k string, v int")
    wrong = F.count_if(F.col("v").isNull() | (F.col("v") < 0))
    checks = [gate.Check("d", "D", fixed.BLOCKING, C.duplicate_rows(df, ["k"], ["v"]), (), C.duplicate_count(df, ["k"], ["v"])),
              gate.Check("w", "W", fixed.WARNING, C.null_or_negative(df, ["k"], "v", "X"), ((df, wrong), (df, F.count_if(F.lit(False))))),
              gate.Check("m", "M", fixed.INFO, C.missing_from(df, df.filter("k = 'b'"), ["k"], None, ["k", "v"], "X")),
              gate.Check("n", "N", fixed.INFO, df.limit(0))]
    queries = []
    collect = type(df).collect
    try:
        type(df).collect = lambda self: (queries.append(1), collect(self))[1]
        got = deletes_shuffles(lambda spark: gate.counts_apart(checks))(spark)
    finally:
        type(df).collect = collect
    assert got == [(1, "D", fixed.BLOCKING, 2), (2, "W", fixed.WARNING, 2), (3, "M", fixed.INFO, 3), (4, "N", fixed.INFO, 0)]
    assert sorted((n, c) for _, n, _, c in got) == _listed_by_one_query(checks) and len(queries) == 4


def test_samples_of_parts_are_those_of_the_whole(spark):
    # one query a check, or part of one: its shuffles can go before the next begins
    df = spark.createDataFrame([("p", "c", 1, 5, 7), ("p", "c", 2, 5, 8), ("q", "c", 1, 1, 1), ("q", "c", 1, 2, None),
                                ("é", "c", 4, 2, 1), ("é", "c", 5, 3, 1), ("z", "c", None, None, None)], "P string, C string, A int, B int, D int")
    whole = C.inconsistent_values(df, ["P", "C"], ["A", "B", "D"])
    parts = tuple(C.inconsistent_values(df, ["P", "C"], [f]) for f in "ABD")
    assert sorted(map(str, whole.collect())) == sorted(str(r) for part in parts for r in part.collect())
    assert C.inconsistent_count(df, ["P", "C"], ["A", "B", "D"]).first()["n"] == whole.count() == 5
    samples = [gate.issue_samples([gate.Check("r", "R", fixed.INFO, whole, (), None, x)], 3).collect() for x in ((), parts)]
    assert sorted(map(str, samples[0])) == sorted(map(str, samples[1])) and len(samples[0]) == 3
    assert {(r["ISSUE_COUNT"], r["OMITTED_COUNT"]) for r in samples[1]} == {(5, 2)}


def test_keys_are_combined_before_they_are_looked_up(spark):
    # 30,000 rows of two keys: what is joined is two rows, not all
    df = spark.range(30000).select(F.when(F.col("id") % 2 == 0, "x").alias("k"), F.col("id").alias("v"))
    parent = spark.range(5).select(F.col("id").cast("string").alias("p"))
    out = C.missing_from(df, parent, ["k"], ["p"], ["k"], "X")
    assert rows(out, "k") == sorted([("x",), (None,)], key=repr)
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")  # a parent that has to be shuffled
    try:
        plan = C.missing_from(df, parent, ["k"], ["p"], ["k"], "X")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert plan.index("LeftAnti") < plan.index("Aggregate [k")
    assert C.missing_from(df, parent, ["k"], ["p"], ["k", "v"], "X").count() == 30000
