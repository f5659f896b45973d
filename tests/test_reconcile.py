import pytest
from pyspark.sql import functions as F

from tallycheck.operators.reconcile import DuplicateKeyError, reconcile
from tests.conftest import rows

KEYS = ["P", "C", "K"]
CSV = [("p1", "A", "1", 10), ("p1", "A", "2", 5), ("p1", "A", "3", None), ("p2", "A", "1", 7),
       ("p3", "N", "1", 4), (None, "A", "9", 1)]
QR = [("p1", "A", "1", 10), ("p1", "A", "2", 6), ("p1", "A", "3", 3), ("p4", "A", "1", 2)]


def frames(spark, csv=CSV, qr=QR):
    c = spark.createDataFrame(csv, "P string, C string, K string, V bigint")
    q = spark.createDataFrame(qr, "P string, C string, K string, V bigint")
    scope = spark.createDataFrame([("A",)], "CONTEST_CODE string")
    return c, q, scope


@pytest.mark.parametrize("guard", ["eager", "inline", "off"])
def test_six_outcomes(spark, guard):
    c, q, scope = frames(spark)
    out = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", scope=scope, scope_on="C",
                    scope_key="CONTEST_CODE", guard=guard)
    got = rows(out, "FINAL_COMPARISON_KEY", "COMPARISON_STATUS", "COMPARISON_REASON", "STATUS_SORT",
               "IS_QR_VERIFICATION_SCOPE", "VOTE_DIFFERENCE")
    assert got == sorted([
        ("p1|A|1", "MATCHED", "VOTES_EQUAL", 1, True, 0),
        ("p1|A|2", "MISMATCH", "VOTES_DIFFER", 2, True, 1),
        ("p1|A|3", "MISMATCH", "MISSING_VOTE_VALUE", 2, True, 3),
        ("p2|A|1", "CSV_ONLY", "QR_CHOICE_MISSING_FOR_IN_SCOPE_CSV_ROW", 3, True, None),
        ("p3|N|1", "CSV_ONLY", "CSV_CONTEST_OUTSIDE_QR_SCOPE", 3, False, None),
        ("p4|A|1", "QR_ONLY", "CSV_CHOICE_MISSING", 4, True, None),
    ], key=repr)
    # a CSV row with a null key part never takes part
    assert out.filter(F.col("K") == "9").count() == 0


def test_row_count_invariant(spark):
    c, q, scope = frames(spark)
    out = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", scope=scope, scope_on="C", scope_key="CONTEST_CODE")
    keys = c.dropna(subset=KEYS).select(*KEYS).union(q.select(*KEYS)).distinct().count()
    assert out.count() == keys


def test_eager_guard_reports_each_side(spark):
    c, q, scope = frames(spark, csv=CSV + [("p1", "A", "1", 11)])
    with pytest.raises(DuplicateKeyError, match=r"CSV: 1 keys .*p1\|A\|1"):
        reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", guard="eager")
    c, q, scope = frames(spark, qr=QR + [("p4", "A", "1", 3), ("p1", "A", "2", 1)])
    with pytest.raises(DuplicateKeyError, match=r"QR: 2 keys "):
        reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", guard="eager")


def test_inline_guard_fails_the_job(spark):
    c, q, scope = frames(spark, qr=QR + [("p4", "A", "1", 3)])
    out = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", guard="inline")
    with pytest.raises(Exception, match=r"QR: key occurs more than once: p4\|A\|1"):
        out.collect()


def test_guard_sees_a_hot_key_without_a_window(spark):
    # a third of the rows carry one key
    many = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("P"), F.lit("A").alias("C"),
        F.lit("1").alias("K"), F.col("id").alias("V"))
    _, q, _ = frames(spark)
    out = reconcile(many, q, KEYS, csv_votes="V", qr_votes="V", guard="inline")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match=r"CSV: key occurs more than once: hot\|A\|1"):
        out.collect()
    with pytest.raises(DuplicateKeyError, match=r"CSV: 1 keys .*hot\|A\|1"):
        reconcile(many, q, KEYS, csv_votes="V", qr_votes="V", guard="eager")


def test_empty_inputs(spark):
    c, q, scope = frames(spark, csv=[], qr=[])
    out = reconcile(c, q, KEYS, csv_votes="V", qr_votes="V", scope=scope, scope_on="C", scope_key="CONTEST_CODE")
    assert out.count() == 0 and "COMPARISON_STATUS" in out.columns
