"""One key holding a third of all rows: results stay whole and exact, and the
plans aggregate map-side before shuffling (no per-group collection)."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tallycheck.operators import checks as C
from tallycheck.operators import rollups
from tallycheck.operators.reconcile import reconcile


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def skewed(spark, n=30000):
    # a third of the rows carry precinct 'HOT'; the rest are spread over 10,000 precincts
    return (spark.range(n)
            .withColumn("P", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("p"), (F.col("id") % 10000).cast("string"))))
            .withColumn("C", (F.col("id") % 5).cast("string"))
            .withColumn("V", (F.col("id") % 7).cast("bigint")))


def test_duplicates_on_a_hot_key(spark):
    df = skewed(spark)
    out = C.duplicate_rows(df, ["P", "C"], ["V"])
    got = out.filter(F.col("P") == "HOT").count()
    # HOT x 5 contests x the distinct V values each (id % 3 == 0 and id % 5 fixed -> V cycles through 7 values)
    assert got == 5 * 7
    text = plan(out)
    assert "partial_count" in text and "collect_list" not in text and "collect_set" not in text


def test_counts_and_rollup_on_a_hot_key(spark):
    df = skewed(spark)
    counts = C.count_above(df, "P", "id", "N", "X")
    assert counts.filter(F.col("P") == "HOT").first()["N"] == 10000
    assert "partial_count" in plan(counts)
    csv = df.groupBy("P", "C").agg(F.sum("V").alias("V"))
    qr = csv.withColumn("V", F.when(F.col("C") == "0", F.col("V") + 1).otherwise(F.col("V")))
    scope = spark.createDataFrame([(str(i),) for i in range(5)], "CONTEST_CODE string")
    cmp = reconcile(csv, qr, ["P", "C"], csv_votes="V", qr_votes="V", scope=scope, scope_on="C",
                    scope_key="CONTEST_CODE").withColumnRenamed("P", "CLUSTERED_PRECINCT_ID")
    hot = rollups.entity_status(cmp).filter(F.col("CLUSTERED_PRECINCT_ID") == "HOT").first()
    assert (hot["MATCHED_ROW_COUNT"], hot["MISMATCH_ROW_COUNT"], hot["PRECINCT_STATUS"]) == (4, 1, "MISMATCH")
    assert "collect_list" not in plan(rollups.entity_status(cmp))
