import pytest

from tallycheck.operators.ordering import with_positions


def _places(df, *cols):
    return [tuple(r) for r in df.orderBy("POSITION").select("POSITION", *cols).collect()]


def test_places_are_those_of_a_whole_sort(spark, tmp_path):
    data = [(i % 7 if i % 11 else None, f"t{i % 5}", i) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b string, c int").repartition(6)
    got = _places(with_positions(df, ["a", "b"], folder=str(tmp_path / "x")), "a", "b", "c")
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert got == [(n, *r) for n, r in enumerate(want, 1)]


def test_a_repeated_row_is_spread_over_ranges(spark, tmp_path):
    """The whole table is one row, many times; it's still dealt out."""
    df = spark.range(0, 20000, 1, 8).selectExpr("'x' AS a", "cast(null AS int) AS b")
    size = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_positions(df, ["a"], folder=str(tmp_path / "x"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", size)
    assert [r[0] for r in _places(placed)] == list(range(1, 20001))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "x/ranges"))
             .selectExpr("shiftright(_at, 33) AS part").groupBy("part").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 10000


def test_empty_clashing_and_odd_names(spark):
    df = spark.createDataFrame([], "`a.b` int, _at string, _PART int")
    assert with_positions(df, ["a.b"]).collect() == []
    df = spark.createDataFrame([(2, "u", 1), (1, "v", 2)], "`a.b` int, _at string, _PART int")
    assert _places(with_positions(df, ["a.b"]), "`a.b`", "_at", "_PART") == [(1, 1, "v", 2), (2, 2, "u", 1)]
    with pytest.raises(ValueError):
        with_positions(df, ["a.b"], "_at")
