"""CSV out and in again, files split by what they hold, and publications that are whole."""

import csv
import os

import pytest

from tallycheck.sources import Publication, published, read_text_csv, write_table
from tallycheck.sources import sinks
from tallycheck.sources.files import spanning_files

TEXTS = ['JOSE "PEPE" CRUZ, JR', "a\nb", "a\r\nb", "a\rb", "back\\slash \\", "", None, " lead", "trail ", '"', '""', '\\"',
         "#x", "é", "x,\ny", "'q'", "\t", 'a"b', "\ufeffmark"]


def test_every_text_comes_back(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame(rows, "N int, A string").repartition(1), path, "csv")
    back = read_text_csv(spark, path, empty_is_null=False)
    assert {int(r["N"]): r["A"] for r in back.collect()} == dict(rows)
    assert {int(r["N"]): r["A"] for r in read_text_csv(spark, path).collect()} == {n: t or None for n, t in rows}
    part, = (f for f in os.listdir(path) if f.endswith(".csv"))
    with open(os.path.join(path, part), newline="") as f:
        assert {int(n): t for n, t in list(csv.reader(f))[1:]} == {n: t or "" for n, t in rows}


def test_only_files_with_records_over_lines_are_read_whole(spark, tmp_path):
    folder = tmp_path / "large source"
    folder.mkdir()
    clean = [f'{i},"quoted, ""twice"" {i}",x' for i in range(20_000)]
    (folder / "a.csv").write_text("N,A,B\n" + "\n".join(clean) + "\n")
    (folder / "b.csv").write_text('N,A,B\n20000,"over\ntwo lines",y\n')
    split, whole = spanning_files(spark, str(folder))
    assert [os.path.basename(f) for f in split] == ["a.csv"] and [os.path.basename(f) for f in whole] == ["b.csv"]
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, "64k")
        chosen, all_whole = read_text_csv(spark, str(folder)), read_text_csv(spark, str(folder), multiline=True)
        assert chosen.rdd.getNumPartitions() > 5 > all_whole.rdd.getNumPartitions()
        got = sorted(map(tuple, chosen.collect()))
        assert got == sorted(map(tuple, all_whole.collect()))
        assert len(got) == 20_001 and ("20000", "over\ntwo lines", "y") in got and ("7", 'quoted, "twice" 7', "x") in got
    finally:
        spark.conf.set(key, old)


def test_source_without_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("A,B\n")
    df = read_text_csv(spark, str(tmp_path / "e.csv"))
    assert df.columns == ["A", "B"] and df.count() == 0


def _tables(spark, value):
    return {n: spark.createDataFrame([(n, value)], "NAME string, V int") for n in ("one", "two")}


def _seen(spark, root):
    return {n: int(df.first()["V"]) for n, df in published(spark, root).items()}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_readers_see_one_whole_run(spark, tmp_path, fmt):
    root = str(tmp_path / "out")
    assert published(spark, root) == {}
    first = Publication(spark, root, fmt)
    for name, df in _tables(spark, 1).items():
        first.add(name, df)
        assert published(spark, root) == {}  # nothing before the manifest row
    assert first.publish() and _seen(spark, root) == {"one": 1, "two": 1}
    died = Publication(spark, root, fmt)
    died.add("one", _tables(spark, 2)["one"])  # and never goes on
    assert _seen(spark, root) == {"one": 1, "two": 1}
    third = Publication(spark, root, fmt)
    for name, df in _tables(spark, 3).items():
        third.add(name, df)
    assert third.publish(keep=1) and _seen(spark, root) == {"one": 3, "two": 3}
    assert not os.path.exists(first.path("one")) and os.path.exists(third.path("one"))


def test_run_that_lacks_a_table_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    good = Publication(spark, root)
    for name, df in _tables(spark, 1).items():
        good.add(name, df)
    good.publish()
    write = sinks.write_table

    def failing(df, path, fmt="parquet", mode="overwrite"):
        if path.endswith("/two"):
            raise OSError("disk full")
        write(df, path, fmt, mode)

    monkeypatch.setattr(sinks, "write_table", failing)
    bad = Publication(spark, root)
    reasons = [bad.add(name, df) for name, df in _tables(spark, 2).items()]
    assert reasons == [None, "disk full"] and not bad.publish()
    assert bad.failed == {"two": "disk full"} and _seen(spark, root) == {"one": 1, "two": 1}


def test_tables_are_looked_at_when_they_are_asked_for(spark, tmp_path):
    root = str(tmp_path / "out")
    out = Publication(spark, root)
    for name, df in _tables(spark, 1).items():
        out.add(name, df)
    out.publish()
    read, tables = [], published(spark, root)
    try:
        whole, sinks.read_text_csv = sinks.read_text_csv, lambda s, path, **x: (read.append(path), whole(s, path, **x))[1]
        assert len(tables) == 2 and "one" in tables and read == []
        assert tables["two"].count() == tables["two"].count() == 1 and [x.endswith("/two") for x in read] == [True]
    finally:
        sinks.read_text_csv = whole
