import os

import pytest

from tallycheck.contracts import (
    ELECTION_CONTRACTS, Contract, Field, MissingRequiredColumn, enforce, ensure_columns, project, rename_aliases,
)
from tallycheck.sources import empty_table, literal_table, read_text_csv, read_with_policy, write_table
from tallycheck.sources.files import MissingReference
from tallycheck.sources.sinks import try_write


def test_enforce_required_and_optional(spark):
    c = Contract("t", (Field("A"), Field("N", "bigint", required=False)))
    df = enforce(spark.createDataFrame([("x",)], "A string"), c)
    assert df.dtypes == [("A", "string"), ("N", "bigint")] and df.first()["N"] is None
    with pytest.raises(MissingRequiredColumn, match="t has no column A"):
        enforce(spark.createDataFrame([(1,)], "N bigint"), c)
    assert ELECTION_CONTRACTS["results"].required[:3] == ["PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE"]
    with pytest.raises(ValueError, match="unknown dataset"):
        ensure_columns(df, "nope")
    out = ensure_columns(spark.createDataFrame([("p", "n")], "PARTIES_CODE string, PARTIES_NAME string"), "parties")
    assert out.columns == ["PARTIES_CODE", "PARTIES_NAME", "PARTIES_ALIAS"]


def test_aliases_only_when_target_absent(spark):
    df = spark.createDataFrame([(1, 2)], "PARTY_CODE int, X int")
    assert rename_aliases(df, {"PARTY_CODE": "PARTIES_CODE"}).columns == ["PARTIES_CODE", "X"]
    both = spark.createDataFrame([(1, 2)], "PARTY_CODE int, PARTIES_CODE int")
    assert rename_aliases(both, {"PARTY_CODE": "PARTIES_CODE"}).columns == ["PARTY_CODE", "PARTIES_CODE"]
    assert project(df, ["X", "MISSING", "PARTY_CODE"]).columns == ["X", "PARTY_CODE"]


def test_text_csv_reader_and_policy(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('﻿CODE,NAME,N\n01295000,"Santos, Pedro",NA\n,  x ,1\n')
    df = read_text_csv(spark, str(p))
    assert df.columns == ["CODE", "NAME", "N"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(
        [("01295000", "Santos, Pedro", "NA"), (None, "  x ", "1")], key=repr)
    assert read_text_csv(spark, str(p), na_tokens=["NA"]).filter("N IS NULL").count() == 1
    fallback = literal_table(spark, [("F",)], "CODE string")
    got, used = read_with_policy(spark, str(tmp_path / "absent.csv"), "fallback", fallback)
    assert used and got.first()["CODE"] == "F"
    with pytest.raises(MissingReference):
        read_with_policy(spark, str(tmp_path / "absent.csv"), "raise")
    assert empty_table(spark, "A string, B bigint").dtypes == [("A", "string"), ("B", "bigint")]


def test_reader_keeps_line_breaks_and_reports_rows_it_cannot_place(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('A,B,C\n1,2,3\n8,"line\nbreak",9\n5\n"","q""q",\n')
    got = sorted(map(tuple, read_text_csv(spark, str(p)).collect()), key=repr)
    assert got == sorted([("1", "2", "3"), ("8", "line\nbreak", "9"), ("5", None, None), (None, 'q"q', None)], key=repr)
    for row in ("4,5,6,7", "4,5,6,7,8"):
        p.write_text(f"A,B,C\n1,2,3\n{row}\n")
        df = read_text_csv(spark, str(p), multiline=False)
        with pytest.raises(Exception, match="more fields than the header, first: 4"):
            df.collect()


def test_three_output_contracts():
    assert ELECTION_CONTRACTS["mobile_er"].required[-1] == "SUBMISSION_STATUS"
    assert "VERIFICATION_SOURCE" in ELECTION_CONTRACTS["mobile_qr"].required
    assert "CSV_VOTES" not in ELECTION_CONTRACTS["verification_comparison"].required


def test_write_table(spark, tmp_path):
    df = literal_table(spark, [("a", 1), ("b", 2)], "K string, V bigint")
    write_table(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert try_write(df.repartition(1), str(tmp_path / "c"), fmt="csv") is None
    files = [f for f in os.listdir(tmp_path / "c") if f.endswith(".csv")]
    assert len(files) == 1
    assert try_write(df, str(tmp_path / "x"), fmt="no-such-format")
    with pytest.raises(Exception):
        write_table(df, str(tmp_path / "x"), fmt="no-such-format")
