import datetime as dt

import pytest

from tallycheck.contracts import HeaderCollision, normalize_headers
from tallycheck.functions import (
    apply_alias, classify_in, clean_text, composite_key, lenient_key, match_name, minute_bucket,
    normalize_geo, normalize_header, parse_first, parse_flag, parse_instant, percent,
    repair_unclosed_paren, safe_ratio, to_local, whole_number,
)


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r["o"] for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    got = one_col(spark, [" x ", "\tx\t", "", "   ", None, "　a b\xa0", "\x1cy\x1f"], clean_text)
    assert got == ["x", "x", None, None, None, "a b", "y"]


@pytest.mark.parametrize("text,want", [
    ("1,234", 1234), ("12.0", 12), ("1e3", 1000), ("-3", -3), (" 7 ", 7), ("+5", 5), ("1_000", 1000),
    ("120e-1", 12), ("1.5", None), ("abc", None), ("inf", None), ("nan", None), ("1d", None), ("", None),
    ("   ", None), ("1e400", None), ("99999999999999999999", None), ("- 3", None), ("0x10", None),
])
def test_whole_number(spark, text, want):
    assert one_col(spark, [text], whole_number) == [want]


def test_whole_number_null(spark):
    assert one_col(spark, [None], whole_number) == [None]


def test_parse_first_layouts(spark):
    want = dt.datetime(2025, 5, 13, 1, 2, 3)
    texts = ["05-13-2025:01:02:03", "2025-05-13 01:02:03", "05/13/2025 01:02:03", "5/13/2025 1:02",
             "2025-05-13T01:02:03", "2025-05-13", "5-13-2025:1:2:3", "02-30-2025:01:02:03",
             "2025-05-13T01:02:03Z", " 2025-05-13", "junk", None]
    got = one_col(spark, texts, parse_first)
    assert got == [want, want, want, dt.datetime(2025, 5, 13, 1, 2), want, dt.datetime(2025, 5, 13), want,
                   None, None, None, None, None]


def test_parse_flag(spark):
    assert one_col(spark, ["TRUE", " false ", "1", "0", "x", "", None], parse_flag) == \
        [True, False, True, False, None, None, None]


def test_parse_instant_and_local(spark):
    got = one_col(spark, ["2025-05-13T16:30:00Z", "2025-05-13T16:30:00+08:00", "2025-05-13 16:30:00", "bad"],
                  lambda c: to_local(parse_instant(c)))
    assert got == [dt.datetime(2025, 5, 14, 0, 30), dt.datetime(2025, 5, 13, 16, 30),
                   dt.datetime(2025, 5, 14, 0, 30), None]
    assert one_col(spark, [dt.datetime(2025, 5, 13, 16, 30, 59)], minute_bucket, "timestamp_ntz") == \
        [dt.datetime(2025, 5, 13, 16, 30)]


def test_repair_unclosed_paren(spark):
    assert one_col(spark, ["A (B", "A (B)", "A (", "plain", None], repair_unclosed_paren) == \
        ["A (B)", "A (B)", "A (", "plain", None]


def test_geo_and_alias(spark):
    assert one_col(spark, ["City of  Cotabato", "special geographic areas!", None, "\tSan\x01Jose-Norte "],
                   normalize_geo) == ["COTABATO CITY", "SPECIAL GEOGRAPHIC AREA", "", "SAN JOSE NORTE"]
    assert one_col(spark, [" tagoloan ", "Tagoloan II", "Other", None], apply_alias) == \
        ["TAGOLOAN II", "Tagoloan II", "Other", None]
    assert one_col(spark, ["  juan   DE la  cruz "], match_name) == ["JUAN DE LA CRUZ"]


def test_classify_and_keys(spark):
    df = spark.createDataFrame([("01295000", "7"), ("X", None), (None, "1")], "a string, b string")
    out = df.select(classify_in("a", ["01295000"], "Region-wide", "Local district").alias("s"),
                    composite_key("a", "b").alias("k"), lenient_key("a", "b").alias("l")).collect()
    assert [tuple(r) for r in out] == [("Region-wide", "01295000|7", "01295000|7"),
                                       ("Local district", None, "X|"), ("Local district", None, "|1")]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (5, -2), (1, 8)], "n int, d int")
    out = df.select(safe_ratio("n", "d").alias("r"), safe_ratio("n", "d", positive_only=True).alias("p"),
                    percent(safe_ratio("n", "d")).alias("pct")).collect()
    assert [tuple(r) for r in out] == [(0.3333, 0.3333, 33.33), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0),
                                       (-2.5, 0.0, -250.0), (0.125, 0.125, 12.5)]


def test_headers(spark):
    assert normalize_header("Candidate Code") == "CANDIDATE_CODE"
    assert normalize_header("  party-name  ") == "PARTY_NAME"
    assert normalize_header("a/b") == "A_B"
    assert normalize_header("__x  -- y__") == "X_Y"
    df = spark.createDataFrame([(1, 2)], "`Candidate Code` int, `x` int")
    assert normalize_headers(df).columns == ["CANDIDATE_CODE", "X"]
    with pytest.raises(HeaderCollision):
        normalize_headers(spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int"))


def test_scalar_ratio_rounds_the_binary_quotient(spark):
    from tallycheck.functions import scalar_ratio

    pairs = [(2469, 20000), (1235, 100000), (1, 20000), (1, 32), (3, 32), (5, 32), (0, 7), (7, 0), (7, None), (None, 7),
             (123456, 10), (1, 3), (15, 200000)] + [(n, 20000) for n in range(0, 2000, 7)] + [(n, 3200) for n in range(900)]
    df = spark.createDataFrame(pairs, "n long, d long").select("n", "d", scalar_ratio("n", "d").alias("r"))
    for n, d, r in df.collect():
        want = 0.0 if not d else None if n is None else round(n / d, 4)
        assert (r or 0.0) == (want or 0.0), (n, d)


def test_whole_number_keeps_tiny_fractions_apart_from_zero(spark):
    from tallycheck.functions import whole_number

    texts = {"1e-20": None, "0.0000000000000000001": None, "0.0": 0, "-0": 0, "1e3": 1000, "12.50": None, "1_000.0": 1000,
             "9223372036854775807": 9223372036854775807, "1e19": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", whole_number("t").alias("n"))
    assert {r["t"]: r["n"] for r in df.collect()} == texts


def test_receipt_times_in_other_layouts(spark):
    import datetime as dt

    from tallycheck.functions import parse_instant

    at = dt.datetime(2025, 5, 13, 10, 0)
    texts = {"05/13/2025 10:00": at, "5/13/2025 10:00:00": at, "2025-05-13T18:00:00+08:00": at, "2025/05/13 10:00": at,
             " 2025-05-13 10:00 ": at, "10:30": None, "13/05/2025 10:00": None, "": None, None: None, "2025-05-13": dt.datetime(2025, 5, 13)}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_instant("t").alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == texts
