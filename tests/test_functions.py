import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import functions as R


def column(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    values = ["  a b\t", "", " NaN ", "n/a", "-", "None", "0123", " x　", None, "<NA>"]
    assert column(spark, values, R.clean_text) == [
        "a b", None, None, None, None, None, "0123", "x", None, "<NA>",
    ]


def test_strip_covers_all_white_space(spark):
    import sys

    blanks = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    assert column(spark, [b + "x" + b for b in blanks], R.strip) == ["x"] * len(blanks)


def test_clean_text_of_numbers(spark):
    values = [1234.0, 12345678.5, 0.25, float("nan"), -3.0, 1e15, None]
    got = column(spark, values, lambda c: R.clean_text(c, T.DoubleType()), "double")
    assert got == ["1234", "12345678.5", "0.25", None, "-3", "1000000000000000", None]


@pytest.mark.parametrize(
    "text,number",
    [
        ("$1,234.50", 1234.5), ("€2,500.00", 2500.0), ("- $5,000.00", -5000.0),
        ("12345", 12345.0), ("500", 500.0), ("12.", 12.0), (".5", 0.5), ("+7", 7.0),
        ("1 000", 1000.0), ("12abc34", None), ("abc123", None), ("1.2.3", None),
        ("1-2", None), ("1,2,3", None), ("abc-xyz", None), ("nan", None), ("inf", None),
        ("   ", None), ("", None), ("1e5", None), (None, None), ("9" * 400, None),
    ],
)
def test_parse_number(spark, text, number):
    assert column(spark, [text], R.parse_number) == [number]


def test_parse_number_typed(spark):
    nan, inf = float("nan"), float("inf")
    got = column(spark, [1.5, nan, inf, -inf, None], lambda c: R.parse_number(c, T.DoubleType()), "double")
    assert got == [1.5, None, None, None, None]
    assert column(spark, [True], lambda c: R.parse_number(c, T.BooleanType()), "boolean") == [None]


def test_parse_bool(spark):
    assert column(spark, ["1", " TRUE", "y", "0", "No", "f", "maybe", "", None], R.parse_bool) == [
        True, True, True, False, False, False, None, None, None,
    ]
    got = column(spark, [1.0, 0.0, 2.0], lambda c: R.parse_bool(c, T.DoubleType()), "double")
    assert got == [True, False, None]


def test_channel_currency_card(spark):
    assert column(spark, ["online banking", " pos ", "ATM!", "pigeon", "n/a"], R.normalize_channel) == [
        "ONLINE_BANKING", "POS", "ATM", None, None,
    ]
    assert column(spark, ["usd", " EUR", "kroner", "u5d", "usd\n"], R.normalize_currency) == [
        "USD", "EUR", None, None, "USD",
    ]
    assert column(spark, ["0123", "12", "12345", "12a4"], R.card_suffix) == ["0123", None, None, None]


# What each text reads as, checked by hand against the layouts.
TIMES = {
    "2026-01-02T03:04:05": "2026-01-02T03:04:05",
    "2026-01-02 11:30:00": "2026-01-02T11:30:00",
    "02/01/2026 10:00:00": "2026-01-02T10:00:00",
    "01/13/2026 10:00:00": "2026-01-13T10:00:00",
    "01/13/2026": None,
    "2026-01-02": "2026-01-02T00:00:00",
    "20260102": "2026-01-02T00:00:00",
    "20260102T0304": "2026-01-02T03:04:00",
    "20260102T030405": "2026-01-02T03:04:05",
    "2026-01-02T03": "2026-01-02T03:00:00",
    "2026-01-02T03:04": "2026-01-02T03:04:00",
    "2026-01-02T03:04:05.5": "2026-01-02T03:04:05.500000",
    "2026-01-02T03:04:05,25": "2026-01-02T03:04:05.250000",
    "2026-01-02T03:04:05Z": "2026-01-02T03:04:05+00:00",
    "2026-01-02T03:04:05+05:30": "2026-01-02T03:04:05+05:30",
    "2026-01-02T03:04:05+0530": "2026-01-02T03:04:05+05:30",
    "2026-01-02T03:04:05-08": "2026-01-02T03:04:05-08:00",
    "2026-01-02T03:04:05.123456-00:00": "2026-01-02T03:04:05.123456+00:00",
    "2026-01-02T03:04:05.1234567": "2026-01-02T03:04:05.123456",
    "2026-03-29 02:30:00": "2026-03-29T02:30:00",
    "2026-13-02": None,
    "2026-02-30": None,
    "0000-01-01": None,
    "someday": None,
    "2026/1/2 3:4:5": "2026-01-02T03:04:05",
    "2026/01/02": None,
    "2026-1-2 3:4:5": "2026-01-02T03:04:05",
    "2026-1-2": "2026-01-02T00:00:00",
    "1/2/2026": "2026-02-01T00:00:00",
    "31/12/2025": "2025-12-31T00:00:00",
    "2026-01-02T25:00:00": None,
    "2026-01-02T03:04:05+24:00": None,
    "2026-01-02T03:04:05+05:30:15": "2026-01-02T03:04:05+05:30:15",
    "12:30": None,
    "2026": None,
    "2026-01": None,
    "2026-01-02   10:00:00": "2026-01-02T10:00:00",
    "2026-01-02T": None,
    "99/99/2026 10:00:00": None,
    "2026-01-0203:04": None,
}


def test_timestamp_texts(spark):
    got = column(spark, list(TIMES), R.timestamp_text)
    assert dict(zip(TIMES, got)) == TIMES


def test_timestamp_parts(spark):
    df = spark.createDataFrame([("2026-01-02T03:04:05+05:30",)], "v string")
    row = df.select(
        R.parse_timestamp(F.col("v")).alias("w"),
        R.timestamp_offset(F.col("v")).alias("o"),
        R.instant(R.parse_timestamp(F.col("v")), R.timestamp_offset(F.col("v"))).alias("u"),
    ).first()
    assert row.w == dt.datetime(2026, 1, 2, 3, 4, 5)
    assert row.o == "+05:30"
    assert row.u == dt.datetime(2026, 1, 1, 21, 34, 5)
    typed = spark.createDataFrame([(dt.date(2026, 1, 2),)], "v date")
    assert typed.select(R.timestamp_text(F.col("v"), T.DateType()).alias("o")).first().o == "2026-01-02T00:00:00"


def test_percentage(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 0)], "p int, w int")
    assert [r.o for r in df.select(R.percentage(F.col("p"), F.col("w")).alias("o")).collect()] == [25.0, 0.0, 0.0]
