"""Scalar expressions: the traps between engines, one case each."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.functions import conversions as conv
from ringlens.functions.phones import DIALABLE, join_key, phone_origin, strip_country
from ringlens.functions.timing import DayWindow, day_number, epoch_second, naive_time, weekday

TEXT = T.StringType()


def values(spark, rows, column, kind="string"):
    """The expression over single-column rows, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_join_key(spark):
    got = values(spark, ["+84 912-345-678", None, "  ", "000123", "abc", "\t", "000"], join_key(F.col("v")))
    assert got == ["84912345678", "", "", "123", "0", "", "0"]


def test_strip_country(spark):
    got = values(spark, ["+84912", "84912", "+912", "8484912", "++84", None, "912+84"], strip_country(F.col("v")))
    assert got == ["912", "912", "912", "84912", "+84", None, "912+84"]


@pytest.mark.parametrize(
    ("raw", "ok"),
    [
        ("1234", True), ("123", False), ("841234", True), ("84123", False), ("+841234", True), ("++841234", False),
        ("1" * 18, True), ("1" * 19, False), ("84" + "1" * 18, True), ("12a4", False), ("1234\n", False), ("", False),
    ],
)
def test_dialable_agrees_with_stripping(spark, raw, ok):
    assert values(spark, [raw], F.col("v").rlike(DIALABLE)) == [ok]
    stripped = values(spark, [raw], strip_country(F.col("v")))[0]
    assert ok == (4 <= len(stripped) <= 18 and all(c in "0123456789" for c in stripped))


def test_phone_origin(spark):
    expected = {
        "+84912345678": (False, "091"), "0912000001": (False, "091"), "0243000002": (False, "024"),
        "0225000008": (False, "0225"), "8486000009": (False, "086"), "+2317000003": (True, "231"),
        "+1415000006": (True, "1"), "008490000005": (True, "84"), "1900000004": (True, "1"),
        "0123456789": (True, "012"), "113": (False, "113"), "abc": (False, ""), "": (False, ""),
    }
    got = values(spark, list(expected), phone_origin(F.col("v")))
    assert [tuple(row) for row in got] == list(expected.values())


def test_lenient_numbers(spark):
    raw = ["1", "2.5", "abc", None, "NaN", " 7 ", "1d", "1f", "1e2", "-3", "", ".5", "inf", "1\n2"]
    got = values(spark, raw, conv.numeric_or_null(F.col("v"), TEXT))
    assert got == [1.0, 2.5, None, None, None, 7.0, None, None, 100.0, -3.0, None, 0.5, float("inf"), None]


def test_conversion_defaults(spark):
    raw = ["2.9", "-2.9", "x", None, "inf", "99999999999"]
    assert values(spark, raw, conv.int_or(F.col("v"), TEXT, 7)) == [2, -2, 7, 7, 7, 99_999_999_999]
    assert values(spark, ["1e30", "-1e30"], conv.int_or(F.col("v"), TEXT)) == [2**63 - 1, -(2**63)]
    assert values(spark, raw[:4], conv.double_or(F.col("v"), TEXT, 1.5)) == [2.9, -2.9, 1.5, 1.5]
    got = values(spark, ["TRUE", "yes", "1", "0", "no", None], conv.bool_or(F.col("v"), TEXT, True))
    assert got == [True, True, True, False, False, True]


def test_integer_casts_round_half_to_even(spark):
    got = values(spark, [2.5, 3.5, -0.5, 1.2], conv.round_half_even(F.col("v"), "bigint"), "double")
    assert got == [2, 4, 0, 1]
    assert values(spark, ["1.7", "1e2", "5"], conv.strict_int(F.col("v"), TEXT)) == [2, 100, 5]


def test_ratio_is_double_and_safe(spark):
    got = values(spark, [3, 0], conv.ratio(F.lit(5), F.col("v")), "int")
    assert got == [5 / 3, 0.0]


def test_two_decimals_like_printf(spark):
    numbers = [0.125, 0.285, 0.005, 0.375, 0.995, 0.15, 1.0, 0.0]
    assert values(spark, numbers, conv.two_decimals(F.col("v")), "double") == [f"{x:.2f}" for x in numbers]


def test_gaps_count_second_boundaries(spark):
    times = [
        datetime(2024, 1, 1, 0, 0, 0, 900_000), datetime(2024, 1, 1, 0, 0, 1, 100_000),
        datetime(1969, 12, 31, 23, 59, 58, 500_000), datetime(1970, 1, 1),
    ]
    got = values(spark, times, epoch_second(F.col("v")), "timestamp_ntz")
    assert got[1] - got[0] == 1
    assert got[2:] == [-2, 0]


def test_seconds_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = values(spark, [datetime(2024, 3, 10, 2, 30)], epoch_second(F.col("v")), "timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [1710037800]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Ho_Chi_Minh"])
def test_day_window_does_not_depend_on_the_session_zone(spark, zone):
    window = DayWindow(date(2024, 1, 30), 7)
    raw = ["2024-01-23 23:59:59", "2024-01-24 00:00:00", "2024-01-30 23:59:59", "2024-01-31 00:00:00"]
    kept = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert values(spark, raw, window.contains(F.col("v"), TEXT)) == [False, True, True, False]
        naive = window.contains(F.col("v").cast("timestamp_ntz"), T.TimestampNTZType())
        assert values(spark, raw, naive) == [False, True, True, False]
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_weekday_and_day(spark):
    days = [date(1969, 12, 29), date(1970, 1, 1), date(2024, 1, 28), date(2024, 2, 29)]
    times = [datetime(d.year, d.month, d.day, 23, 59, 59) for d in days]
    second = epoch_second(F.col("v"))
    assert values(spark, times, weekday(second), "timestamp_ntz") == [d.weekday() for d in days]
    assert values(spark, times, day_number(second), "timestamp_ntz") == [(d - date(1970, 1, 1)).days for d in days]


def test_partial_dates_are_not_times(spark):
    raw = ["2024", "2024-01", "2024-01-02", "2024-01-02 03:04:05.5", "bad", None, "2024-13-01"]
    got = values(spark, raw, naive_time(F.col("v"), TEXT))
    full = datetime(2024, 1, 2, 3, 4, 5, 500_000)
    assert got == [None, None, datetime(2024, 1, 2), full, None, None, None]


def test_day_window_is_inclusive(spark):
    window = DayWindow(date(2024, 1, 30), 7)
    times = [
        datetime(2024, 1, 23, 23, 59, 59, 999_999), datetime(2024, 1, 24), datetime(2024, 1, 30, 23, 59, 59, 999_999),
        datetime(2024, 1, 31),
    ]
    assert values(spark, times, window.contains(F.col("v"), T.TimestampNTZType()), "timestamp_ntz") == [
        False, True, True, False,
    ]
    assert window.label() == "last_7d_2024-01-24_to_2024-01-30"
