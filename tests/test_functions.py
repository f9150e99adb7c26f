"""Scalar semantics the models depend on (safe casts, dates, flags)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from subledger.functions import (
    flag,
    iso_date,
    money,
    month_start,
    months_between_boundaries,
    multi_format_date,
    positive_money,
    text_to_bool,
    whole_number,
)


def test_whole_number_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([("0.4",), ("0.5",), ("-0.5",), ("n/a",), (None,), ("12.00",), ("-3",)], "x string")
    got = [r[0] for r in df.select(whole_number("x")).collect()]
    assert got == [Decimal(0), Decimal(1), Decimal(-1), None, None, Decimal(12), Decimal(-3)]


def test_money_under_half_is_not_positive(spark):
    # try_to_number(fee) > 0 is false for 0.12 / 0.30, so the fee becomes null
    df = spark.createDataFrame([("0.12",), ("0.30",), ("0.50",), ("12.345",), ("99999999999",)], "x string")
    got = [r[0] for r in df.select(positive_money("x", 10)).collect()]
    assert got == [None, None, Decimal("0.50"), Decimal("12.35"), None]
    assert [r[0] for r in df.select(money("x", 10)).collect()][3] == Decimal("12.35")


def test_iso_date_is_strict(spark):
    df = spark.createDataFrame([("2024-01-05",), ("05/01/2024",), ("2024-1-5",), ("2024-01-05x",), (None,)],
                               "x string")
    got = [r[0] for r in df.select(iso_date("x")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None, None]


def test_multi_format_is_month_first(spark):
    df = spark.createDataFrame([("2024-01-05",), ("05/01/2024",), ("13/01/2024",), ("13-01-2024",)], "x string")
    got = [r[0] for r in df.select(multi_format_date("x")).collect()]
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 5, 1), dt.date(2024, 1, 13), dt.date(2024, 1, 13)]


def test_month_boundaries_not_whole_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2023, 12, 1), dt.date(2024, 1, 31)),
                                (dt.date(2024, 3, 15), dt.date(2024, 3, 1))], "a date, b date")
    got = [r[0] for r in df.select(months_between_boundaries("a", "b")).collect()]
    assert got == [1, 1, 0]


def test_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(" yes ",), ("1",), ("True",), ("no",), (None,)], "x string")
    assert [r[0] for r in df.select(text_to_bool("x")).collect()] == [True, True, True, False, False]
    assert [r[0] for r in df.select(flag(F.col("x") == "1")).collect()] == [False, True, False, False, False]


def test_month_start_stays_a_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date").select(month_start("d").alias("m"))
    assert df.schema["m"].dataType.simpleString() == "date"
    assert df.first()["m"] == dt.date(2024, 2, 1)
