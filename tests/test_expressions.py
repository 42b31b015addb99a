from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tezgah.functions.calendar import date_range, dim_date
from tezgah.functions.expressions import (
    attribute_hash, date_key, exact_sum, finite_or_null, guarded_ratio, half_up_int, sales_measures, stored_ratio,
)


def one(frame):
    return frame.collect()[0]


def test_half_up_int_rounds_halves_away_from_zero(spark):
    frame = spark.createDataFrame([(D("2.5"),), (D("-2.5"),), (D("2.4"),)], "x decimal(10,3)")
    assert [r[0] for r in frame.select(half_up_int("x")).collect()] == [3, -3, 2]


def test_guards(spark):
    frame = spark.createDataFrame([(6, 3), (6, 0), (6, -3)], "n int, d int")
    rows = frame.select(
        guarded_ratio("n", "d", otherwise=0).alias("zero"),
        guarded_ratio("n", "d").alias("null"),
        guarded_ratio("n", "d", guard="nonzero").alias("nonzero"),
    ).collect()
    assert [tuple(r) for r in rows] == [(2.0, 2.0, 2.0), (0.0, None, None), (0.0, None, -2.0)]


def test_stored_ratio_rounds_once_and_half_up(spark):
    frame = spark.createDataFrame([(D("1.005"), D("1.00")), (D("-1.005"), D("1.00"))], "n decimal(12,3), d decimal(16,2)")
    rows = frame.select(stored_ratio(F.col("n"), F.col("d"), "decimal(12,2)")).collect()
    assert [r[0] for r in rows] == [D("1.01"), D("-1.01")]


def test_exact_sum_is_exact(spark):
    frame = spark.range(10001).select(F.lit("0.01").cast("decimal(14,2)").alias("x"))
    assert one(frame.agg(exact_sum("x")))[0] == D("100.01")
    assert one(frame.filter("false").agg(exact_sum("x")))[0] is None


def test_hash_skips_nulls_and_spells_booleans(spark):
    frame = spark.createDataFrame([("a", None, True, D("12.50"))], "a string, b string, c boolean, d decimal(5,2)")
    row = one(frame.select(attribute_hash(["a", "b", "c", "d"]).alias("h"), F.md5(F.lit("a|true|12.50")).alias("e")))
    assert row["h"] == row["e"]


def test_nonfinite_becomes_null(spark):
    values = [(float("nan"), "x"), (float("inf"), "x"), (float("-inf"), "x"), (1.5, "x"), (None, "x")]
    frame = spark.createDataFrame(values, "v double, s string")
    assert [r["v"] for r in finite_or_null(frame).collect()] == [None, None, None, 1.5, None]


def test_measures_and_defaults(spark):
    frame = spark.createDataFrame(
        [(D("1.005"), D("3.00"), D("2.00"), D("1.00"), None, None, None)],
        "quantity decimal(10,3), unit_list_price decimal(12,2), unit_selling_price decimal(12,2), "
        "unit_cost decimal(12,2), discount_amount decimal(14,2), customer_sk bigint, campaign_sk bigint",
    )
    row = one(sales_measures(frame))
    assert row["gross_sales_amount"] == D("3.02")
    assert (row["discount_amount"], row["customer_sk"], row["campaign_sk"]) == (D("0.00"), -1, -1)


@pytest.mark.parametrize(
    "day, expected",
    [
        (date(2021, 1, 3), dict(week_of_year=53, day_of_week=7, day_type_id=3, fiscal_year=2020, fiscal_month=12)),
        (date(2024, 2, 1), dict(fiscal_year=2024, fiscal_month=1, fiscal_week=5, fiscal_quarter=1, season="Kış")),
        (date(2024, 6, 1), dict(day_type_id=2, is_weekend=True, season="Yaz", month_name_tr="Haziran", quarter_name="Q2")),
        (date(2024, 12, 31), dict(day_of_year=366, week_start_date=date(2024, 12, 30), fiscal_month=11, fiscal_week=48)),
    ],
)
def test_calendar(spark, day, expected):
    row = one(dim_date(date_range(spark, day, day))).asDict()
    assert {k: row[k] for k in expected} == expected
    assert row["date_id"] == day.year * 10000 + day.month * 100 + day.day


def test_default_calendar_size_and_holidays(spark):
    assert dim_date(date_range(spark, date(2020, 1, 1), date(2030, 12, 31))).count() == 4018
    holidays = spark.createDataFrame(
        [(date(2024, 4, 23), "Ulusal Egemenlik", True, False)],
        "full_date date, holiday_name string, is_public_holiday boolean, is_religious_day boolean",
    )
    days = dim_date(date_range(spark, date(2024, 4, 22), date(2024, 4, 23)), holidays)
    assert [r["day_type_id"] for r in days.orderBy("full_date").collect()] == [1, 4]


def test_date_key(spark):
    assert one(spark.range(1).select(date_key(F.lit(date(1998, 7, 1)))))[0] == 19980701
