import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from slotwise.functions.dates import boundary_diff, fiscal_week, months_before, us_week
from slotwise.functions.rates import pct
from slotwise.sources.calendar import build_calendar


def test_us_week_f3(spark):
    days = ["2025-01-01", "2025-01-04", "2025-01-05", "2025-12-27", "2025-12-28", "2025-12-31",
            "2026-01-01", "2026-01-04"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    got = [r[0] for r in df.select(us_week("d")).collect()]
    assert got == [1, 1, 2, 52, 53, 53, 1, 2]


def test_fiscal_week_f4(spark):
    days = ["2025-01-04", "2025-01-05", "2025-12-31", "2026-01-04", "2026-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    assert [r[0] for r in df.select(fiscal_week("d")).collect()] == [1, 2, 53, 54, 105]


def test_boundary_minutes_f1_f2(spark):
    rows = [("2025-01-01 10:00:59", "2025-01-01 10:06:00", 6),
            ("2025-01-01 10:00:00", "2025-01-01 10:05:59", 5),
            ("2025-01-01 10:00:00", "2025-01-01 09:58:00", -2),
            ("2025-01-01 10:00:00", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, e int").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"), "e")
    for got, exp in df.select(boundary_diff("minute", "a", "b"), "e").collect():
        assert got == exp


def test_boundary_seconds_ignores_fraction(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 10:00:00.900' a, timestamp_ntz'2025-01-01 10:00:01.100' b")
    assert df.select(boundary_diff("second", "a", "b")).first()[0] == 1


def test_months_before_f16():
    assert months_before(dt.date(2025, 8, 31), 6) == dt.date(2025, 2, 28)
    assert months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert months_before(dt.date(2025, 1, 15), 12) == dt.date(2024, 1, 15)


def test_rounding_half_away_from_zero_f17(spark):
    df = spark.createDataFrame([(Decimal("12.25"),), (Decimal("12.35"),), (Decimal("-0.25"),)], "x decimal(6,2)")
    got = [r[0] for r in df.select(F.col("x").cast("decimal(5,1)")).collect()]
    assert got == [Decimal("12.3"), Decimal("12.4"), Decimal("-0.3")]


def test_pct_nullif(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (2, 8)], "n bigint, d bigint")
    got = [r[0] for r in df.select(pct("n", "d")).collect()]
    assert got == [Decimal("33.3"), None, Decimal("25.0")]


def test_calendar_default_range(spark):
    cal = build_calendar(spark)
    assert cal.count() == 730
    r = cal.where("full_date = date'2025-01-04'").first()
    assert (r.date_key, r.day_of_week, r.day_name, r.week_number, r.month_name, r.quarter, r.year,
            r.is_weekend, r.fiscal_week) == (20250104, 7, "Saturday", 1, "January", 1, 2025, True, 1)


def test_recommended_conf_bounds():
    from slotwise.session import recommended_conf

    big = recommended_conf(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "40961"
    small = recommended_conf(10 * 2**30, 64)
    assert small["spark.sql.shuffle.partitions"] == "128"
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
