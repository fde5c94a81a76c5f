"""CAL: the date dimension, generated from a day range (no driver-side loop)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.dates import date_lit, fiscal_week, us_week

# --- fixed values: default calendar range of the source seed ------------------------------
DEFAULT_START = dt.date(2025, 1, 1)
DEFAULT_END = dt.date(2026, 12, 31)
# Calendar rows are broadcast to every task; this bound (about 2,700 years of days, a few
# MB) is what makes that broadcast safe, so build_calendar refuses anything larger.
MAX_CALENDAR_DAYS = 1_000_000


def build_calendar(spark: SparkSession, start: dt.date = DEFAULT_START,
                   end: dt.date = DEFAULT_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, 11 columns.

    day_of_week 1=Sunday..7=Saturday, week_number is the US week (week 1 holds 1 January,
    weeks start on Sunday), fiscal_week counts Sunday weeks from 2025-01-01.
    """
    n_days = (end - start).days + 1
    if n_days <= 0:
        raise ValueError("calendar end precedes start")
    if n_days > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {n_days} days exceeds the broadcast bound {MAX_CALENDAR_DAYS}")
    d = F.col("full_date")
    return (
        spark.range(0, n_days, numPartitions=1)
        .select(F.date_add(date_lit(start), F.col("id").cast("int")).alias("full_date"))
        .select(
            F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
            d,
            F.dayofweek(d).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            us_week(d).alias("week_number"),
            F.month(d).alias("month_number"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.quarter(d).alias("quarter"),
            F.year(d).alias("year"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
            fiscal_week(d).alias("fiscal_week"),
        )
    )


def calendar_days(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


def seed_calendar(spark: SparkSession, path: str, start: dt.date = DEFAULT_START,
                  end: dt.date = DEFAULT_END) -> str:
    """Write the calendar to ``path`` unless it already exists (idempotent seed)."""
    build_calendar(spark, start, end).write.mode("ignore").parquet(path)
    return path
