"""V2 weekly no-show trend, V9 pre-payment funnel, V10 priority on-time.

Plan shape shared by the three: filter the fact on its timestamp (pushed into the parquet
scan), attach (year, US week) from the broadcast calendar with a map-side hash join (which
also drops dates outside the calendar, as the definition's inner join does), and aggregate
per week.  The aggregation is partial in every task, so only one row per week and task is
shuffled, however many rows a hot day or salon has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.dates import boundary_diff, since, ts_lit, weeks_before
from slotwise.functions.rates import count_if, dec, pct, raw_pct
from slotwise.sources.tables import Tables

# --- fixed values: business constants carried in the outputs ----------------------------
BASELINE_NOSHOW = "40.0"
TARGET_NOSHOW = "30.0"
TARGET_PREPAY = "55.0"
TARGET_PRIORITY = "90.0"
ON_TIME_MINUTES = 5


def with_week(df: DataFrame, date_col, t: Tables, start: dt.date | None = None) -> DataFrame:
    """Attach full_date, year and week_number of ``date_col`` (inner join to the calendar)."""
    cal = t.cal().select("full_date", "year", "week_number")
    if start is not None:
        cal = cal.where(F.col("full_date") >= F.lit(start))
    return df.join(cal, date_col == cal.full_date)


def weekly_noshow(t: Tables, as_of: dt.date, weeks: int = 26) -> DataFrame:
    """V2: bookings per (year, US week) over the last ``weeks`` weeks, rate and week-over-week change.

    week_start / week_end are the first and last dates *with bookings*; the change compares
    unrounded rates with the previous week present in the result.
    """
    start = weeks_before(as_of, weeks)
    a = since(t.appointments, "scheduled_at", start).select("scheduled_at", "status")
    wk = with_week(a, F.col("scheduled_at").cast("date"), t, start).groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"),
        F.max("full_date").alias("week_end"),
        F.count(F.lit(1)).alias("total_appointments"),
        count_if(F.col("status") == "no_show").alias("no_shows"),
        count_if(F.col("status") == "attended").alias("attended"),
        count_if(F.col("status") == "rescheduled").alias("rescheduled"))
    w = Window.orderBy("year", "week_number")
    rate = raw_pct("no_shows", "total_appointments")
    return wk.select(
        "year", F.col("week_number").alias("iso_week"), "week_start", "week_end",
        "total_appointments", "no_shows", "attended", "rescheduled",
        pct("no_shows", "total_appointments").alias("no_show_rate_pct"),
        dec(BASELINE_NOSHOW).alias("baseline_pct"),
        dec(TARGET_NOSHOW).alias("target_pct"),
        (rate - F.lag(rate).over(w)).cast("decimal(5,2)").alias("wow_change_pct"),
    )


def fiscal_outcomes(t: Tables, as_of: dt.date, weeks: int = 26) -> DataFrame:
    """Bookings per fiscal week and quarter over the last ``weeks`` weeks, with the date keys of the first and
    last day that has bookings, and how many fell on a weekend.

    A fiscal week that spans two quarters gives a row for each.  Counted per day first (partial
    aggregation in every task), so the calendar meets one row a day.
    """
    start = weeks_before(as_of, weeks)
    days = since(t.appointments, "scheduled_at", start).groupBy(F.col("scheduled_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("status") == "no_show").alias("missed"))
    g = days.join(t.cal(), F.col("day") == F.col("full_date")).groupBy("year", "quarter", "fiscal_week").agg(
        F.min("date_key").alias("first_date_key"), F.max("date_key").alias("last_date_key"),
        F.sum("n").alias("total_appointments"), F.sum("missed").alias("no_shows"),
        F.sum(F.when(F.col("is_weekend"), F.col("n")).otherwise(F.lit(0))).alias("weekend_appointments"))
    return g.withColumn("no_show_rate_pct", pct("no_shows", "total_appointments"))


def prepay_funnel(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """V9: bookings *created* per (year, US week) at prepay-enabled salons and how they paid."""
    start = weeks_before(as_of, weeks)
    enabled = t.salons.where(F.col("prepay_enabled")).select("salon_id")
    paid = F.col("payment_status") == "successful"
    a = (t.appointments.where(F.col("created_at") >= ts_lit(start))
         .join(enabled, "salon_id", "left_semi"))
    wk = with_week(a, F.col("created_at").cast("date"), t, start).groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"),
        F.count(F.lit(1)).alias("eligible_bookings"),
        count_if(F.col("payment_status") != "not_applicable").alias("chose_prepay"),
        count_if(paid).alias("paid_successfully"),
        count_if(F.col("payment_status") == "failed").alias("payment_failed"),
        count_if(F.col("payment_status") == "expired").alias("slot_hold_expired"),
        F.avg(F.when(paid, F.col("discount_pct"))).alias("avg_discount"),
        F.sum(F.when(paid, F.col("amount_paid")).otherwise(F.lit(0))).alias("revenue"),
        F.sum(F.when(paid, F.col("original_price") * F.col("discount_pct") / F.lit(100))
              .otherwise(F.lit(0))).alias("discount_value"))
    return wk.select(
        "year", "week_number", "week_start", "eligible_bookings", "chose_prepay", "paid_successfully",
        "payment_failed", "slot_hold_expired",
        pct("paid_successfully", "eligible_bookings").alias("adoption_rate_pct"),
        dec(TARGET_PREPAY).alias("adoption_target_pct"),
        F.coalesce(F.col("avg_discount").cast("decimal(9,6)"), dec("0").cast("decimal(9,6)")).alias("avg_discount_pct"),
        F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(38,2)").alias("prepay_revenue"),
        F.coalesce(F.col("discount_value"), F.lit(0)).cast("decimal(38,6)").alias("discount_value_given"),
    )


def priority_ontime(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """Priority bookings per (year, US week); on time = attended and marked at most
    5 minute boundaries after the scheduled time (early counts as on time)."""
    start = weeks_before(as_of, weeks)
    mins = boundary_diff("minute", "scheduled_at", "marked_at")
    attended = F.col("status") == "attended"
    a = since(t.appointments, "scheduled_at", start).where(F.col("is_priority"))
    wk = with_week(a, F.col("scheduled_at").cast("date"), t, start).groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"),
        F.count(F.lit(1)).alias("priority_appointments"),
        count_if(attended & (mins <= ON_TIME_MINUTES)).alias("on_time_count"),
        count_if(attended & (mins > ON_TIME_MINUTES)).alias("late_count"))
    return wk.select(
        "year", "week_number", "week_start", "priority_appointments", "on_time_count", "late_count",
        pct("on_time_count", "priority_appointments").alias("on_time_rate_pct"),
        dec(TARGET_PRIORITY).alias("target_pct"),
    )
