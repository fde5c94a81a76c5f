"""V3 daily active users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.dates import date_lit, days_before, met_by, within
from slotwise.sources.tables import Tables

# --- fixed values: statuses that count as activity ----------------------------------------
ACTIVE_STATUSES = ["attended", "cancelled", "rescheduled", "no_show"]


def activity(t: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """(activity_date, customer_id, salon_id, appointment_id) rows from appointments with an
    outcome and from reminders the customer acted on, restricted to [start, end] days.

    Rows are not de-duplicated: every consumer counts distinct values per day, which a
    duplicate cannot change, so the extra shuffle of a DISTINCT would buy nothing.
    """
    hi = end + dt.timedelta(days=1)
    appts = (within(t.appointments, "scheduled_at", start, hi)
             .where(F.col("status").isin(ACTIVE_STATUSES))
             .select(F.col("scheduled_at").cast("date").alias("activity_date"),
                     "customer_id", "salon_id", "appointment_id"))
    acted = (within(t.reminder_events, "sent_at", start, hi)
             .where(F.col("customer_action").isNotNull()))
    booked = met_by(t.appointments, acted).select("appointment_id", "customer_id", "salon_id")
    acted = acted.select("appointment_id", F.col("sent_at").cast("date").alias("activity_date"))
    via_reminders = acted.join(booked, "appointment_id")
    return appts.unionByName(via_reminders)


def daily_active_users(t: Tables, as_of: dt.date, days: int = 90, corrected: bool = False) -> DataFrame:
    """V3: one row per calendar day in [as_of - days, as_of]; days without activity show 0.

    dau_7day_avg is the mean of the current and up to 6 previous rows, truncated to an
    integer as written (integer AVG); ``corrected=True`` keeps two decimals.
    """
    start = days_before(as_of, days)
    daily = (activity(t, start, as_of).groupBy("activity_date")
             .agg(F.count_distinct("customer_id").alias("dau"),
                  F.count_distinct("salon_id").alias("active_salons"),
                  F.count_distinct("appointment_id").alias("active_appointments")))
    return over_calendar(t, daily, as_of, days, corrected)


def over_calendar(t: Tables, daily: DataFrame, as_of: dt.date, days: int = 90, corrected: bool = False) -> DataFrame:
    """V3 from the daily figures (activity_date, dau, active_salons, active_appointments), however kept."""
    start = days_before(as_of, days)
    cal = t.cal().where(F.col("full_date").between(date_lit(start), date_lit(as_of)))
    j = cal.join(daily, cal.full_date == daily.activity_date, "left")
    w = Window.orderBy("full_date").rowsBetween(-6, 0)
    dau = F.coalesce(F.col("dau"), F.lit(0))
    if corrected:
        avg7 = F.avg(dau).over(w).cast("decimal(12,2)")
    else:
        avg7 = F.floor(F.sum(dau).over(w) / F.count(dau).over(w)).cast("bigint")
    return j.select(
        F.col("full_date").alias("activity_date"), "day_name", "week_number", "month_name", "year",
        dau.alias("dau"),
        F.coalesce(F.col("active_salons"), F.lit(0)).alias("active_salons"),
        F.coalesce(F.col("active_appointments"), F.lit(0)).alias("active_appointments"),
        avg7.alias("dau_7day_avg"),
    )
