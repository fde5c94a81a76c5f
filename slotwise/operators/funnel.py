"""V4 monthly conversion funnel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import booked_since, months_before, since
from slotwise.functions.rates import count_if, pct
from slotwise.sources.tables import Tables


def reminder_flags(t: Tables, corrected: bool = False, start: dt.date | None = None) -> DataFrame:
    """Per appointment: was any reminder delivered / acted on (one row per appointment); with ``start`` only
    bookings from then on are sure to be there."""
    action = F.col("customer_action")
    engaged = action.isin("reschedule", "cancel") if corrected else action.isNotNull()
    events = booked_since(t.reminder_events, start) if start else t.reminder_events
    return events.groupBy("appointment_id").agg(
        F.max(F.when(F.col("delivery_status") == "sent", 1).otherwise(0)).alias("was_delivered"),
        F.max(F.when(engaged, 1).otherwise(0)).alias("was_engaged"),
    )


def conversion_funnel(t: Tables, as_of: dt.date, months: int = 6, corrected: bool = False, flags: DataFrame | None = None) -> DataFrame:
    """V4: per calendar month of the scheduled date, bookings, delivered, engaged,
    attended-or-rescheduled and no-show counts with their share of bookings.

    ``flags``: ``reminder_flags`` kept elsewhere.  Steps are not nested.  appointment_id is the key of appointments and the reminder flags
    are one row per appointment, so the distinct counts of the definition are plain
    conditional counts (checked by ``quality.duplicate_keys``), partially aggregated per task
    after the map-side calendar join.
    """
    start = months_before(as_of, months)
    appts = since(t.appointments, "scheduled_at", start).select(
        "appointment_id", "status", F.col("scheduled_at").cast("date").alias("d"))
    j = appts.join(reminder_flags(t, corrected, start) if flags is None else flags, "appointment_id", "left")
    cal = t.cal().select("full_date", "year", "month_number", "month_name")
    steps = ["step1_bookings", "step2_reminder_delivered", "step3_reminder_engaged",
             "step4_attended_rescheduled", "step5_no_show"]
    m = (j.join(cal, j.d == cal.full_date)
         .groupBy("year", "month_number", "month_name")
         .agg(F.count(F.lit(1)).alias("step1_bookings"),
              count_if(F.col("was_delivered") == 1).alias("step2_reminder_delivered"),
              count_if(F.col("was_engaged") == 1).alias("step3_reminder_engaged"),
              count_if(F.col("status").isin("attended", "rescheduled")).alias("step4_attended_rescheduled"),
              count_if(F.col("status") == "no_show").alias("step5_no_show")))
    return m.select(
        "year", "month_number", "month_name",
        F.make_date("year", "month_number", F.lit(1)).alias("month_start"),
        *steps,
        pct("step2_reminder_delivered", "step1_bookings").alias("pct_delivered"),
        pct("step3_reminder_engaged", "step1_bookings").alias("pct_engaged"),
        pct("step4_attended_rescheduled", "step1_bookings").alias("pct_attended"),
        pct("step5_no_show", "step1_bookings").alias("pct_no_show"),
    )
