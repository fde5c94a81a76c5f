"""V11 feature adoption per salon."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import booked_since, days_before
from slotwise.functions.rates import pct
from slotwise.operators.kpi import window_appointments
from slotwise.sources.tables import Tables

SALON_COLUMNS = ["salon_id", "salon_name", "city", "plan_tier", "onboarded_at", "reminder_30min",
                 "delay_tracker", "prepay_enabled", "prepay_discount"]


def reminder_counts(t: Tables, corrected: bool = False, start: dt.date | None = None) -> DataFrame:
    """Per appointment: number of reminder events and of those with a customer action; with ``start`` only
    bookings from then on are sure to be there."""
    action = F.col("customer_action")
    engaged = action.isin("reschedule", "cancel") if corrected else action.isNotNull()
    events = booked_since(t.reminder_events, start) if start else t.reminder_events
    return events.groupBy("appointment_id").agg(
        F.count("event_id").alias("n_events"),
        F.count(F.when(engaged, F.lit(1))).alias("n_engaged"),
    )


def feature_adoption(t: Tables, as_of: dt.date, days: int = 30, corrected: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """One row per active salon (also without bookings): toggles, feature count and
    30-day no-show, reminder engagement and prepay adoption.

    As written the booking rows are repeated once per reminder of the booking (at least
    once), so no-shows and successful payments are weighted by ``max(n_reminders, 1)``
    over a distinct-booking denominator.  The weight is applied to one row per booking
    instead of materialising the repetition; bookings are aggregated per salon *before*
    meeting the salon table, so a salon with a third of all bookings costs one row per
    task, not one task.  ``corrected=True`` counts at booking grain.
    """
    appts = window_appointments(t, as_of, days).select("appointment_id", "salon_id", "status", "payment_status")
    counts = reminder_counts(t, corrected, days_before(as_of, days)) if counts is None else counts    # or kept elsewhere
    j = appts.join(counts, "appointment_id", "left")
    n_ev = F.coalesce(F.col("n_events"), F.lit(0))
    weight = F.lit(1) if corrected else F.greatest(n_ev, F.lit(1))
    per_salon = j.groupBy("salon_id").agg(
        F.count("appointment_id").alias("n_appts"),
        F.sum(F.when(F.col("status") == "no_show", weight).otherwise(0)).cast("bigint").alias("w_no_shows"),
        F.sum(n_ev).cast("bigint").alias("n_events"),
        F.sum(F.coalesce(F.col("n_engaged"), F.lit(0))).cast("bigint").alias("n_engaged"),
        F.sum(F.when(F.col("payment_status") == "successful", weight).otherwise(0)).cast("bigint").alias("w_paid"),
    )
    salons = t.salons.where(F.col("is_active")).select(*SALON_COLUMNS)
    s = salons.join(per_salon, "salon_id", "left")
    n_appts = F.coalesce(F.col("n_appts"), F.lit(0))
    prepay_den = F.when(F.col("prepay_enabled"), n_appts).otherwise(F.lit(0))
    return s.select(
        *SALON_COLUMNS,
        (F.col("reminder_30min").cast("int") + F.col("delay_tracker").cast("int")
         + F.col("prepay_enabled").cast("int")).alias("features_enabled_count"),
        n_appts.alias("total_appointments_30d"),
        F.coalesce(F.col("w_no_shows"), F.lit(0)).cast("bigint").alias("no_shows_30d"),
        pct(F.col("w_no_shows"), n_appts).alias("salon_noshow_rate_pct"),
        pct(F.col("n_engaged"), F.coalesce(F.col("n_events"), F.lit(0))).alias("reminder_engagement_pct"),
        pct(F.coalesce(F.col("w_paid"), F.lit(0)), prepay_den).alias("prepay_adoption_pct"),
    )
