"""V1 executive KPI snapshot (one row) and SP2 dashboard parameters.

The source defines V1 as three independent aggregates (bookings, reminders, delays of
the last 30 days) combined side by side.  Here the three inputs are reduced to per-row
indicator columns, unioned by name, and folded by one global aggregate: one job, partial
aggregation in every task, one tiny final merge, and no join between the aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import booked_since, boundary_diff, days_before, since, weeks_before
from slotwise.functions.rates import dec, flag, pct
from slotwise.sources.tables import Tables

# --- fixed values: KPI targets ------------------------------------------------------------
TARGETS = {
    "baseline_noshow_pct": "40.0",
    "target_noshow_pct": "30.0",
    "reminder_engagement_target": "60.0",
    "delay_delivery_target": "95.0",
    "reschedule_via_delay_target": "70.0",
    "prepay_adoption_target": "55.0",
    "priority_ontime_target": "90.0",
}
ON_TIME_MINUTES = 5


def window_appointments(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Appointments scheduled on or after ``as_of - days`` (no upper bound)."""
    return since(t.appointments, "scheduled_at", days_before(as_of, days))


def _indicator_rows(t: Tables, as_of: dt.date, days: int, corrected: bool) -> DataFrame:
    win = window_appointments(t, as_of, days)
    base = win.join(t.salons.select("salon_id", "prepay_enabled"), "salon_id")
    status, pay = F.col("status"), F.col("payment_status")
    prio = F.col("is_priority")
    on_time = prio & (status == "attended") & (boundary_diff("minute", "scheduled_at", "marked_at") <= ON_TIME_MINUTES)
    paid = pay == "successful"
    if corrected:
        paid = paid & F.col("prepay_enabled")
    b = base.select(
        F.lit(1).alias("a_n"),
        flag(status == "no_show").alias("a_no_show"),
        flag(status == "attended").alias("a_attended"),
        flag(status == "rescheduled").alias("a_rescheduled"),
        flag(paid).alias("a_paid"),
        flag(F.col("prepay_enabled")).alias("a_prepay_salon"),
        flag(on_time).alias("a_on_time"),
        flag(prio).alias("a_priority"),
        F.when(pay == "successful", F.col("amount_paid")).otherwise(F.lit(0)).alias("a_revenue"),
    )
    ids = win.select("appointment_id")
    start = days_before(as_of, days)
    engaged = F.col("customer_action").isNotNull()
    if corrected:
        engaged = F.col("customer_action").isin("reschedule", "cancel")
    r = (booked_since(t.reminder_events, start).join(ids, "appointment_id", "left_semi")
         .select(F.lit(1).alias("r_n"),
                 flag(F.col("delivery_status") == "sent").alias("r_delivered"),
                 flag(engaged).alias("r_engaged")))
    d = (booked_since(t.delay_events, start).join(ids, "appointment_id", "left_semi")
         .select(F.lit(1).alias("d_n"),
                 flag(F.col("message_sent")).alias("d_sent"),
                 flag(F.col("reschedule_shown")).alias("d_offered"),
                 flag(F.col("reschedule_shown") & (F.col("customer_action") == "reschedule")).alias("d_rescheduled")))
    return b.unionByName(r, allowMissingColumns=True).unionByName(d, allowMissingColumns=True)


def kpi_snapshot(t: Tables, as_of: dt.date, days: int = 30, corrected: bool = False) -> DataFrame:
    """V1: one row of 30-day KPIs.

    Empty window: counts 0, sums NULL, rates NULL, revenue 0.  As written, prepay adoption
    divides successful payments at *any* salon by bookings at prepay-enabled salons and
    engagement counts the action value 'none'; ``corrected=True`` restricts both.
    """
    u = _indicator_rows(t, as_of, days, corrected)
    s = lambda c: F.sum(c).cast("bigint")
    agg = u.agg(
        F.count("a_n").alias("n"), s("a_no_show").alias("no_show"), s("a_attended").alias("attended"),
        s("a_rescheduled").alias("rescheduled"), s("a_paid").alias("paid"),
        s("a_prepay_salon").alias("prepay_salon"), s("a_on_time").alias("on_time"),
        s("a_priority").alias("priority"), F.sum("a_revenue").alias("revenue"),
        F.count("r_n").alias("r_n"), s("r_delivered").alias("r_delivered"), s("r_engaged").alias("r_engaged"),
        F.count("d_n").alias("d_n"), s("d_sent").alias("d_sent"), s("d_offered").alias("d_offered"),
        s("d_rescheduled").alias("d_rescheduled"),
    )
    return agg.select(
        pct("no_show", "n").alias("no_show_rate_pct"),
        dec(TARGETS["baseline_noshow_pct"]).alias("baseline_pct"),
        dec(TARGETS["target_noshow_pct"]).alias("target_pct"),
        F.col("n").alias("total_appointments"),
        F.col("no_show").alias("total_no_shows"),
        F.col("attended").alias("total_attended"),
        F.col("rescheduled").alias("total_rescheduled"),
        F.col("r_n").alias("reminders_sent"),
        pct("r_delivered", "r_n").alias("delivery_rate_pct"),
        pct("r_engaged", "r_n").alias("engagement_rate_pct"),
        pct("d_sent", "d_n").alias("delay_delivery_pct"),
        pct("d_rescheduled", "d_offered").alias("reschedule_via_delay_pct"),
        pct("paid", "prepay_salon").alias("prepay_adoption_pct"),
        pct("on_time", "priority").alias("priority_ontime_pct"),
        F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(38,2)").alias("prepay_revenue_30d"),
        F.lit(as_of).alias("snapshot_date"),
    )


def dashboard_params(spark, as_of: dt.date) -> DataFrame:
    """SP2: one row with the default date-range starts and the seven KPI targets."""
    return spark.range(1).select(
        F.lit(as_of).alias("today"),
        F.lit(weeks_before(as_of, 26)).alias("default_start_26w"),
        F.lit(weeks_before(as_of, 12)).alias("default_start_12w"),
        F.lit(days_before(as_of, 30)).alias("default_start_30d"),
        *[dec(v).alias(k) for k, v in TARGETS.items()],
    )
