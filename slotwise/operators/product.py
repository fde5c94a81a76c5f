"""Metrics the product definition describes in prose, computed from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import booked_since, boundary_diff, days_before, met_by, since, weeks_before
from slotwise.functions.rates import count_if, dec, pct, round_ratio
from slotwise.operators import funnel, weekly
from slotwise.operators.kpi import window_appointments
from slotwise.sources.tables import Tables

# --- fixed values: product targets and rule parameters ------------------------------------
BASELINE_NOSHOW_PCT = 40          # recovery is measured against the 40 % baseline
WEEKS_PER_YEAR = 52
ATTENDANCE_BASELINE = "60.0"
ATTENDANCE_TARGET = "70.0"
FAILURE_ALERT_PCT = 5
DELIVERY_ALERT_PCT = 95
ESTIMATE_TOLERANCE_MIN = 5
CTA_DELAY_MIN = 60
MAX_RETRIES = 2
CONFIRMATION_SLA_SECONDS = 60
# planned reminders: (type, minutes before the appointment; None = at booking time)
REMINDER_PLAN = [("confirmation", None), ("24h", 1440), ("2h", 120), ("1h", 60), ("30min", 30)]
OPT_IN_TYPES = {"30min"}
# delay checks: every 30 min from T-2h to T-1h, every 15 min from T-1h to T
DELAY_CHECK_RANGES = [(-120, -60, 30), (-60, 0, 15)]


def noshow_rate_by_salon(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """M1: missed / total x 100 per salon over the last ``days`` days."""
    a = window_appointments(t, as_of, days)
    return a.groupBy("salon_id").agg(F.count(F.lit(1)).alias("total_appointments"),
                                     count_if(F.col("status") == "no_show").alias("no_shows")) \
            .withColumn("no_show_rate_pct", pct("no_shows", "total_appointments"))


def recovered_revenue(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """M2: weekly revenue recovered per salon versus the 40 % baseline:
    bookings/week x (baseline - no-show rate) x mean price, and x52 per year.

    With n bookings, s no-shows and price sum P over c priced bookings in ``weeks`` weeks
    this is (0.4 n - s) x P / (weeks x c), rounded half away from zero to cents (negative
    when the salon is above the baseline).
    """
    a = since(t.appointments, "scheduled_at", weeks_before(as_of, weeks))
    g = a.groupBy("salon_id").agg(
        F.count(F.lit(1)).alias("bookings"),
        count_if(F.col("status") == "no_show").alias("no_shows"),
        F.sum("original_price").alias("price_sum"),
        F.count("original_price").alias("priced"))
    cents = (F.col("price_sum") * 100).cast("decimal(38,0)")
    num = (F.col("bookings") * BASELINE_NOSHOW_PCT - F.col("no_shows") * 100).cast("decimal(38,0)") * cents
    den = F.lit(100 * weeks * 100) * F.col("priced")
    return g.select(
        "salon_id", "bookings", "no_shows",
        round_ratio(F.col("bookings"), F.lit(weeks), 2, 18).alias("bookings_per_week"),
        pct("no_shows", "bookings").alias("no_show_rate_pct"),
        round_ratio(cents, F.col("priced") * 100, 2, 18).alias("avg_price"),
        round_ratio(num, den, 2, 18).alias("recovered_per_week"),
        round_ratio(num * WEEKS_PER_YEAR, den, 2, 18).alias("recovered_per_year"))


def attendance_rate_weekly(t: Tables, as_of: dt.date, weeks: int = 26) -> DataFrame:
    """M3: attended / bookings per week with the 60 % baseline and 70 % target."""
    return weekly.weekly_noshow(t, as_of, weeks).select(
        "year", "iso_week", "week_start", "total_appointments", "attended",
        pct("attended", "total_appointments").alias("attendance_rate_pct"),
        dec(ATTENDANCE_BASELINE).alias("baseline_pct"), dec(ATTENDANCE_TARGET).alias("target_pct"))


def attendance_after_reminder(t: Tables, as_of: dt.date, days: int = 30, flags: DataFrame | None = None) -> DataFrame:
    """M4: attendance of bookings with and without a delivered reminder, and the uplift of
    each group over the 60 % baseline."""
    a = window_appointments(t, as_of, days).select("appointment_id", "status")
    flags = funnel.reminder_flags(t, start=days_before(as_of, days)) if flags is None else flags      # or kept elsewhere
    j = a.join(flags.select("appointment_id", "was_delivered"), "appointment_id", "left")
    g = j.groupBy((F.coalesce(F.col("was_delivered"), F.lit(0)) == 1).alias("reminder_delivered")).agg(
        F.count(F.lit(1)).alias("appointments"), count_if(F.col("status") == "attended").alias("attended"))
    rate = pct("attended", "appointments")
    return g.select("reminder_delivered", "appointments", "attended", rate.alias("attendance_rate_pct"),
                    (rate - dec(ATTENDANCE_BASELINE)).cast("decimal(5,1)").alias("uplift_vs_baseline_pct"))


def delivery_alerts(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """M5: weekly reminder delivery with the two alert rules (failure > 5 %, delivery < 95 %),
    tested on the counts, not on the rounded rates."""
    r = since(t.reminder_events, "sent_at", weeks_before(as_of, weeks))
    wk = weekly.with_week(r, F.col("sent_at").cast("date"), t).groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"), F.count(F.lit(1)).alias("n"),
        count_if(F.col("delivery_status") == "failed").alias("failed"),
        count_if(F.col("delivery_status") == "sent").alias("delivered"))
    fail, deliv = pct("failed", "n"), pct("delivered", "n")
    return wk.select("year", "week_number", "week_start", F.col("n").alias("reminders"), "failed", "delivered",
                     fail.alias("failure_rate_pct"), deliv.alias("delivery_rate_pct"),
                     (F.col("failed") * 100 > F.col("n") * FAILURE_ALERT_PCT).alias("failure_alert"),
                     (F.col("delivered") * 100 < F.col("n") * DELIVERY_ALERT_PCT).alias("delivery_alert"))


def prepay_conversion(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """M6 / M7: slot-hold expiry (expired / chose), checkout paid (paid / chose), and the
    click-through proxy chose / eligible (no column records that the offer was seen)."""
    return weekly.prepay_funnel(t, as_of, weeks).select(
        "year", "week_number", "week_start", "eligible_bookings", "chose_prepay", "paid_successfully",
        "slot_hold_expired",
        pct("slot_hold_expired", "chose_prepay").alias("slot_hold_expiry_rate_pct"),
        pct("paid_successfully", "chose_prepay").alias("checkout_paid_rate_pct"),
        pct("chose_prepay", "eligible_bookings").alias("click_through_proxy_pct"))


def delay_estimate_accuracy(t: Tables, as_of: dt.date | None = None, last: DataFrame | None = None) -> DataFrame:
    """M8: share of attended appointments whose last delay estimate is within 5 minutes of
    the delay observed at marking (marked_at is when the visit was recorded, a proxy for
    service start).  Last = latest triggered_at, ties broken by event id."""
    if last is None:                                                                                # or kept elsewhere
        last = t.delay_events.groupBy("appointment_id").agg(
            F.max_by("delay_minutes", F.struct("triggered_at", "event_id")).alias("estimate"))
    a = t.appointments.where((F.col("status") == "attended") & F.col("marked_at").isNotNull()) \
         .select("appointment_id", boundary_diff("minute", "scheduled_at", "marked_at").alias("actual"))
    j = last.join(a, "appointment_id")
    ok = F.abs(F.col("estimate") - F.col("actual")) <= ESTIMATE_TOLERANCE_MIN
    return j.agg(F.count(F.lit(1)).alias("appointments"), count_if(ok).alias("within_tolerance")) \
            .withColumn("accuracy_pct", pct("within_tolerance", "appointments"))


def reschedule_rate_by_prepay(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Reschedule rate of the prepaid cohort against standard bookings."""
    a = window_appointments(t, as_of, days)
    return a.groupBy((F.col("payment_status") == "successful").alias("prepaid")).agg(
        F.count(F.lit(1)).alias("appointments"), count_if(F.col("status") == "rescheduled").alias("rescheduled")) \
        .withColumn("reschedule_rate_pct", pct("rescheduled", "appointments"))


def expected_reminders(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """The reminder plan of every booking in the window (confirmation at booking, then
    T-24h, T-2h, T-1h and T-30m, the last only where the salon opted in)."""
    a = window_appointments(t, as_of, days).join(
        t.salons.select("salon_id", "reminder_30min"), "salon_id")
    plan = F.array(*[F.struct(F.lit(rt).alias("reminder_type"),
                              (F.col("created_at") if m is None else
                               F.col("scheduled_at") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m)))
                              .alias("due_at"),
                              (F.col("reminder_30min") if rt in OPT_IN_TYPES else F.lit(True)).alias("planned"))
                     for rt, m in REMINDER_PLAN])
    return (a.select("appointment_id", F.explode(plan).alias("p"))
            .where(F.col("p.planned")).select("appointment_id", "p.reminder_type", "p.due_at"))


def missed_reminders(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Planned reminders per type and how many were never sent.

    One row per booking: a flag per type says whether one was sent, so a booking with a huge share of
    events costs one row per task, and one global aggregate counts all types at once.
    """
    types = [rt for rt, _ in REMINDER_PLAN]
    sent = booked_since(t.reminder_events, days_before(as_of, days)).where(F.col("sent_at").isNotNull()).groupBy("appointment_id").agg(
        *[F.max(F.col("reminder_type") == rt).alias(f"sent{i}") for i, rt in enumerate(types)])
    a = window_appointments(t, as_of, days).select("appointment_id", "salon_id").join(t.salons.select("salon_id", "reminder_30min"), "salon_id")
    planned = [F.col("reminder_30min") if rt in OPT_IN_TYPES else F.lit(True) for rt in types]
    total = a.join(sent, "appointment_id", "left").agg(
        *[count_if(p).alias(f"expected{i}") for i, p in enumerate(planned)],
        *[count_if(p & ~F.coalesce(F.col(f"sent{i}"), F.lit(False))).alias(f"missing{i}") for i, p in enumerate(planned)])
    cells = [c for i, rt in enumerate(types) for c in (F.lit(rt), F.col(f"expected{i}"), F.col(f"missing{i}"))]
    rows = total.select(F.stack(F.lit(len(types)), *cells).alias("reminder_type", "expected", "missing")).where(F.col("expected") > 0)
    return rows.withColumn("missing_pct", pct("missing", "expected"))


def delay_check_schedule(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Planned delay checks per booking at delay-tracker salons (offsets in minutes)."""
    a = window_appointments(t, as_of, days).join(
        t.salons.where(F.col("delay_tracker")).select("salon_id"), "salon_id", "left_semi")
    return a.select("appointment_id", "scheduled_at", F.explode(_check_offsets()).alias("offset_minutes"))


def _check_offsets():
    return F.array_distinct(F.concat(*[F.sequence(F.lit(lo), F.lit(hi), F.lit(step)) for lo, hi, step in DELAY_CHECK_RANGES]))


def delay_check_coverage(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Planned checks against recorded delay events for the same bookings."""
    tracked = window_appointments(t, as_of, days).join(
        t.salons.where(F.col("delay_tracker")).select("salon_id"), "salon_id", "left_semi")
    per_appt = tracked.select("appointment_id", F.size(_check_offsets()).alias("planned"))
    rec = booked_since(t.delay_events, days_before(as_of, days)).groupBy("appointment_id").agg(F.count(F.lit(1)).alias("recorded"))
    j = per_appt.join(rec, "appointment_id", "left")
    return j.agg(F.count(F.lit(1)).alias("appointments"),
                 F.sum("planned").cast("bigint").alias("planned_checks"),
                 F.coalesce(F.sum("recorded"), F.lit(0)).cast("bigint").alias("recorded_checks")) \
            .withColumn("coverage_pct", pct("recorded_checks", "planned_checks"))


def confirmation_sla(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """Confirmations sent less than 60 s after the booking was created, per send week."""
    c = (since(t.reminder_events, "sent_at", weeks_before(as_of, weeks))
         .where(F.col("reminder_type") == "confirmation"))
    booked = met_by(t.appointments, c).select("appointment_id", "created_at")
    j = c.select("appointment_id", "sent_at").join(booked, "appointment_id")
    secs = boundary_diff("second", "created_at", "sent_at")
    wk = weekly.with_week(j, F.col("sent_at").cast("date"), t).groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"),
        F.count(F.lit(1)).alias("confirmations"),
        count_if(secs < CONFIRMATION_SLA_SECONDS).alias("within_sla"))
    return wk.withColumn("sla_pct", pct("within_sla", "confirmations"))


def reschedule_cta_rule_check(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """The reschedule call-to-action must be shown exactly when the delay is >= 60 min."""
    return t.delay_events.groupBy(
        (F.col("delay_minutes") >= CTA_DELAY_MIN).alias("delay_60_plus"),
        F.col("reschedule_shown")).agg(F.count(F.lit(1)).alias("events")) \
        .withColumn("rule_ok", F.col("delay_60_plus") == F.col("reschedule_shown"))


def retry_rule_check(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Reminders retried more than twice, per type (the retry times are not stored,
    so only the count part of the rule can be checked)."""
    return t.reminder_events.groupBy("reminder_type").agg(
        F.count(F.lit(1)).alias("reminders"),
        count_if(F.col("retry_count") > MAX_RETRIES).alias("over_retry_limit"),
        F.max("retry_count").cast("int").alias("max_retry_count"))
