"""V12 message merge compliance: reminders sent within 120 s of a delay update."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import epoch_seconds, since, weeks_before
from slotwise.functions.rates import pct
from slotwise.sources.tables import Tables

# --- fixed values: rule parameters -----------------------------------------------------------
MERGE_WINDOW_SECONDS = 120
MERGE_REMINDER_TYPES = ["2h", "1h"]


def overlap_pairs(t: Tables, as_of: dt.date, weeks: int = 4, window: int = MERGE_WINDOW_SECONDS) -> DataFrame:
    """For 2h/1h reminders sent since ``as_of - weeks``: the delay events on the same
    appointment whose second boundary is less than ``window`` seconds away, as rows
    (reminder, delay second, number of delay events at that second).

    Interval join without candidate blow-up: delay events are first counted per
    (appointment, second), so however many events one appointment has, a reminder probes at
    most ``3*window`` candidate rows (its own and both neighbouring ``window``-second buckets
    of the equi key (appointment, bucket)), of which at most ``2*window - 1`` match; skew on
    one appointment spreads over buckets and AQE can split what remains.
    """
    start = weeks_before(as_of, weeks)
    rem = (since(t.reminder_events, "sent_at", start)
           .where(F.col("reminder_type").isin(MERGE_REMINDER_TYPES))
           .select("event_id", "appointment_id", "delivery_status",
                   F.col("sent_at").cast("date").alias("sent_date"),
                   epoch_seconds("sent_at").alias("rs")))
    lo = dt.datetime(start.year, start.month, start.day) - dt.timedelta(seconds=window)
    dl = delay_seconds(since(t.delay_events, "triggered_at", lo))
    return meeting(rem, dl, window).select("event_id", "delivery_status", "sent_date", F.col("n").alias("n_pairs"))


def delay_seconds(delays: DataFrame) -> DataFrame:
    """(appointment_id, ds, n): delay events counted per appointment and second."""
    return (delays.select("appointment_id", epoch_seconds("triggered_at").alias("ds"))
            .groupBy("appointment_id", "ds").agg(F.count(F.lit(1)).alias("n")))


def meeting(rem: DataFrame, seconds: DataFrame, window: int = MERGE_WINDOW_SECONDS) -> DataFrame:
    """Reminders (.., appointment_id, rs) with each second (appointment_id, ds, n) of delay events less than
    ``window`` seconds away: one row per (reminder, second)."""
    dl = seconds.withColumn("bucket", F.floor(F.col("ds") / window))
    probes = rem.withColumn("bucket", F.explode(F.array(
        *[F.floor(F.col("rs") / window) + k for k in (-1, 0, 1)])))
    return probes.join(dl, ["appointment_id", "bucket"]).where(F.abs(F.col("ds") - F.col("rs")) < window)


def merge_compliance(t: Tables, as_of: dt.date, weeks: int = 4, corrected: bool = False) -> DataFrame:
    """Per (year, US week) of the reminder's send date, overlapping (reminder, delay)
    pairs, merged ones, violations and the compliance rate.

    As written the week rows are joined to the calendar a second time on (year, week), so
    every count is multiplied by the number of calendar days of that week (up to 7, fewer
    at year ends) and week_start is the week's first calendar day; the rate is unaffected.
    ``corrected=True`` reports plain pair counts plus the number of distinct reminders.
    """
    return weekly_compliance(t, overlap_pairs(t, as_of, weeks), corrected)


def weekly_compliance(t: Tables, per_reminder: DataFrame, corrected: bool = False) -> DataFrame:
    """Week rollup of pair counts: rows (event_id, delivery_status, sent_date, n_pairs), one
    or more per reminder."""
    p = per_reminder
    merged = F.col("delivery_status") == "merged"
    aggs = [F.sum("n_pairs").alias("pairs"),
            F.sum(F.when(merged, F.col("n_pairs")).otherwise(0)).alias("merged"),
            F.sum(F.when(F.col("delivery_status") != "merged", F.col("n_pairs")).otherwise(0)).alias("violations")]
    # the distinct-reminder count is only reported by the corrected form
    if corrected:
        aggs.append(F.count_distinct("event_id").alias("reminders"))
    cal = t.cal()
    week_days = cal.groupBy("year", "week_number").agg(
        F.min("full_date").alias("week_start"), F.count(F.lit(1)).alias("days_in_week"))
    wk = (p.join(cal.select("full_date", "year", "week_number"), p.sent_date == cal.full_date)
          .groupBy("year", "week_number").agg(*aggs)
          .join(F.broadcast(week_days), ["year", "week_number"]))   # <= calendar weeks: bounded
    k = F.lit(1) if corrected else F.col("days_in_week")
    out = [
        "year", "week_number", "week_start",
        (F.col("pairs") * k).cast("bigint").alias("total_overlaps"),
        (F.col("merged") * k).cast("bigint").alias("correctly_merged"),
        (F.col("violations") * k).cast("bigint").alias("violation_count"),
        pct(F.col("merged") * k, F.col("pairs") * k).alias("compliance_pct"),
    ]
    if corrected:
        out.append(F.col("reminders").alias("reminders_with_overlap"))
    return wk.select(*out)
