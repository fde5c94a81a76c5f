"""V8 delay bands and outcomes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import days_before, since
from slotwise.functions.rates import count_if, dec, pct
from slotwise.sources.tables import Tables

# --- fixed values: band ranks and labels, reschedule target ---------------------------------
BAND_RANK = {"major": 4, "moderate": 3, "minor": 2}
OTHER_BAND_RANK = 1
BAND_LABEL = {4: "Major (60+ min)", 3: "Moderate (30-59 min)", 2: "Minor (1-29 min)"}
OTHER_BAND_LABEL = "On schedule"
RESCHEDULE_TARGET = "70.0"


def band_rank(c) -> F.Column:
    e = F.when(c == "major", BAND_RANK["major"]).when(c == "moderate", BAND_RANK["moderate"]) \
         .when(c == "minor", BAND_RANK["minor"])
    return e.otherwise(OTHER_BAND_RANK)


def band_label(rank) -> F.Column:
    return F.when(rank == 4, BAND_LABEL[4]).when(rank == 3, BAND_LABEL[3]) \
            .when(rank == 2, BAND_LABEL[2]).otherwise(OTHER_BAND_LABEL)


def delay_per_appointment(t: Tables) -> DataFrame:
    """One row per appointment with delay events: worst band, event count and sums.

    Carrying the counts lets the band rollup reproduce the per-event weighting of the
    definition without joining the events back (no fan-out, one shuffle on the key).
    """
    return t.delay_events.groupBy("appointment_id").agg(
        F.max("delay_minutes").alias("max_delay_minutes"),
        F.max(band_rank(F.col("delay_band"))).alias("worst_band_rank"),
        F.count(F.lit(1)).alias("n_events"),
        count_if(F.col("reschedule_shown")).alias("n_offered"),
        count_if(F.col("customer_action") == "reschedule").alias("n_rescheduled"),
    )


def delay_bands(t: Tables, as_of: dt.date | None = None, days: int | None = None,
                corrected: bool = False) -> DataFrame:
    """V8: appointments by worst delay band with reschedule offers, take-up and outcomes.

    As written (all time) offers, reschedules and the attended / no-show outcomes are
    counted once per *delay event* of the appointment.  ``corrected=True`` counts
    appointments and, with ``days``, keeps appointments scheduled in the last ``days`` days.
    """
    return bands_from_per_appointment(t, delay_per_appointment(t), as_of, days, corrected)


def bands_from_per_appointment(t: Tables, per_appt: DataFrame, as_of: dt.date | None = None,
                               days: int | None = None, corrected: bool = False) -> DataFrame:
    """Band rollup of per-appointment delay aggregates (appointment_id, worst_band_rank,
    n_events, n_offered, n_rescheduled), from the batch aggregate or the streamed state."""
    appts = t.appointments
    if corrected and days is not None and as_of is not None:
        appts = since(appts, "scheduled_at", days_before(as_of, days))
    appts = appts.select("appointment_id", "status")
    j = per_appt.join(appts, "appointment_id")
    label = band_label(F.col("worst_band_rank"))
    att, ns = F.col("status") == "attended", F.col("status") == "no_show"
    if corrected:
        aggs = [count_if(F.col("n_offered") > 0).alias("reschedule_offered"),
                count_if(F.col("n_rescheduled") > 0).alias("rescheduled"),
                count_if(att).alias("ultimately_attended"),
                count_if(ns).alias("ultimately_no_show")]
    else:
        w = F.col("n_events")
        aggs = [F.sum("n_offered").cast("bigint").alias("reschedule_offered"),
                F.sum("n_rescheduled").cast("bigint").alias("rescheduled"),
                F.sum(F.when(att, w).otherwise(0)).cast("bigint").alias("ultimately_attended"),
                F.sum(F.when(ns, w).otherwise(0)).cast("bigint").alias("ultimately_no_show")]
    g = j.groupBy(label.alias("delay_band_label"), F.col("worst_band_rank").alias("band_sort")).agg(
        F.count(F.lit(1)).alias("total_appointments"), *aggs)
    return g.select(
        "delay_band_label", "band_sort", "total_appointments", "reschedule_offered", "rescheduled",
        "ultimately_attended", "ultimately_no_show",
        pct("rescheduled", "reschedule_offered").alias("reschedule_take_rate_pct"),
        dec(RESCHEDULE_TARGET).alias("reschedule_target_pct"),
    )
