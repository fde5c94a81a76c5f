"""V6 drop-off catalogue, V6b live drop-off counts, V6+ the two combined."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.rates import count_when
from slotwise.operators.kpi import window_appointments
from slotwise.functions.dates import booked_since, days_before
from slotwise.sources.tables import Tables

# --- fixed values: drop-off catalogue (label, risk level, feature area, requirement) ------
CATALOG = [
    ("No action after reminder", "High", "Reminder System", "FR-1.9 / FR-1.10"),
    ("Reminder delivery failure", "High", "Reminder System", "FR-1.10"),
    ("No action at 60+ min delay", "High", "Live Delay Tracker", "FR-2.6 / FR-2.8"),
    ("Payment hold expired", "Medium", "Pre-Payment", "FR-3.8"),
    ("Payment failed (Razorpay)", "Medium", "Pre-Payment", "FR-3.5"),
    ("Late booking – reminders skipped", "Low", "Reminder System", "FR-1.6"),
]

CATALOG_SCHEMA = T.StructType([
    T.StructField("drop_off_point", T.StringType(), False),
    T.StructField("occurrences", T.LongType(), True),
    T.StructField("pct_of_step", T.DecimalType(5, 1), True),
    T.StructField("risk_level", T.StringType(), False),
    T.StructField("feature_area", T.StringType(), False),
    T.StructField("fr_reference", T.StringType(), False),
])


def dropoff_catalog(spark: SparkSession) -> DataFrame:
    """V6: the six catalogued drop-off points; occurrences and pct are NULL placeholders."""
    rows = [(label, None, None, risk, area, ref) for label, risk, area, ref in CATALOG]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def dropoff_counts(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Five labelled counts over the appointments scheduled in the last ``days`` days.

    Always five rows (zero allowed).  One pass per source with conditional counts instead
    of one scan per label.
    """
    win = window_appointments(t, as_of, days)
    ids = win.select("appointment_id")
    start = days_before(as_of, days)
    rem = booked_since(t.reminder_events, start).join(ids, "appointment_id", "left_semi").select(
        ((F.col("delivery_status") == "sent") & F.col("customer_action").isNull()).alias("r_no_action"),
        (F.col("delivery_status") == "failed").alias("r_failed"))
    dl = booked_since(t.delay_events, start).join(ids, "appointment_id", "left_semi").select(
        (F.col("reschedule_shown") & (F.col("customer_action").isNull() | (F.col("customer_action") == "none")))
        .alias("d_no_action"))
    ap = win.select((F.col("payment_status") == "expired").alias("a_expired"),
                    (F.col("payment_status") == "failed").alias("a_failed"))
    u = rem.unionByName(dl, allowMissingColumns=True).unionByName(ap, allowMissingColumns=True)
    agg = u.agg(*[count_when(F.col(c)).alias(c) for c in
                  ("r_no_action", "r_failed", "d_no_action", "a_expired", "a_failed")])
    labels = [CATALOG[0][0], CATALOG[1][0], CATALOG[2][0], CATALOG[3][0], CATALOG[4][0]]
    cols = ["r_no_action", "r_failed", "d_no_action", "a_expired", "a_failed"]
    args = [F.lit(5)]
    for label, c in zip(labels, cols):
        args += [F.lit(label), F.col(c)]
    return agg.select(F.stack(*args).alias("drop_off_point", "occurrences"))


def dropoff_report(t: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """V6+: the catalogue with live counts filled in by label (six rows; the late-booking
    point has no live count and stays NULL)."""
    cat = dropoff_catalog(t.spark)
    live = dropoff_counts(t, as_of, days).withColumnRenamed("occurrences", "live")
    # both sides are fixed-size (6 and 5 rows): broadcasting either is bounded
    return (cat.join(F.broadcast(live), "drop_off_point", "left")
            .select("drop_off_point",
                    F.coalesce(F.col("live"), F.col("occurrences")).alias("occurrences"),
                    "pct_of_step", "risk_level", "feature_area", "fr_reference"))
