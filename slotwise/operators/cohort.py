"""V5 cohort retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.dates import month_diff, months_before
from slotwise.functions.rates import pct
from slotwise.sources.tables import Tables

# --- fixed values: statuses that count as a retained visit ---------------------------------
RETAINED_STATUSES = ["attended", "rescheduled"]


def customer_months(t: Tables) -> DataFrame:
    """One row per (customer, month of created_at): active flag and the customer's cohort.

    The first aggregation is partial per task, so a customer holding a large share of all
    bookings still shrinks to one row per month before the shuffle; the window then sees
    at most one row per month of history per customer.
    """
    cm = (t.appointments
          .groupBy("customer_id", F.trunc(F.col("created_at").cast("date"), "month").alias("month"))
          .agg(F.max(F.col("status").isin(RETAINED_STATUSES)).alias("active")))
    w = Window.partitionBy("customer_id")
    return (cm.withColumn("cohort_month", F.min("month").over(w))
              .withColumn("ever_active", F.max("active").over(w)))


def cohort_retention(t: Tables, as_of: dt.date, months: int = 12, corrected: bool = False) -> DataFrame:
    """V5: customers grouped by the month of their first booking (cohort) and the months
    with attended/rescheduled bookings (both by created_at).

    As written the cohort size is counted inside each (cohort, activity month) group, so it
    equals the retained count (rate 100.0) and never-active customers form one row per
    cohort with a NULL month (rate 0.0).  ``corrected=True`` counts the cohort once,
    divides by it and drops the NULL-month rows.
    """
    cm = customer_months(t).where(F.col("cohort_month") >= F.lit(months_before(as_of, months)))
    if corrected:
        # one aggregation gives both counts: customers active in each (cohort, month), and the
        # customers whose first month is that month; a window over the (small) aggregated rows
        # of a cohort sums the latter into the cohort size
        g = (cm.groupBy("cohort_month", F.col("month").alias("activity_month"))
             .agg(F.count(F.when(F.col("active"), 1)).alias("retained_customers"),
                  F.count(F.when(F.col("month") == F.col("cohort_month"), 1)).alias("starters"))
             .withColumn("cohort_size", F.sum("starters").over(Window.partitionBy("cohort_month")))
             .where(F.col("retained_customers") > 0))
    else:
        # one pass: active months keep their month, a never-active customer contributes its
        # single cohort-month row with a NULL month (the unmatched side of the definition)
        rows = cm.where(F.col("active") | (~F.col("ever_active") & (F.col("month") == F.col("cohort_month"))))
        g = (rows.select("cohort_month", F.when(F.col("active"), F.col("month")).alias("activity_month"))
             .groupBy("cohort_month", "activity_month")
             .agg(F.count(F.col("activity_month")).alias("retained_customers"),
                  F.count(F.lit(1)).alias("cohort_size")))
    return g.select(
        "cohort_month",
        F.date_format("cohort_month", "MMM yyyy").alias("cohort_label"),
        month_diff("cohort_month", "activity_month").alias("months_since_first"),
        "retained_customers", "cohort_size",
        pct("retained_customers", "cohort_size").alias("retention_rate_pct"),
    )
