"""V7 reminder engagement by type."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.dates import days_before, met_by, since
from slotwise.functions.rates import count_if, dec, pct
from slotwise.sources.tables import Tables

# --- fixed values: reminder type order and engagement target -----------------------------
TYPE_ORDER = {"confirmation": 1, "24h": 2, "2h": 3, "1h": 4, "30min": 5}
OTHER_TYPE_ORDER = 9
ENGAGEMENT_TARGET = "60.0"


def type_sort_order(c) -> F.Column:
    expr = None
    for name, rank in TYPE_ORDER.items():
        expr = (F.when(c == name, F.lit(rank)) if expr is None else expr.when(c == name, F.lit(rank)))
    return expr.otherwise(F.lit(OTHER_TYPE_ORDER))


def reminder_by_type(t: Tables, as_of: dt.date, days: int = 30, corrected: bool = False) -> DataFrame:
    """V7: reminders *sent* in the last ``days`` days per type.

    Only reminders of an existing appointment count (semi join: no appointment column is
    read, so the join is an existence check and cannot fan out).  Engagement as written
    counts any non-NULL action, including 'none'.
    """
    rem = since(t.reminder_events, "sent_at", days_before(as_of, days))
    rem = rem.join(met_by(t.appointments, rem).select("appointment_id"), "appointment_id", "left_semi")
    action = F.col("customer_action")
    engaged = action.isin("reschedule", "cancel") if corrected else action.isNotNull()
    g = rem.groupBy("reminder_type").agg(
        F.count(F.lit(1)).alias("total_sent"),
        count_if(F.col("delivery_status") == "failed").alias("delivery_failures"),
        count_if(F.col("delivery_status") == "merged").alias("merged_messages"),
        count_if(action == "reschedule").alias("action_reschedule"),
        count_if(action == "cancel").alias("action_cancel"),
        count_if(engaged).alias("total_engaged"),
    )
    return g.select(
        "reminder_type", type_sort_order(F.col("reminder_type")).alias("sort_order"),
        "total_sent", "delivery_failures", "merged_messages", "action_reschedule", "action_cancel",
        "total_engaged",
        pct("delivery_failures", "total_sent").alias("failure_rate_pct"),
        pct("total_engaged", "total_sent").alias("engagement_rate_pct"),
        dec(ENGAGEMENT_TARGET).alias("engagement_target_pct"),
    )
