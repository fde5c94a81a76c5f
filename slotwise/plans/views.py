"""Named views: every metric registered as a temporary view, queried with Spark SQL.

Dashboards read views, never raw tables; ``register_views`` gives the same surface on Spark
(``spark.sql("SELECT ... FROM vw_weekly_noshow")``), and ``CONSUMER_SQL`` holds the twelve
dataset queries as SQL text over those views.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from slotwise.operators import (activity, adoption, cohort, delays, dropoff, funnel, kpi, merge,
                                reminders, weekly)

VIEW_BUILDERS = {
    "vw_kpi_snapshot": lambda t, a: kpi.kpi_snapshot(t, a),
    "vw_weekly_noshow": lambda t, a: weekly.weekly_noshow(t, a),
    "vw_daily_active_users": lambda t, a: activity.daily_active_users(t, a),
    "vw_conversion_funnel": lambda t, a: funnel.conversion_funnel(t, a),
    "vw_cohort_retention": lambda t, a: cohort.cohort_retention(t, a),
    "vw_dropoff_signals": lambda t, a: dropoff.dropoff_catalog(t.spark),
    "vw_dropoff_counts": lambda t, a: dropoff.dropoff_counts(t, a),
    "vw_reminder_by_type": lambda t, a: reminders.reminder_by_type(t, a),
    "vw_delay_bands": lambda t, a: delays.delay_bands(t),
    "vw_prepay_funnel": lambda t, a: weekly.prepay_funnel(t, a),
    "vw_priority_ontime": lambda t, a: weekly.priority_ontime(t, a),
    "vw_feature_adoption": lambda t, a: adoption.feature_adoption(t, a),
    "vw_merge_compliance": lambda t, a: merge.merge_compliance(t, a),
}


def register_views(spark: SparkSession, t, as_of: dt.date, database: str | None = None,
                   cohort_as_of: dt.date | None = None) -> list[str]:
    """Register every view for ``as_of`` (lazy: nothing runs until a view is queried)."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    names = []
    for name, build in VIEW_BUILDERS.items():
        a = cohort_as_of if (name == "vw_cohort_retention" and cohort_as_of) else as_of
        build(t, a).createOrReplaceTempView(name)
        names.append(name)
    return names


# --- fixed values: the dashboard's dataset queries ------------------------------------------
CONSUMER_SQL = {
    "kpi_cards": "SELECT * FROM vw_kpi_snapshot",
    "noshow_trend": """SELECT week_start, no_show_rate_pct, target_pct, baseline_pct,
       total_appointments, no_shows, attended
FROM vw_weekly_noshow ORDER BY week_start""",
    "dau_trend": """SELECT activity_date, dau, active_salons, dau_7day_avg, day_name, week_number
FROM vw_daily_active_users ORDER BY activity_date""",
    "funnel_report": """SELECT month_start, month_name, year, step1_bookings, step2_reminder_delivered,
       step3_reminder_engaged, step4_attended_rescheduled, step5_no_show,
       pct_delivered, pct_engaged, pct_attended, pct_no_show
FROM vw_conversion_funnel ORDER BY month_start""",
    "retention_report": """SELECT cohort_label, months_since_first, retained_customers, cohort_size, retention_rate_pct
FROM vw_cohort_retention ORDER BY cohort_label, months_since_first""",
    "dropoff_occurrences": "SELECT drop_off_point, occurrences FROM vw_dropoff_counts ORDER BY occurrences DESC",
    "reminder_report": """SELECT reminder_type, sort_order, total_sent, delivery_failures, failure_rate_pct,
       total_engaged, engagement_rate_pct, engagement_target_pct
FROM vw_reminder_by_type ORDER BY sort_order""",
    "delay_band_report": """SELECT delay_band_label, band_sort, total_appointments, reschedule_offered, rescheduled,
       reschedule_take_rate_pct, ultimately_attended, ultimately_no_show, reschedule_target_pct
FROM vw_delay_bands ORDER BY band_sort""",
    "prepay_report": """SELECT week_start, eligible_bookings, chose_prepay, paid_successfully, payment_failed,
       slot_hold_expired, adoption_rate_pct, adoption_target_pct, avg_discount_pct, prepay_revenue,
       discount_value_given
FROM vw_prepay_funnel ORDER BY week_start""",
    "priority_report": """SELECT week_start, priority_appointments, on_time_count, late_count, on_time_rate_pct, target_pct
FROM vw_priority_ontime ORDER BY week_start""",
    "salon_adoption_report": """SELECT salon_name, city, plan_tier, onboarded_at, reminder_30min, delay_tracker,
       prepay_enabled, features_enabled_count, salon_noshow_rate_pct, reminder_engagement_pct,
       prepay_adoption_pct
FROM vw_feature_adoption ORDER BY features_enabled_count DESC, salon_noshow_rate_pct ASC""",
    "merge_report": """SELECT week_start, total_overlaps, correctly_merged, violation_count, compliance_pct
FROM vw_merge_compliance ORDER BY week_start""",
}


def consumer_sql(spark: SparkSession, name: str) -> DataFrame:
    """Run one dataset query against the registered views."""
    return spark.sql(CONSUMER_SQL[name])
