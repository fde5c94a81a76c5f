"""The dashboard's dataset queries, one projection + ordering per view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators import (activity, adoption, cohort, delays, dropoff, funnel, kpi, merge,
                                reminders, weekly)
from slotwise.sources.tables import Tables


def kpi_cards(t: Tables, as_of: dt.date) -> DataFrame:
    return kpi.kpi_snapshot(t, as_of).select("*")


def noshow_trend(t: Tables, as_of: dt.date) -> DataFrame:
    return (weekly.weekly_noshow(t, as_of)
            .select("week_start", "no_show_rate_pct", "target_pct", "baseline_pct",
                    "total_appointments", "no_shows", "attended")
            .orderBy("week_start"))


def dau_trend(t: Tables, as_of: dt.date) -> DataFrame:
    return (activity.daily_active_users(t, as_of)
            .select("activity_date", "dau", "active_salons", "dau_7day_avg", "day_name", "week_number")
            .orderBy("activity_date"))


def funnel_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (funnel.conversion_funnel(t, as_of)
            .select("month_start", "month_name", "year", "step1_bookings", "step2_reminder_delivered",
                    "step3_reminder_engaged", "step4_attended_rescheduled", "step5_no_show",
                    "pct_delivered", "pct_engaged", "pct_attended", "pct_no_show")
            .orderBy("month_start"))


def retention_report(t: Tables, as_of: dt.date) -> DataFrame:
    # ordered by the label text, as the dataset query does (Apr sorts before Feb)
    return (cohort.cohort_retention(t, as_of)
            .select("cohort_label", "months_since_first", "retained_customers", "cohort_size",
                    "retention_rate_pct")
            .orderBy("cohort_label", "months_since_first"))


def dropoff_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (dropoff.dropoff_counts(t, as_of).select("drop_off_point", "occurrences")
            .orderBy(F.col("occurrences").desc()))


def reminder_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (reminders.reminder_by_type(t, as_of)
            .select("reminder_type", "sort_order", "total_sent", "delivery_failures", "failure_rate_pct",
                    "total_engaged", "engagement_rate_pct", "engagement_target_pct")
            .orderBy("sort_order"))


def delay_band_report(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    return (delays.delay_bands(t)
            .select("delay_band_label", "band_sort", "total_appointments", "reschedule_offered",
                    "rescheduled", "reschedule_take_rate_pct", "ultimately_attended",
                    "ultimately_no_show", "reschedule_target_pct")
            .orderBy("band_sort"))


def prepay_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (weekly.prepay_funnel(t, as_of)
            .select("week_start", "eligible_bookings", "chose_prepay", "paid_successfully",
                    "payment_failed", "slot_hold_expired", "adoption_rate_pct", "adoption_target_pct",
                    "avg_discount_pct", "prepay_revenue", "discount_value_given")
            .orderBy("week_start"))


def priority_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (weekly.priority_ontime(t, as_of)
            .select("week_start", "priority_appointments", "on_time_count", "late_count",
                    "on_time_rate_pct", "target_pct")
            .orderBy("week_start"))


def salon_adoption_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (adoption.feature_adoption(t, as_of)
            .select("salon_name", "city", "plan_tier", "onboarded_at", "reminder_30min", "delay_tracker",
                    "prepay_enabled", "features_enabled_count", "salon_noshow_rate_pct",
                    "reminder_engagement_pct", "prepay_adoption_pct")
            .orderBy(F.col("features_enabled_count").desc(), F.col("salon_noshow_rate_pct").asc()))


def merge_report(t: Tables, as_of: dt.date) -> DataFrame:
    return (merge.merge_compliance(t, as_of)
            .select("week_start", "total_overlaps", "correctly_merged", "violation_count", "compliance_pct")
            .orderBy("week_start"))


CONSUMERS = {
    "kpi_cards": (kpi_cards, "kpi_snapshot", "*", ""),
    "noshow_trend": (noshow_trend, "weekly_noshow",
                     "week_start, no_show_rate_pct, target_pct, baseline_pct, total_appointments, no_shows, attended",
                     "week_start"),
    "dau_trend": (dau_trend, "daily_active_users",
                  "activity_date, dau, active_salons, dau_7day_avg, day_name, week_number", "activity_date"),
    "funnel_report": (funnel_report, "conversion_funnel",
                      "month_start, month_name, \"year\", step1_bookings, step2_reminder_delivered, "
                      "step3_reminder_engaged, step4_attended_rescheduled, step5_no_show, pct_delivered, "
                      "pct_engaged, pct_attended, pct_no_show", "month_start"),
    "retention_report": (retention_report, "cohort_retention",
                         "cohort_label, months_since_first, retained_customers, cohort_size, retention_rate_pct",
                         "cohort_label, months_since_first"),
    "dropoff_occurrences": (dropoff_report, "dropoff_counts", "drop_off_point, occurrences", "occurrences DESC"),
    "reminder_report": (reminder_report, "reminder_by_type",
                        "reminder_type, sort_order, total_sent, delivery_failures, failure_rate_pct, "
                        "total_engaged, engagement_rate_pct, engagement_target_pct", "sort_order"),
    "delay_band_report": (delay_band_report, "delay_bands",
                          "delay_band_label, band_sort, total_appointments, reschedule_offered, rescheduled, "
                          "reschedule_take_rate_pct, ultimately_attended, ultimately_no_show, "
                          "reschedule_target_pct", "band_sort"),
    "prepay_report": (prepay_report, "prepay_funnel",
                      "week_start, eligible_bookings, chose_prepay, paid_successfully, payment_failed, "
                      "slot_hold_expired, adoption_rate_pct, adoption_target_pct, avg_discount_pct, "
                      "prepay_revenue, discount_value_given", "week_start"),
    "priority_report": (priority_report, "priority_ontime",
                        "week_start, priority_appointments, on_time_count, late_count, on_time_rate_pct, "
                        "target_pct", "week_start"),
    "salon_adoption_report": (salon_adoption_report, "feature_adoption",
                              "salon_name, city, plan_tier, onboarded_at, reminder_30min, delay_tracker, "
                              "prepay_enabled, features_enabled_count, salon_noshow_rate_pct, "
                              "reminder_engagement_pct, prepay_adoption_pct",
                              "features_enabled_count DESC, salon_noshow_rate_pct ASC"),
    "merge_report": (merge_report, "merge_compliance",
                     "week_start, total_overlaps, correctly_merged, violation_count, compliance_pct",
                     "week_start"),
}
