"""Registry entries for the dashboard (D*) and product-definition (M*) metrics."""

from __future__ import annotations

from slotwise.operators import dashboard as d
from slotwise.operators import product as m
from slotwise.operators import weekly
from slotwise.plans import oracle_extras as ox


def registry(as_of, cohort_as_of, q):
    return {
        # D1-D14
        "kpi_attainment": (q(d.kpi_attainment, as_of=as_of), ox.kpi_attainment),
        "kpi_target_status": (q(d.kpi_target_status, as_of=as_of), ox.kpi_target_status),
        "weekly_secondary_kpis": (q(d.weekly_secondary_kpis, as_of=as_of), ox.weekly_secondary_kpis),
        "recent_weeks_summary": (q(d.recent_weeks_summary, as_of=as_of), ox.recent_weeks_summary),
        "weekly_dau": (q(d.weekly_dau, as_of=as_of), ox.weekly_dau),
        "dau_trailing_rounded": (q(d.dau_trailing_rounded, as_of=as_of), ox.dau_trailing_rounded),
        "monthly_outcome_share": (q(d.monthly_outcome_share, as_of=as_of), ox.monthly_outcome_share),
        "retention_matrix": (q(d.retention_matrix, as_of=cohort_as_of), ox.retention_matrix),
        "retained_counts_matrix": (q(d.retained_counts_matrix, as_of=cohort_as_of), ox.retained_counts_matrix),
        "delay_band_outcomes": (q(d.delay_band_outcomes), ox.delay_band_outcomes),
        "feature_adoption_summary": (q(d.feature_adoption_summary), ox.feature_adoption_summary),
        "salon_feature_table": (q(d.salon_feature_table, as_of=as_of), ox.salon_feature_table),
        "reminder_performance": (q(d.reminder_performance, as_of=as_of), ox.reminder_performance),
        "funnel_step_loss": (q(d.funnel_step_loss, as_of=as_of), ox.funnel_step_loss),
        # M1-M16
        "noshow_rate_by_salon": (q(m.noshow_rate_by_salon, as_of=as_of), ox.noshow_rate_by_salon),
        "recovered_revenue": (q(m.recovered_revenue, as_of=as_of), ox.recovered_revenue),
        "attendance_rate_weekly": (q(m.attendance_rate_weekly, as_of=as_of), ox.attendance_rate_weekly),
        "attendance_after_reminder": (q(m.attendance_after_reminder, as_of=as_of), ox.attendance_after_reminder),
        "delivery_alerts": (q(m.delivery_alerts, as_of=as_of), ox.delivery_alerts),
        "prepay_conversion": (q(m.prepay_conversion, as_of=as_of), ox.prepay_conversion),
        "delay_estimate_accuracy": (q(m.delay_estimate_accuracy), ox.delay_estimate_accuracy),
        "reschedule_rate_by_prepay": (q(m.reschedule_rate_by_prepay, as_of=as_of), ox.reschedule_rate_by_prepay),
        "missed_reminders": (q(m.missed_reminders, as_of=as_of), ox.missed_reminders),
        "delay_check_coverage": (q(m.delay_check_coverage, as_of=as_of), ox.delay_check_coverage),
        "confirmation_sla": (q(m.confirmation_sla, as_of=as_of), ox.confirmation_sla),
        "reschedule_cta_rule_check": (q(m.reschedule_cta_rule_check), ox.reschedule_cta_rule_check),
        "retry_rule_check": (q(m.retry_rule_check), ox.retry_rule_check),
        "fiscal_outcomes": (q(weekly.fiscal_outcomes, as_of=as_of), ox.fiscal_outcomes),
        "funnel_vs_targets": (q(d.funnel_vs_targets, as_of=as_of), ox.funnel_vs_targets),
    }
