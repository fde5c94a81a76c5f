"""Named queries over the driver test data, and their oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the *whole* input
tables; ``as_of`` is fixed to the last order date of the test data so the rolling windows
hold data (the cohort view uses the start of the data, where its 12-month cohort range
still holds customers).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotwise.operators import (activity, adoption, cohort, delays, dropoff, funnel, kpi, merge,
                                quality, refresh, reminders, weekly)
from slotwise.plans import consumer, oracle, oracle_extras
from slotwise.streaming import deltas, incremental
from slotwise.sources import load, schemas
from slotwise.sources.tables import Tables

AS_OF = dt.date(2001, 8, 1)
COHORT_AS_OF = dt.date(1996, 1, 1)
FIRST_NIGHT = dt.date(1998, 7, 1)

QueryFn = Callable[[SparkSession, str], DataFrame]


_TABLES: dict[str, tuple[SparkSession, Tables]] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The fixture tables of ``sf_dir``, built once per session (lazy DataFrames over the
    materialised domain parquet; every query still executes against the whole tables)."""
    hit = _TABLES.get(sf_dir)
    if hit is not None and hit[0] is spark and not spark.sparkContext._jsc.sc().isStopped():
        return hit[1]
    t = Tables.from_fixture(spark, sf_dir)
    _TABLES[sf_dir] = (spark, t)
    return t


def _q(fn, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir), **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


# name -> (spark callable, oracle SQL thunk or None)
def _views() -> dict[str, tuple[QueryFn, Callable[[], str] | None]]:
    return {
        # V1-V12 as written
        "kpi_snapshot": (_q(kpi.kpi_snapshot, as_of=AS_OF), oracle.kpi_snapshot),
        "weekly_noshow": (_q(weekly.weekly_noshow, as_of=AS_OF), oracle.weekly_noshow),
        "daily_active_users": (_q(activity.daily_active_users, as_of=AS_OF), oracle.daily_active_users),
        "conversion_funnel": (_q(funnel.conversion_funnel, as_of=AS_OF), oracle.conversion_funnel),
        "cohort_retention": (_q(cohort.cohort_retention, as_of=COHORT_AS_OF), oracle.cohort_retention),
        "dropoff_counts": (_q(dropoff.dropoff_counts, as_of=AS_OF), oracle.dropoff_counts),
        "dropoff_report": (_q(dropoff.dropoff_report, as_of=AS_OF), oracle.dropoff_report),
        "reminder_by_type": (_q(reminders.reminder_by_type, as_of=AS_OF), oracle.reminder_by_type),
        "delay_bands": (_q(delays.delay_bands), oracle.delay_bands),
        "prepay_funnel": (_q(weekly.prepay_funnel, as_of=AS_OF), oracle.prepay_funnel),
        "priority_ontime": (_q(weekly.priority_ontime, as_of=AS_OF), oracle.priority_ontime),
        "feature_adoption": (_q(adoption.feature_adoption, as_of=AS_OF), oracle.feature_adoption),
        "merge_compliance": (_q(merge.merge_compliance, as_of=AS_OF), oracle.merge_compliance),
        "merge_compliance_incremental": (_q(deltas.merge_compliance, as_of=AS_OF),
                                         oracle.merge_compliance),
        "delay_bands_incremental": (_q(incremental.delay_bands_incremental), oracle.delay_bands),
        "active_customers_incremental": (_q(deltas.active_customers), oracle_extras.active_customers_daily),
        "delivery_daily_incremental": (_q(deltas.delivery_daily), oracle_extras.delivery_daily),
        "active_daily_incremental": (_q(deltas.active_daily), lambda: oracle_extras.active_customers_daily(figures=True)),
        **{f"{view}_from_summary": (_q(deltas.from_summary, view=view, as_of=AS_OF), sql) for view, sql in (
            ("conversion_funnel", oracle.conversion_funnel), ("feature_adoption", oracle.feature_adoption), ("delay_bands", oracle.delay_bands),
            ("attendance_after_reminder", oracle_extras.attendance_after_reminder), ("delay_estimate_accuracy", oracle_extras.delay_estimate_accuracy))},
        "daily_active_users_bitmaps": (_q(deltas.daily_active_users, as_of=AS_OF), oracle.daily_active_users),
        "weekly_dau_bitmaps": (_q(deltas.weekly_dau, as_of=AS_OF), oracle_extras.weekly_dau),
        # intended metrics where the definition has a grain or semantics defect
        "kpi_snapshot_corrected": (_q(kpi.kpi_snapshot, as_of=AS_OF, corrected=True),
                                   lambda: oracle.kpi_snapshot(corrected=True)),
        "daily_active_users_corrected": (_q(activity.daily_active_users, as_of=AS_OF, corrected=True),
                                         oracle.daily_active_users_corrected),
        "conversion_funnel_corrected": (_q(funnel.conversion_funnel, as_of=AS_OF, corrected=True),
                                        lambda: oracle.conversion_funnel(corrected=True)),
        "cohort_retention_corrected": (_q(cohort.cohort_retention, as_of=COHORT_AS_OF, corrected=True),
                                       oracle.cohort_retention_corrected),
        "reminder_by_type_corrected": (_q(reminders.reminder_by_type, as_of=AS_OF, corrected=True),
                                       lambda: oracle.reminder_by_type(corrected=True)),
        "delay_bands_corrected": (_q(delays.delay_bands, corrected=True), oracle.delay_bands_corrected),
        "feature_adoption_corrected": (_q(adoption.feature_adoption, as_of=AS_OF, corrected=True),
                                       oracle.feature_adoption_corrected),
        "merge_compliance_corrected": (_q(merge.merge_compliance, as_of=AS_OF, corrected=True),
                                       oracle.merge_compliance_corrected),
        # SP1 refresh (the DataFrame that is written)
        "refresh_total_bookings": (_q(refresh.refreshed_customers), oracle.refresh_total_bookings),
        "refresh_total_bookings_corrected": (_q(refresh.refreshed_customers, corrected=True),
                                             lambda: oracle.refresh_total_bookings(corrected=True)),
        "refresh_published_two_nights": (_q(refresh.refresh_two_nights, first=FIRST_NIGHT, second=AS_OF), lambda: oracle_extras.refresh_two_nights(FIRST_NIGHT, AS_OF)),
        # Q1-Q3, Q5 data quality
        "quality_duplicate_keys": (_q(quality.duplicate_keys),
                                   lambda: oracle.duplicate_keys(schemas.PRIMARY_KEYS)),
        "quality_orphans": (_q(quality.orphans), lambda: oracle.orphans(schemas.FOREIGN_KEYS)),
        "quality_domain_violations": (_q(quality.domain_violations), oracle.domain_violations),
        "quality_checked_load": (_q(load.load_report), oracle_extras.load_report),
        "quality_band_consistency": (_q(quality.band_consistency), oracle.band_consistency),
    }


def _consumers() -> dict[str, tuple[QueryFn, Callable[[], str]]]:
    views = _views()
    out = {}
    for name, (fn, view, cols, order) in consumer.CONSUMERS.items():
        as_of = COHORT_AS_OF if view == "cohort_retention" else AS_OF
        oracle_view = views[view][1]
        out[f"consumer_{name}"] = (_q(fn, as_of=as_of),
                                   (lambda ov=oracle_view, c=cols, o=order: oracle.consumer(ov(), c, o)))
    return out


def registry() -> dict[str, tuple[QueryFn, Callable[[], str] | None]]:
    reg = _views()
    reg.update(_consumers())
    from slotwise.plans import extras
    reg.update(extras.registry(AS_OF, COHORT_AS_OF, _q))
    return reg


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in registry().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql() for k, (_, sql) in registry().items() if sql is not None}
