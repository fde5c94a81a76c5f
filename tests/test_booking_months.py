"""Event tables by their booking's month: pruned scans, equal figures, moved bookings."""

import contextlib
import datetime as dt
import io

import pytest

from fixture_tables import D, make_tables
from slotwise.functions.dates import BOOKING_MONTH
from slotwise.operators import activity, adoption, dashboard, dropoff, funnel, kpi, product, reminders
from slotwise.sources import layout
from slotwise.sources.tables import Tables

AS_OF = dt.date(2025, 7, 9)
VIEWS = {
    "V1": lambda t: kpi.kpi_snapshot(t, AS_OF), "V4": lambda t: funnel.conversion_funnel(t, AS_OF, months=1),
    "V6b": lambda t: dropoff.dropoff_counts(t, AS_OF), "V11": lambda t: adoption.feature_adoption(t, AS_OF),
    "M4": lambda t: product.attendance_after_reminder(t, AS_OF), "M11": lambda t: product.missed_reminders(t, AS_OF),
    "M12": lambda t: product.delay_check_coverage(t, AS_OF),
}


LOOKUPS = {
    "V3": lambda t: activity.daily_active_users(t, AS_OF, days=20), "V7": lambda t: reminders.reminder_by_type(t, AS_OF),
    "M13": lambda t: product.confirmation_sla(t, AS_OF, weeks=4), "D2": lambda t: dashboard.reminder_engagement_weekly(t, AS_OF, weeks=4),
}


def tables(spark):
    salons = [dict(salon_id=f"s{i}", reminder_30min=bool(i), delay_tracker=True, prepay_enabled=True, is_active=True) for i in range(2)]
    appts = [dict(appointment_id=f"a{i}", salon_id=f"s{i % 2}", customer_id=f"c{i % 5}", scheduled_at=D(2025, 1 + i % 7, 1 + i % 27, 10),
                  status=["attended", "no_show", "rescheduled"][i % 3], payment_status=["successful", "expired"][i % 2]) for i in range(60)]
    # reminders are sent up to months before the booking: their own month would not do
    rems = [dict(event_id=f"r{i}", appointment_id=f"a{i % 64}", reminder_type=["confirmation", "24h", "2h", "1h", "30min"][i % 5],
                 sent_at=None if i % 9 == 0 else D(2025, 1 + (i * 5) % 7, 1 + i % 27, 8), customer_action=["none", None, "cancel"][i % 3],
                 delivery_status=["sent", "failed"][i % 2]) for i in range(150)]
    dls = [dict(event_id=f"d{i}", appointment_id=f"a{i % 64}", triggered_at=D(2025, 1 + (i * 3) % 7, 1 + i % 27, 8),
                reschedule_shown=i % 2 == 0, message_sent=True) for i in range(90)]
    return make_tables(spark, salons=salons, appointments=appts, reminders=rems, delays=dls)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    t = tables(spark)
    layout.write_time_partitioned(t, root)
    return t, Tables.from_parquet(spark, root, normalize=False)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", list(VIEWS))
def test_every_event_scan_is_pruned_and_figures_agree(stored, name):
    plain, by_month = stored
    got = VIEWS[name](by_month)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, VIEWS[name](plain).collect()), key=repr)
    scans = [b for b in plan(got).split("\n\n") if "Scan parquet" in b.split("\n")[0] and ("reminder_events" in b or "delay_events" in b)]
    assert scans and all("PartitionFilters" in b and f"{BOOKING_MONTH}" in b.split("PartitionFilters")[1].split("\n")[0] for b in scans)


@pytest.mark.parametrize("name", list(LOOKUPS))
def test_bookings_are_looked_up_in_the_events_months(stored, name):
    plain, by_month = stored
    got = LOOKUPS[name](by_month)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, LOOKUPS[name](plain).collect()), key=repr)
    scans = [b for b in plan(got).split("\n\n") if "Scan parquet" in b.split("\n")[0] and "/appointments" in b]
    assert scans and all("PartitionFilters" in b and "scheduled_month" in b.split("PartitionFilters")[1].split("\n")[0] for b in scans)
    assert any("dynamicpruning" in b for b in scans)


def test_a_booking_without_a_time_is_found_by_its_events(spark, tmp_path):
    t = tables(spark)
    from pyspark.sql import functions as F

    t = t.with_tables(appointments=t.appointments.withColumn("scheduled_at", F.when(F.col("appointment_id") != "a7", F.col("scheduled_at"))))
    layout.write_time_partitioned(t, str(tmp_path))
    by_month = Tables.from_parquet(spark, str(tmp_path), normalize=False)
    for name, view in LOOKUPS.items():
        assert sorted(map(tuple, view(by_month).collect()), key=repr) == sorted(map(tuple, view(t).collect()), key=repr), name


def test_a_moved_booking_takes_its_events_along(spark, tmp_path):
    root = str(tmp_path)
    t = tables(spark)
    layout.write_time_partitioned(t, root)
    moved = {"a0": D(2025, 7, 20, 9), "a5": D(2025, 9, 1, 9), "a62": D(2025, 7, 2, 9), "a1": D(2025, 2, 3, 9)}    # a62 had no booking; a1 stays in its month
    rows = spark.createDataFrame([(k, v) for k, v in moved.items()], "appointment_id string, scheduled_at timestamp_ntz")
    from pyspark.sql import functions as F

    for name in ("reminder_events", "delay_events"):
        first = layout.move_bookings(spark, root, name, rows)
        assert "2025-01" in first and "2025-07" in first and "2025-03" not in first
        assert layout.move_bookings(spark, root, name, rows) == []                          # nothing is left to move
        got = spark.read.parquet(f"{root}/{name}")
        want = getattr(t, name)
        assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())
        months = {(r.appointment_id, r[BOOKING_MONTH]) for r in got.select("appointment_id", BOOKING_MONTH).distinct().collect()}
        at = {r.appointment_id: r.scheduled_at for r in t.appointments.collect()} | moved
        assert months == {(a, f"{at[a]:%Y-%m}" if a in at else None) for a, _ in months}
    old = t.appointments.join(rows.withColumnRenamed("scheduled_at", "_at"), "appointment_id", "left")
    now = old.withColumn("scheduled_at", F.coalesce("_at", "scheduled_at")).select(*t.appointments.columns)
    fresh = Tables.from_parquet(spark, root, normalize=False).with_tables(appointments=now)
    for name, view in VIEWS.items():
        assert sorted(map(tuple, view(fresh).collect()), key=repr) == sorted(map(tuple, view(t.with_tables(appointments=now)).collect()), key=repr), name
