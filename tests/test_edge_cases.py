"""FIXTURES §4 edge cases on hand-made tables; expected values follow from the definitions."""

import datetime as dt
from decimal import Decimal

from fixture_tables import D, make_tables
from slotwise.operators import (activity, adoption, cohort, delays, dropoff, kpi, merge, refresh,
                                reminders, weekly)

AS_OF = dt.date(2025, 7, 9)


def test_priority_minute_rule_f1_f2(spark):
    appts = [
        dict(appointment_id="a1", is_priority=True, status="attended",
             scheduled_at=D(2025, 7, 1, 10, 0, 59), marked_at=D(2025, 7, 1, 10, 6, 0)),   # late (6)
        dict(appointment_id="a2", is_priority=True, status="attended",
             scheduled_at=D(2025, 7, 1, 10, 0, 0), marked_at=D(2025, 7, 1, 10, 5, 59)),   # on time
        dict(appointment_id="a3", is_priority=True, status="attended",
             scheduled_at=D(2025, 7, 1, 10, 0, 0), marked_at=D(2025, 7, 1, 9, 58, 0)),    # early
        dict(appointment_id="a4", is_priority=True, status="attended",
             scheduled_at=D(2025, 7, 1, 10, 0, 0), marked_at=None),                        # neither
    ]
    t = make_tables(spark, appointments=appts)
    r = weekly.priority_ontime(t, AS_OF).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.priority_appointments, r.on_time_count, r.late_count, r.on_time_rate_pct) == \
           (4, 2, 1, Decimal("50.0"))


def test_wow_skips_missing_week_f5(spark):
    # week 10 of 2025 starts Sun 2 Mar, week 12 starts Sun 16 Mar; week 11 has no booking
    appts = [dict(appointment_id="a1", scheduled_at=D(2025, 3, 3, 10), status="no_show"),
             dict(appointment_id="a2", scheduled_at=D(2025, 3, 4, 10), status="attended"),
             dict(appointment_id="a3", scheduled_at=D(2025, 3, 17, 10), status="attended"),
             dict(appointment_id="a4", scheduled_at=D(2025, 3, 18, 10), status="attended"),
             dict(appointment_id="a5", scheduled_at=D(2025, 3, 19, 10), status="no_show")]
    t = make_tables(spark, appointments=appts)
    rows = sorted(weekly.weekly_noshow(t, dt.date(2025, 4, 1)).collect(), key=lambda r: r.iso_week)
    assert [r.iso_week for r in rows] == [10, 12]
    assert rows[0].wow_change_pct is None
    # 33.333.. - 50 = -16.67 (unrounded rates)
    assert rows[1].wow_change_pct == Decimal("-16.67")
    assert rows[0].week_start == dt.date(2025, 3, 3) and rows[0].week_end == dt.date(2025, 3, 4)


def test_dau_average_truncates_f6(spark):
    appts = [dict(appointment_id="a1", customer_id="c1", scheduled_at=D(2025, 7, 8, 10), status="attended"),
             dict(appointment_id="a2", customer_id="c2", scheduled_at=D(2025, 7, 8, 11), status="attended"),
             dict(appointment_id="a3", customer_id="c1", scheduled_at=D(2025, 7, 9, 10), status="no_show")]
    t = make_tables(spark, appointments=appts)
    w = sorted(activity.daily_active_users(t, AS_OF, days=1).collect(), key=lambda r: r.activity_date)
    assert [(r.dau, r.dau_7day_avg) for r in w] == [(2, 2), (1, 1)]
    c = sorted(activity.daily_active_users(t, AS_OF, days=1, corrected=True).collect(),
               key=lambda r: r.activity_date)
    assert [r.dau_7day_avg for r in c] == [Decimal("2.00"), Decimal("1.50")]


def test_dau_days_without_activity(spark):
    t = make_tables(spark, appointments=[dict(appointment_id="a1", scheduled_at=D(2025, 7, 1, 10),
                                              status="confirmed")])
    rows = activity.daily_active_users(t, AS_OF).collect()
    assert len(rows) == 91 and all(r.dau == 0 for r in rows)


def test_none_action_engagement_f7(spark):
    appts = [dict(appointment_id="a1", scheduled_at=D(2025, 7, 5, 10))]
    rems = [dict(event_id="r1", appointment_id="a1", sent_at=D(2025, 7, 4, 10), customer_action="none")]
    t = make_tables(spark, appointments=appts, reminders=rems)
    assert reminders.reminder_by_type(t, AS_OF).first().total_engaged == 1
    assert reminders.reminder_by_type(t, AS_OF, corrected=True).first().total_engaged == 0


def test_cohort_sizes_f8(spark):
    appts = [dict(appointment_id=f"j{i}", customer_id=f"c{i}", created_at=D(2025, 1, 10),
                  scheduled_at=D(2025, 1, 20), status="confirmed") for i in range(3)]
    appts += [dict(appointment_id=f"f{i}", customer_id=f"c{i}", created_at=D(2025, 2, 10),
                   scheduled_at=D(2025, 2, 20), status="attended") for i in range(2)]
    t = make_tables(spark, appointments=appts)
    rows = {r.months_since_first: r for r in cohort.cohort_retention(t, dt.date(2025, 6, 1)).collect()}
    assert (rows[1].retained_customers, rows[1].cohort_size, rows[1].retention_rate_pct) == (2, 2, Decimal("100.0"))
    assert (rows[None].retained_customers, rows[None].cohort_size, rows[None].retention_rate_pct) == \
           (0, 1, Decimal("0.0"))
    c = cohort.cohort_retention(t, dt.date(2025, 6, 1), corrected=True).collect()
    assert [(r.months_since_first, r.retained_customers, r.cohort_size, r.retention_rate_pct) for r in c] == \
           [(1, 2, 3, Decimal("66.7"))]
    assert c[0].cohort_label == "Jan 2025"


def test_delay_fanout_f9(spark):
    appts = [dict(appointment_id="a1", scheduled_at=D(2025, 7, 5, 10), status="attended")]
    dls = [dict(event_id=f"d{i}", appointment_id="a1", triggered_at=D(2025, 7, 5, 9, i),
                delay_minutes=10 * i, delay_band=b) for i, b in enumerate(["on_schedule", "minor", "moderate"])]
    t = make_tables(spark, appointments=appts, delays=dls)
    r = delays.delay_bands(t).collect()
    assert [(x.delay_band_label, x.total_appointments, x.ultimately_attended) for x in r] == \
           [("Moderate (30-59 min)", 1, 3)]
    assert delays.delay_bands(t, corrected=True).first().ultimately_attended == 1


def test_feature_adoption_weighting_f10_f11(spark):
    salons = [dict(salon_id="s1", prepay_enabled=True), dict(salon_id="s2"),
              dict(salon_id="s3", is_active=False)]
    appts = [dict(appointment_id="a1", salon_id="s1", scheduled_at=D(2025, 7, 5, 10), status="no_show",
                  payment_status="successful")]
    rems = [dict(event_id=f"r{i}", appointment_id="a1", sent_at=D(2025, 7, 4, 10)) for i in range(4)]
    t = make_tables(spark, salons=salons, appointments=appts, reminders=rems)
    rows = {r.salon_id: r for r in adoption.feature_adoption(t, AS_OF).collect()}
    assert set(rows) == {"s1", "s2"}
    s1 = rows["s1"]
    assert (s1.total_appointments_30d, s1.no_shows_30d, s1.salon_noshow_rate_pct, s1.prepay_adoption_pct) == \
           (1, 4, Decimal("400.0"), Decimal("400.0"))
    s2 = rows["s2"]
    assert (s2.total_appointments_30d, s2.no_shows_30d, s2.salon_noshow_rate_pct,
            s2.reminder_engagement_pct, s2.prepay_adoption_pct) == (0, 0, None, None, None)
    c = {r.salon_id: r for r in adoption.feature_adoption(t, AS_OF, corrected=True).collect()}["s1"]
    assert (c.no_shows_30d, c.salon_noshow_rate_pct) == (1, Decimal("100.0"))


def _merge_tables(spark, pairs, cal=None):
    appts, rems, dls = [], [], []
    for i, (sent, gap) in enumerate(pairs):
        appts.append(dict(appointment_id=f"a{i}", scheduled_at=sent + dt.timedelta(hours=2)))
        rems.append(dict(event_id=f"r{i}", appointment_id=f"a{i}", reminder_type="2h", sent_at=sent,
                         delivery_status="merged"))
        dls.append(dict(event_id=f"d{i}", appointment_id=f"a{i}", triggered_at=sent + dt.timedelta(seconds=gap)))
    return make_tables(spark, appointments=appts, reminders=rems, delays=dls)


def test_merge_window_f12(spark):
    t = _merge_tables(spark, [(D(2025, 7, 1, 10), 119), (D(2025, 7, 1, 11), 120), (D(2025, 7, 1, 12), -119)])
    rows = merge.merge_compliance(t, AS_OF, corrected=True).collect()
    assert [(r.total_overlaps, r.reminders_with_overlap) for r in rows] == [(2, 2)]


def test_merge_calendar_multiplier_f13(spark):
    cases = [(D(2025, 7, 1, 10), dt.date(2025, 7, 9), 7),     # full week
             (D(2025, 1, 2, 10), dt.date(2025, 1, 10), 4),    # 2025 week 1: 1-4 Jan
             (D(2025, 12, 29, 10), dt.date(2026, 1, 2), 4),   # 2025 week 53: 28-31 Dec
             (D(2026, 1, 2, 10), dt.date(2026, 1, 10), 3)]    # 2026 week 1: 1-3 Jan
    for sent, as_of, k in cases:
        t = _merge_tables(spark, [(sent, 30)])
        r = merge.merge_compliance(t, as_of).collect()
        assert [(x.total_overlaps, x.correctly_merged, x.compliance_pct) for x in r] == [(k, k, Decimal("100.0"))]
        c = merge.merge_compliance(t, as_of, corrected=True).collect()
        assert [x.total_overlaps for x in c] == [1]


def test_empty_window_f14(spark):
    t = make_tables(spark, appointments=[dict(appointment_id="old", scheduled_at=D(2024, 1, 1))])
    counts = dropoff.dropoff_counts(t, AS_OF).collect()
    assert len(counts) == 5 and all(r.occurrences == 0 for r in counts)
    k = kpi.kpi_snapshot(t, AS_OF).first()
    assert k.total_appointments == 0 and k.reminders_sent == 0
    assert k.total_no_shows is None and k.no_show_rate_pct is None and k.delivery_rate_pct is None
    assert k.prepay_revenue_30d == Decimal("0.00") and k.snapshot_date == AS_OF
    assert k.baseline_pct == Decimal("40.0")


def test_outside_calendar_f15(spark):
    appts = [dict(appointment_id="x", scheduled_at=D(2024, 12, 31, 10), created_at=D(2024, 12, 30),
                  is_priority=True)]
    t = make_tables(spark, appointments=appts)
    as_of = dt.date(2025, 1, 2)
    assert weekly.weekly_noshow(t, as_of).count() == 0
    assert weekly.priority_ontime(t, as_of).count() == 0
    assert kpi.kpi_snapshot(t, as_of).first().total_appointments == 1


def test_refresh_keeps_unmatched_f18(spark):
    customers = [dict(customer_id="c1", total_bookings=5), dict(customer_id="c2", total_bookings=9)]
    appts = [dict(appointment_id="a1", customer_id="c2", scheduled_at=D(2025, 7, 1))]
    t = make_tables(spark, customers=customers, appointments=appts)
    got = {r.customer_id: r.total_bookings for r in refresh.refreshed_customers(t).collect()}
    assert got == {"c1": 5, "c2": 1}
    got = {r.customer_id: r.total_bookings for r in refresh.refreshed_customers(t, corrected=True).collect()}
    assert got == {"c1": 0, "c2": 1}


def test_run_refresh_writes_and_counts(spark, tmp_path):
    customers = [dict(customer_id="c1", total_bookings=5), dict(customer_id="c2", total_bookings=9)]
    appts = [dict(appointment_id="a1", customer_id="c2", scheduled_at=D(2025, 7, 1))]
    t = make_tables(spark, customers=customers, appointments=appts)
    out = refresh.run_refresh(t, str(tmp_path / "customers"))
    assert (out["rows_written"], out["rows_updated"]) == (2, 1)
    assert spark.read.parquet(out["path"]).count() == 2


def test_dropoff_report_has_six_rows(spark):
    t = make_tables(spark, appointments=[dict(appointment_id="a", scheduled_at=D(2025, 7, 5),
                                              payment_status="expired")])
    rows = {r.drop_off_point: r.occurrences for r in dropoff.dropoff_report(t, AS_OF).collect()}
    assert len(rows) == 6 and rows["Payment hold expired"] == 1
    assert rows["Late booking – reminders skipped"] is None


def test_dashboard_params(spark):
    r = kpi.dashboard_params(spark, AS_OF).first()
    assert r.default_start_26w == AS_OF - dt.timedelta(weeks=26)
    assert r.priority_ontime_target == Decimal("90.0")
