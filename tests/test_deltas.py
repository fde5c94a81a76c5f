"""State kept from new rows only: second runs with late rows equal the batch view over everything."""

import datetime as dt

import pytest

from fixture_tables import D, make_tables
from slotwise.operators import activity, merge
from slotwise.sources import publish
from slotwise.sources.tables import Tables
from slotwise.streaming import deltas

NAMES = ("salons", "customers", "appointments", "reminder_events", "delay_events")
AS_OF = dt.date(2025, 7, 9)


def add(t, root):
    for name in NAMES:
        getattr(t, name).write.mode("append").parquet(f"{root}/{name}")


def days(spark):
    a = [dict(appointment_id=f"a{i}", customer_id=f"c{i % 3}", salon_id=f"s{i % 2}", scheduled_at=D(2025, 7, 1 + i % 4, 10),
              status=["attended", "confirmed", "no_show"][i % 3]) for i in range(9)]
    r = [dict(event_id=f"r{i}", appointment_id=f"a{i % 12}", reminder_type="1h", sent_at=D(2025, 7, 1 + i % 5, 9, i),
              delivery_status=["sent", "failed", "merged"][i % 3], customer_action=["none", None][i % 2]) for i in range(24)]
    first = make_tables(spark, appointments=a, reminders=r)
    # later: an old day's rows, a new day, and the appointments three reminders were waiting for
    late = [dict(appointment_id=f"a{i}", customer_id=f"late{i}", salon_id="s1", scheduled_at=D(2025, 7, 1, 12), status="attended") for i in (9, 10, 11)]
    more = [dict(event_id="x1", appointment_id="a1", reminder_type="1h", sent_at=D(2025, 7, 1, 10), delivery_status="failed", customer_action="cancel"),
            dict(event_id="x2", appointment_id="a9", reminder_type="1h", sent_at=D(2025, 8, 9, 10), delivery_status="sent", customer_action="none"),
            dict(event_id="x3", appointment_id="gone", reminder_type="1h", sent_at=D(2025, 8, 9, 10), delivery_status=None, customer_action="none")]
    second = make_tables(spark, salons=[{"salon_id": "z"}], appointments=late, reminders=more)
    return first, second


def batch_daily(t):
    rows = activity.activity(t, dt.date(2020, 1, 1), dt.date(2030, 1, 1)).collect()
    out = {}
    for r in rows:
        for k, v in enumerate((r.customer_id, r.salon_id, r.appointment_id)):
            out.setdefault(r.activity_date, (set(), set(), set()))[k].add(v)
    return {d: tuple(map(len, x)) for d, x in out.items()}


def test_active_customers_of_all_days(spark, tmp_path):
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    for part in days(spark):
        add(part, root)
        t = Tables.from_parquet(spark, root, normalize=False)
        got = {r.activity_date: tuple(r)[1:] for r in deltas.active_daily(t, state).collect()}
        assert got == batch_daily(t)
    assert {r.activity_date: tuple(r)[1:] for r in deltas.active_daily(t, state).collect()} == got     # nothing new, nothing changes


def test_delivery_of_all_days_with_late_rows(spark, tmp_path):
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for part in days(spark):
        add(part, root)
        t = Tables.from_parquet(spark, root, normalize=False)
        got = {r.sent_date: (r.reminders, r.failed, r.delivered) for r in deltas.delivery_daily(t, state).collect()}
        want = {}
        for r in t.reminder_events.collect():
            n = want.setdefault(r.sent_at.date(), [0, 0, 0])
            n[0], n[1], n[2] = n[0] + 1, n[1] + (r.delivery_status == "failed"), n[2] + (r.delivery_status == "sent")
        assert got == {d: tuple(n) for d, n in want.items()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_pairs_with_late_events_on_both_sides(spark, tmp_path):
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    base = D(2025, 7, 1, 23, 59)                                                     # near midnight: neighbouring days meet

    def part(prefix, rems, gaps):
        appts = [dict(appointment_id="a", scheduled_at=base)] if prefix == "1" else []
        r = [dict(event_id=f"r{prefix}{i}", appointment_id="a", reminder_type="2h", sent_at=base + dt.timedelta(seconds=s),
                  delivery_status=["merged", "sent"][i % 2]) for i, s in enumerate(rems)]
        d = [dict(event_id=f"d{prefix}{i}", appointment_id="a", triggered_at=base + dt.timedelta(seconds=s)) for i, s in enumerate(gaps)]
        return make_tables(spark, salons=[{"salon_id": prefix}], appointments=appts, reminders=r, delays=d)

    # the second run brings delay events for old reminders and old-day reminders for old delay events
    for k, (rems, gaps) in enumerate([([0, 30, 400], [10, 10, 119, 120]), ([5, 500], [31, -100, 395]), ([], [60]), ([61], [])], 1):
        add(part(str(k), rems, gaps), root)
        t = Tables.from_parquet(spark, root, normalize=False)
        for corrected in (False, True):
            got = sorted(map(tuple, deltas.merge_compliance(t, AS_OF, corrected=corrected, state=state).collect()))
            assert got == sorted(map(tuple, merge.merge_compliance(t, AS_OF, corrected=corrected).collect())) and got


@pytest.mark.parametrize("kind", [deltas.DeliveryDays, deltas.ActiveCustomers, deltas.MergePairs])
def test_a_batch_run_again_counts_once(spark, tmp_path, monkeypatch, kind):
    """The job dies after a batch's state is written and before the stream commits it."""
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    first, second = days(spark)
    add(first, root)
    kept = kind(spark, root, state)
    kept.refresh()
    add(second, root)
    whole = kind._apply

    def dies(self, batch, number):
        whole(self, batch, number)
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(kind, "_apply", dies)
        with pytest.raises(Exception):
            kept.refresh()
    kept.refresh()
    once = kind(spark, root, str(tmp_path / "other"))
    once.refresh()
    read = {deltas.DeliveryDays: lambda k: k.days(), deltas.ActiveCustomers: lambda k: k.daily(), deltas.MergePairs: lambda k: k.pairs()}[kind]
    assert sorted(map(tuple, read(kept).collect())) == sorted(map(tuple, read(once).collect()))


def test_old_versions_of_the_days_go(spark, tmp_path):
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    for k in range(5):
        add(make_tables(spark, salons=[{"salon_id": f"{k}"}], reminders=[dict(event_id=f"{k}", appointment_id="a", sent_at=D(2025, 7, 1 + k, 9), delivery_status="sent")]), root)
        deltas.DeliveryDays(spark, root, state).refresh()
    assert len(publish.versions(spark, state, "days")) == 3
    assert deltas.DeliveryDays(spark, root, state).days().count() == 5


def test_bitmaps_count_like_distinct_also_over_weeks(spark, tmp_path):
    from pyspark.sql import functions as F

    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    kept = deltas.ActivityBitmaps(spark, root, state)
    for part in days(spark):
        add(part, root)
        t = Tables.from_parquet(spark, root, normalize=False)
        kept.refresh()
        assert {r.activity_date: tuple(r)[1:] for r in kept.daily().collect()} == batch_daily(t)
        for corrected in (False, True):
            got = deltas.daily_active_users(t, AS_OF, 20, corrected, state).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, activity.daily_active_users(t, AS_OF, 20, corrected).collect()))
    months = {r.m: tuple(r)[1:] for r in kept.distinct(F.date_format("activity_date", "yyyy-MM").alias("m")).collect()}
    rows = activity.activity(t, dt.date(2020, 1, 1), dt.date(2030, 1, 1)).groupBy(F.date_format("activity_date", "yyyy-MM").alias("m")).agg(
        *[F.count_distinct(c) for c in kept.KINDS])
    assert months == {r.m: tuple(r)[1:] for r in rows.collect()}
    numbers = spark.read.parquet(f"{state}/numbers")
    assert numbers.groupBy("kind").agg((F.max("n") + 1 - F.count_distinct("id")).alias("x")).where("x <> 0").count() == 0      # dense, each once


def test_summary_views_equal_the_views_over_events(spark, tmp_path, monkeypatch):
    import contextlib
    import io

    from slotwise.operators import adoption, funnel, product
    from slotwise.operators import delays as bands

    monkeypatch.setattr(deltas.AppointmentSummary, "compact_after", 2)
    root, state = str(tmp_path / "t"), str(tmp_path / "s")
    plain = {"conversion_funnel": lambda t: funnel.conversion_funnel(t, AS_OF), "feature_adoption": lambda t: adoption.feature_adoption(t, AS_OF),
             "delay_bands": bands.delay_bands, "attendance_after_reminder": lambda t: product.attendance_after_reminder(t, AS_OF),
             "delay_estimate_accuracy": lambda t: product.delay_estimate_accuracy(t, AS_OF)}
    salons = [dict(salon_id=f"s{i}", prepay_enabled=True, is_active=True) for i in range(2)]
    for k in range(5):
        a = [dict(appointment_id=f"a{k}{i}", salon_id=f"s{i % 2}", customer_id="c", scheduled_at=D(2025, 7, 1 + i, 10), marked_at=D(2025, 7, 1 + i, 10, 3 * i),
                  status=["attended", "no_show"][i % 2], payment_status="successful") for i in range(5)]
        # every run adds events to bookings of all runs so far
        r = [dict(event_id=f"r{k}{i}", appointment_id=f"a{i % (k + 1)}{i % 5}", sent_at=D(2025, 7, 1, 9), delivery_status=["failed", "sent", None][(i + k) % 3],
                  customer_action=[None, "none", "cancel"][(i * 2 + k) % 3]) for i in range(9)]
        d = [dict(event_id=f"d{k}{i}", appointment_id=f"a{i % (k + 1)}{i % 4}", triggered_at=D(2025, 7, 1, 9, (7 * i + 3 * k) % 11), delay_minutes=(13 * i + k) % 70,
                  delay_band=["on_schedule", "minor", "moderate", "major"][(i + k) % 4], reschedule_shown=i % 2 == 0, customer_action=["reschedule", None][i % 2]) for i in range(8)]
        add(make_tables(spark, salons=salons if k == 0 else [{"salon_id": f"z{k}"}], appointments=a, reminders=r, delays=d), root)
        t = Tables.from_parquet(spark, root, normalize=False)
        for view, over_events in plain.items():
            got = deltas.from_summary(t, view, AS_OF, state)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, over_events(t).collect()), key=repr), (k, view)
    assert publish.current(spark, state, "summary") is not None                                  # compacted on the way
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        got.explain("formatted")
    assert f"{root}/delay_events" not in text.getvalue() and f"{root}/reminder_events" not in text.getvalue()
