"""Incremental merge-pair refresh: two availableNow runs over growing folders equal batch."""

import datetime as dt

from fixture_tables import D, make_tables
from slotwise.operators import merge
from slotwise.sources.tables import Tables
from slotwise.streaming import incremental


def _events(prefix, base, gaps):
    appts, rems, dls = [], [], []
    for i, gap in enumerate(gaps):
        a = f"{prefix}{i}"
        sent = base + dt.timedelta(hours=i)
        appts.append(dict(appointment_id=a, scheduled_at=sent + dt.timedelta(hours=2)))
        rems.append(dict(event_id=f"r{a}", appointment_id=a, reminder_type="1h", sent_at=sent,
                         delivery_status="merged" if i % 2 else "sent"))
        dls.append(dict(event_id=f"d{a}", appointment_id=a, triggered_at=sent + dt.timedelta(seconds=gap)))
        dls.append(dict(event_id=f"e{a}", appointment_id=a, triggered_at=sent - dt.timedelta(seconds=gap // 2)))
    return appts, rems, dls


def _write(t, root, mode):
    for name in ("salons", "customers", "appointments", "reminder_events", "delay_events"):
        getattr(t, name).write.mode(mode).parquet(f"{root}/{name}")


def test_incremental_pairs_equal_batch(spark, tmp_path):
    root, state = str(tmp_path / "tables"), str(tmp_path / "state")
    a1, r1, d1 = _events("a", D(2025, 7, 1, 8), [30, 119, 120, 200])
    t1 = make_tables(spark, appointments=a1, reminders=r1, delays=d1)
    _write(t1, root, "overwrite")
    first = incremental.refresh_merge_pairs(spark, root, state)
    n1 = spark.read.parquet(first).count()

    a2, r2, d2 = _events("b", D(2025, 7, 3, 8), [10, 90])
    t2 = make_tables(spark, salons=[{"salon_id": "s2"}], appointments=a2, reminders=r2, delays=d2)
    _write(t2, root, "append")
    second = incremental.refresh_merge_pairs(spark, root, state)
    assert second == first
    pairs = spark.read.parquet(second)
    assert pairs.count() > n1

    t = Tables.from_parquet(spark, root, normalize=False)
    as_of = dt.date(2025, 7, 9)
    batch = {tuple(r) for r in merge.merge_compliance(t, as_of).collect()}
    inc = {tuple(r) for r in incremental.merge_compliance_from_pairs(t, pairs, as_of).collect()}
    assert batch == inc and batch


def test_daily_delivery_windows_close_with_watermark(spark, tmp_path):
    from pyspark.sql import functions as F

    root, state = str(tmp_path / "tables"), str(tmp_path / "state")
    day = lambda d, h: D(2025, 7, d, h)
    rems = [dict(event_id=f"r{i}", appointment_id="a1", sent_at=day(1 + i % 3, 9 + i % 5),
                 delivery_status=["sent", "failed", "merged"][i % 3]) for i in range(30)]
    t1 = make_tables(spark, appointments=[dict(appointment_id="a1", scheduled_at=D(2025, 7, 9))], reminders=rems)
    _write(t1, root, "overwrite")

    def run():
        q = incremental.delivery_daily_stream(spark, root, f"{state}/out", f"{state}/ck")
        q.awaitTermination()
        return {r.sent_date: r for r in spark.read.parquet(f"{state}/out").collect()}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before     # stream start leaves it as it was
    # latest send is 3 July 13:00, lateness 1 day: only 1 July is closed after the first run
    assert sorted(first) == [dt.date(2025, 7, 1)]
    batch = (t1.reminder_events.groupBy(F.col("sent_at").cast("date").alias("d"))
             .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("delivery_status") == "failed", 1)).alias("f"))
             .collect())
    want = {r.d: (r.n, r.f) for r in batch}
    assert (first[dt.date(2025, 7, 1)].reminders, first[dt.date(2025, 7, 1)].failed) == want[dt.date(2025, 7, 1)]

    # new data a week later advances the watermark; a reminder for 1 July arriving now is late
    late = [dict(event_id="late", appointment_id="a1", sent_at=day(1, 10), delivery_status="failed"),
            dict(event_id="new", appointment_id="a1", sent_at=day(9, 10), delivery_status="sent")]
    t2 = make_tables(spark, salons=[{"salon_id": "s9"}], reminders=late)
    _write(t2, root, "append")
    second = run()
    assert sorted(second) == [dt.date(2025, 7, d) for d in (1, 2, 3)]
    for d in (1, 2, 3):
        got = second[dt.date(2025, 7, d)]
        assert (got.reminders, got.failed) == want[dt.date(2025, 7, d)]     # late row not counted


def test_delay_state_updates_equal_batch(spark, tmp_path):
    from slotwise.operators import delays

    root, state = str(tmp_path / "tables"), str(tmp_path / "state")
    appts = [dict(appointment_id=f"a{i}", scheduled_at=D(2025, 7, 1 + i, 10),
                  status=["attended", "no_show"][i % 2]) for i in range(4)]
    first = [dict(event_id=f"d{i}", appointment_id=f"a{i % 4}", triggered_at=D(2025, 7, 1, 9), delay_minutes=5 * i,
                  delay_band=["on_schedule", "minor"][i % 2], reschedule_shown=i % 3 == 0,
                  customer_action="reschedule" if i % 3 == 0 else None) for i in range(8)]
    _write(make_tables(spark, appointments=appts, delays=first), root, "overwrite")
    log = f"{state}/log"
    incremental.delay_state_stream(spark, root, log, f"{state}/ck").awaitTermination()
    # later: a0 gets a major delay (its worst band changes), a new appointment's events arrive
    later = [dict(event_id="x1", appointment_id="a0", triggered_at=D(2025, 7, 1, 9, 30), delay_minutes=75,
                  delay_band="major", reschedule_shown=True, customer_action="reschedule")]
    _write(make_tables(spark, salons=[{"salon_id": "s9"}], delays=later), root, "append")
    incremental.delay_state_stream(spark, root, log, f"{state}/ck").awaitTermination()

    from slotwise.sources.tables import Tables
    t = Tables.from_parquet(spark, root, normalize=False)
    latest = {r.appointment_id: tuple(r) for r in incremental.latest_delay_state(spark, log).collect()}
    batch = {r.appointment_id: tuple(r) for r in
             delays.delay_per_appointment(t).select(*incremental.STATE_COLUMNS).collect()}
    assert latest == batch and latest["a0"][2] == 4
    streamed = delays.bands_from_per_appointment(t, incremental.latest_delay_state(spark, log))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, delays.delay_bands(t).collect()))


def test_active_customers_deduplicated_per_day(spark, tmp_path):
    root, state = str(tmp_path / "tables"), str(tmp_path / "state")
    appts = [dict(appointment_id="a1", customer_id="c1", scheduled_at=D(2025, 7, 1, 10), status="attended"),
             dict(appointment_id="a2", customer_id="c2", scheduled_at=D(2025, 7, 1, 15), status="no_show"),
             dict(appointment_id="a3", customer_id="c1", scheduled_at=D(2025, 7, 2, 11), status="confirmed"),
             dict(appointment_id="a4", customer_id="c3", scheduled_at=D(2025, 7, 5, 9), status="attended")]
    # c1 also acts on a reminder on 1 July (same day: counted once) and on 2 July (only activity that day)
    rems = [dict(event_id="r1", appointment_id="a1", sent_at=D(2025, 7, 1, 8), customer_action="none"),
            dict(event_id="r2", appointment_id="a3", sent_at=D(2025, 7, 2, 9), customer_action="cancel")]
    _write(make_tables(spark, appointments=appts, reminders=rems), root, "overwrite")
    incremental.active_customers_stream(spark, root, f"{state}/out", f"{state}/ck").awaitTermination()
    got = {r.activity_date: r.dau for r in spark.read.parquet(f"{state}/out").collect()}
    # latest activity 5 July 09:00, lateness 1 day: days up to 3 July are closed
    assert got == {dt.date(2025, 7, 1): 2, dt.date(2025, 7, 2): 1}
