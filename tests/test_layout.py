import contextlib
import io

from fixture_tables import D, make_tables
from slotwise.operators import adoption, delays
from slotwise.sources import layout


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def test_bucketed_layout_removes_event_shuffles(spark, tmp_path):
    appts = [dict(appointment_id=f"a{i}", customer_id=f"c{i % 4}", scheduled_at=D(2025, 7, 1 + i % 8, 10),
                  status=["attended", "no_show"][i % 2]) for i in range(40)]
    dls = [dict(event_id=f"d{i}", appointment_id=f"a{i % 40}", triggered_at=D(2025, 7, 1, 9), delay_minutes=i % 90,
                delay_band=["on_schedule", "minor", "moderate", "major"][i % 4]) for i in range(120)]
    rems = [dict(event_id=f"r{i}", appointment_id=f"a{i % 40}", sent_at=D(2025, 7, 1, 8)) for i in range(80)]
    t = make_tables(spark, appointments=appts, delays=dls, reminders=rems)
    layout.write_bucketed(t, "slotwise_layout_test", str(tmp_path / "wh"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # force shuffle joins to show them
    try:
        b = layout.tables_from_catalog(spark, "slotwise_layout_test")
        plan = _plan(delays.delay_bands(b))
        # per-appointment aggregation and the join to appointments read buckets: the only
        # exchanges left are the small band rollup ones
        below_join = plan.split("SortMergeJoin")[1]
        assert "Exchange" not in below_join, plan
        assert sorted(map(tuple, delays.delay_bands(b).collect())) == sorted(map(tuple, delays.delay_bands(t).collect()))
        import datetime as dt
        as_of = dt.date(2025, 7, 9)
        assert sorted(map(tuple, adoption.feature_adoption(b, as_of).collect())) == \
               sorted(map(tuple, adoption.feature_adoption(t, as_of).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS slotwise_layout_test CASCADE")


def test_month_partitioned_layout_prunes_and_matches(spark, tmp_path):
    import datetime as dt

    from slotwise.operators import activity, kpi, merge
    from slotwise.sources.tables import Tables

    appts = [dict(appointment_id=f"a{i}", customer_id=f"c{i % 5}", scheduled_at=D(2025, 1 + i % 7, 1 + i % 27, 10),
                  status=["attended", "no_show", "cancelled"][i % 3]) for i in range(60)]
    rems = [dict(event_id=f"r{i}", appointment_id=f"a{i % 60}", reminder_type=["2h", "1h"][i % 2],
                 sent_at=D(2025, 1 + i % 7, 1 + i % 27, 8), customer_action=["none", None][i % 2],
                 delivery_status="merged") for i in range(90)]
    dls = [dict(event_id=f"d{i}", appointment_id=f"a{i % 60}",
                triggered_at=D(2025, 1 + i % 7, 1 + i % 27, 8, 0, 30)) for i in range(90)]
    t = make_tables(spark, appointments=appts, reminders=rems, delays=dls)
    root = str(tmp_path / "monthly")
    layout.write_time_partitioned(t, root)
    p = Tables.from_parquet(spark, root, normalize=False)
    assert "scheduled_month" in p.appointments.columns
    as_of = dt.date(2025, 7, 9)
    for f in (lambda x: kpi.kpi_snapshot(x, as_of), lambda x: activity.daily_active_users(x, as_of),
              lambda x: merge.merge_compliance(x, as_of)):
        assert sorted(map(tuple, f(p).collect())) == sorted(map(tuple, f(t).collect()))
    full = io.StringIO()
    with contextlib.redirect_stdout(full):
        kpi.kpi_snapshot(p, as_of).explain("formatted")
    # the 30-day window (from 2025-06-09) prunes month directories before 2025-06
    assert "PartitionFilters: [isnotnull(scheduled_month" in full.getvalue()
    assert ">= 2025-06)]" in full.getvalue()
