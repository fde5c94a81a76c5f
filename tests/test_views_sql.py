import datetime as dt

from fixture_tables import D, make_tables
from slotwise.plans import consumer, views
from slotwise.sources.calendar import seed_calendar


def _tables(spark):
    appts = [dict(appointment_id=f"a{i}", customer_id=f"c{i % 3}", scheduled_at=D(2025, 7, 1 + i, 10),
                  status=["attended", "no_show", "rescheduled"][i % 3]) for i in range(6)]
    rems = [dict(event_id=f"r{i}", appointment_id=f"a{i}", sent_at=D(2025, 7, 1 + i, 8),
                 customer_action="reschedule" if i % 2 else None) for i in range(6)]
    return make_tables(spark, appointments=appts, reminders=rems)


def test_register_views_and_consumer_sql(spark):
    t = _tables(spark)
    as_of = dt.date(2025, 7, 9)
    names = views.register_views(spark, t, as_of)
    assert len(names) == 13
    assert spark.sql("SELECT count(*) FROM vw_dropoff_signals").first()[0] == 6
    for name in views.CONSUMER_SQL:
        via_sql = views.consumer_sql(spark, name)
        fn = consumer.CONSUMERS[name][0]
        via_api = fn(t, as_of)
        assert via_sql.columns == via_api.columns
        assert via_sql.collect() == via_api.collect(), name


def test_seed_calendar_is_idempotent(spark, tmp_path):
    p = str(tmp_path / "dim_date")
    seed_calendar(spark, p, dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    seed_calendar(spark, p, dt.date(2025, 1, 1), dt.date(2025, 12, 31))   # guard: no rewrite
    assert spark.read.parquet(p).count() == 31


def test_nightly_job_writes_views(spark, tmp_path):
    from slotwise.plans import nightly

    t = _tables(spark)
    out = str(tmp_path / "out")
    res = nightly.run_nightly(t, dt.date(2025, 7, 9), out)
    assert res["views"]["vw_dropoff_counts"] == 5 and res["views"]["vw_dropoff_signals"] == 6
    assert spark.read.parquet(f"{out}/vw_daily_active_users/as_of=2025-07-09").count() == 91
    again = nightly.run_nightly(t, dt.date(2025, 7, 9), out)      # idempotent re-run
    assert again["views"] == res["views"]
    assert spark.read.parquet(f"{out}/vw_weekly_noshow").select("as_of").distinct().count() == 1
