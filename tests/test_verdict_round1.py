"""Cases that went wrong before: alert thresholds, unsent reminders, calendars, hot keys."""

import datetime as dt

from pyspark.sql import functions as F

from slotwise.operators import product
from slotwise.plans import nightly
from slotwise.sources import adapter, layout
from tests.fixture_tables import make_tables


def test_alerts_compare_counts_not_rounded_rates(spark):
    rows = [("x" + str(i), "failed" if i < 504 else "sent", dt.datetime(2025, 7, 1, 9)) for i in range(10_000)]
    events = spark.createDataFrame(rows, "event_id string, delivery_status string, sent_at timestamp_ntz")
    t = make_tables(spark).with_tables(reminder_events=events)
    got = product.delivery_alerts(t, dt.date(2025, 7, 9)).first()
    assert got["failure_alert"] and got["delivery_alert"]


def test_order_key_with_a_third_of_the_lines_is_gathered_before_the_shuffle(spark):
    lines = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long").alias("l_orderkey"),
                                     (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"))
    keys = adapter._event_keys(lines, F.col("l_linenumber") <= 5)
    assert keys.count() == lines.where("l_linenumber <= 5").distinct().count()
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan


def test_events_without_time_are_spread(spark):
    events = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 > 0, F.timestamp_seconds(1_750_000_000 + F.col("id") * 60).cast("timestamp_ntz")).alias("sent_at"))
    out, _ = layout.time_partitioned(events, "reminder_events", 8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 4000 / 8


def test_calendar_follows_the_bookings(spark):
    rows = [(dt.datetime(2026, 12, 30, 9), dt.datetime(2026, 12, 1)), (dt.datetime(2027, 1, 5, 9), dt.datetime(2026, 12, 1))]
    booked = spark.createDataFrame(rows, "scheduled_at timestamp_ntz, created_at timestamp_ntz")
    start, end = nightly.data_calendar(make_tables(spark).with_tables(appointments=booked), dt.date(2027, 1, 10))
    assert start <= dt.date(2026, 12, 1) and end >= dt.date(2027, 1, 31)
