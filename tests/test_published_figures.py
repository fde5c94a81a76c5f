"""The few figures the source publishes that follow from its definitions."""

import datetime as dt
from decimal import Decimal

from fixture_tables import D, make_tables
from pyspark.sql import functions as F

from slotwise.operators import dashboard, product


def test_kpi_bar_widths(spark):
    # (value, reference) of the five KPI cards -> displayed bar widths
    cards = [("57.8", "60.0", 96), ("95.4", "95.0", 100), ("66.3", "70.0", 95), ("48.2", "55.0", 88),
             ("31.4", "40.0", 78)]
    df = spark.createDataFrame([(Decimal(v), Decimal(r)) for v, r, _ in cards], "v decimal(5,1), r decimal(3,1)")
    got = [row[0] for row in df.select(dashboard.attainment_pct(F.col("v"), F.col("r"))).collect()]
    assert got == [w for _, _, w in cards]


def test_feature_adoption_counts_of_eight_salons(spark):
    toggles = [(True, True, True), (True, True, True), (False, True, True), (True, True, False),
               (False, True, False), (True, False, True), (False, False, False), (True, True, True)]
    salons = [dict(salon_id=f"s{i}", reminder_30min=a, delay_tracker=b, prepay_enabled=c)
              for i, (a, b, c) in enumerate(toggles)]
    r = dashboard.feature_adoption_summary(make_tables(spark, salons=salons)).first()
    assert (r.with_30min_reminder, r.with_delay_tracker, r.with_prepay, r.with_all_three, r.total_salons) == \
           (5, 6, 5, 3, 8)
    assert r.full_adoption_pct == Decimal("37.5")


def test_recovery_per_salon_week(spark):
    # 50 bookings a week at 800 on average, no-show rate 30 % against the 40 % baseline
    weeks, as_of = 12, dt.date(2025, 7, 9)
    start = D(2025, 7, 9) - dt.timedelta(weeks=weeks)
    appts = [dict(appointment_id=f"a{i}", scheduled_at=start + dt.timedelta(hours=3 * i + 1),
                  status="no_show" if i % 10 < 3 else "attended", original_price=Decimal("800.00"))
             for i in range(50 * weeks)]
    r = product.recovered_revenue(make_tables(spark, appointments=appts), as_of, weeks).first()
    assert (r.bookings_per_week, r.no_show_rate_pct, r.avg_price) == (Decimal("50.00"), Decimal("30.0"),
                                                                      Decimal("800.00"))
    assert r.recovered_per_week == Decimal("4000.00")
    assert r.recovered_per_year == Decimal("208000.00")
