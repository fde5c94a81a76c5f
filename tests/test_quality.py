from fixture_tables import D, make_tables
from pyspark.sql import functions as F

from slotwise.operators import quality
from slotwise.sources import schemas


def _bad_tables(spark):
    appts = [dict(appointment_id="a1", customer_id="c1", scheduled_at=D(2025, 7, 1), status="attended"),
             dict(appointment_id="a1", customer_id="c1", scheduled_at=D(2025, 7, 2), status="Attended"),
             dict(appointment_id="a2", customer_id="ghost", salon_id="nowhere", scheduled_at=D(2025, 7, 3),
                  rescheduled_from="a404")]
    rems = [dict(event_id="r1", appointment_id="a9", sent_at=D(2025, 7, 1), reminder_type="x" * 25)]
    dls = [dict(event_id="d1", appointment_id="a1", triggered_at=D(2025, 7, 1), delay_minutes=45,
                delay_band="minor"),
           dict(event_id="d2", appointment_id="a1", triggered_at=D(2025, 7, 1), delay_minutes=0,
                delay_band="on_schedule")]
    return make_tables(spark, customers=[dict(customer_id="c1")], appointments=appts, reminders=rems, delays=dls)


def test_duplicate_keys(spark):
    rows = {r.table_name: r for r in quality.duplicate_keys(_bad_tables(spark)).collect()}
    a = rows["appointments"]
    assert (a.total_rows, a.distinct_keys, a.duplicated_keys, a.excess_rows) == (3, 2, 1, 1)
    assert rows["salons"].duplicated_keys == 0


def test_orphans(spark):
    rows = {(r.child_table, r.child_column): r for r in quality.orphans(_bad_tables(spark)).collect()}
    assert rows[("appointments", "salon_id")].orphan_rows == 1
    assert rows[("appointments", "customer_id")].orphan_rows == 1
    assert rows[("appointments", "rescheduled_from")].orphan_rows == 1
    assert rows[("reminder_events", "appointment_id")].orphan_keys == 1
    assert rows[("delay_events", "appointment_id")].orphan_rows == 0


def test_domain_violations(spark):
    t = _bad_tables(spark)
    rows = {(r.table_name, r.column_name, r.rule): r.violations for r in quality.domain_violations(t).collect()}
    assert rows[("appointments", "status", "domain")] == 1
    assert rows[("reminder_events", "reminder_type", "domain")] == 1
    assert rows[("reminder_events", "reminder_type", "max_length_20")] == 1
    assert rows[("appointments", "payment_status", "domain")] == 0
    detail = {(r.column_name, r.bad_value): r.n_rows for r in quality.domain_violation_values(t).collect()}
    assert detail[("status", "Attended")] == 1


def test_band_consistency(spark):
    rows = {(r.stored_band, r.expected_band): (r.n_events, r.consistent)
            for r in quality.band_consistency(_bad_tables(spark)).collect()}
    assert rows == {("minor", "moderate"): (1, False), ("on_schedule", "on_schedule"): (1, True)}


def test_apply_defaults(spark):
    df = spark.createDataFrame([("s1", None, None, None)],
                               "salon_id string, plan_tier string, prepay_discount decimal(5,2), is_active boolean")
    out = quality.apply_defaults(df, "salons").first()
    assert out.plan_tier == "standard" and str(out.prepay_discount) == "10.00" and out.is_active is True
    assert set(schemas.DEFAULTS["salons"]) >= {"plan_tier", "prepay_discount", "is_active"}
    assert df.select(F.col("salon_id")).first()[0] == "s1"
