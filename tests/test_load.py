"""The checked load and the catalog's tables."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from fixture_tables import D, make_tables
from slotwise.operators import weekly
from slotwise.sources import catalog, load, schemas


def raw(spark):
    fields = "appointment_id string, salon_id string, customer_id string, scheduled_at timestamp_ntz, created_at timestamp_ntz, status string, payment_status string, is_priority boolean, extra int"
    at = D(2025, 7, 1, 9)
    rows = [("a1", "s", "c", at, at, "Attended ", None, None, 1), ("a2", "s", "c", at, at, "no_show", "SUCCESSFUL", True, 1),
            ("a3", "s", None, at, at, "lost", "paid", True, 1), ("x" * 37, "s", "c", at, None, None, "failed", False, 1)]
    return spark.createDataFrame(rows, fields)


def test_rows_are_stored_or_held_back(spark, tmp_path):
    root = str(tmp_path)
    out = load.load(raw(spark), "appointments", root, "1")
    assert (out.rows, out.quarantined, out.normalised, out.defaulted) == (2, 2, 2, 2)
    got = {r.appointment_id: (r.status, r.payment_status, r.is_priority, float(r.discount_pct)) for r in load.table(spark, root, "appointments").collect()}
    assert got == {"a1": ("attended", "not_applicable", False, 0.0), "a2": ("no_show", "successful", True, 0.0)}
    held = {r.raw["appointment_id"]: (r.raw["status"], sorted(r.broken)) for r in load.quarantine(spark, root, "appointments").collect()}
    assert held["a3"] == ("lost", ["customer_id: not_null", "payment_status: domain", "status: domain"])
    assert held["x" * 37] == (None, ["appointment_id: max_length_36", "created_at: not_null", "status: not_null"])
    load.load(raw(spark).limit(0), "appointments", root, "2")
    assert load.table(spark, root, "appointments").count() == 0 == load.quarantine(spark, root, "appointments").count()


def test_enum_filters_and_months_reach_the_scan(spark, tmp_path):
    root = str(tmp_path)
    t = make_tables(spark, appointments=[dict(appointment_id="a", scheduled_at=D(2025, 7, 1, 9), status="attended")], salons=[{"salon_id": "s1"}])
    for name in load.LOADED:
        load.load(getattr(t, name), name, root, "1")
    loaded = load.loaded_tables(spark, root, dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        loaded.appointments.where(F.col("status") == "attended").explain("formatted")
    assert "EqualTo(status,attended)" in text.getvalue() and "PartitionFilters: [isnotnull(_quarantined" in text.getvalue()
    as_of = dt.date(2025, 7, 9)
    assert sorted(map(tuple, weekly.weekly_noshow(loaded, as_of).collect())) == sorted(map(tuple, weekly.weekly_noshow(t, as_of).collect()))


def test_tables_are_created_once_and_drift_is_refused(spark, tmp_path):
    database, root = "slotwise_ddl_test", str(tmp_path)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    try:
        assert sorted(catalog.ensure_tables(spark, database, root)) == sorted(schemas.SCHEMAS)
        spark.sql(f"INSERT INTO {database}.customers VALUES ('c', 's', 'h', DATE'2025-01-01', 3, TIMESTAMP_NTZ'2025-01-01 00:00:00')")
        assert catalog.ensure_tables(spark, database, root) == []
        assert spark.table(f"{database}.customers").count() == 1
        assert catalog.partition_columns("delay_events") == ["appointment_month", "triggered_month"]
        spark.sql(f"DROP TABLE {database}.salons")
        spark.sql(f"ALTER TABLE {database}.customers ADD COLUMNS (note string)")
        with pytest.raises(catalog.SchemaDrift, match="customers: note isn't declared"):
            catalog.ensure_tables(spark, database, root)
        assert not spark.catalog.tableExists(f"{database}.salons")                       # nothing was created
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
