"""Published versions: two nights of the refresh, crashes, conflicts, clean-up."""

import datetime as dt

import pytest

from fixture_tables import D, make_tables
from slotwise.operators import refresh
from slotwise.sources import publish

ONE, TWO = dt.date(2025, 7, 1), dt.date(2025, 7, 2)


def night(spark, bookings):
    customers = [dict(customer_id=c, total_bookings=n) for c, n in (("c1", 9), ("c2", 0), ("c3", 4))]
    appts = [dict(appointment_id=f"a{i}", customer_id=c, scheduled_at=D(2025, 7, 1, 9)) for i, c in enumerate(bookings)]
    return make_tables(spark, customers=customers, appointments=appts)


def counts(spark, root):
    return {r.customer_id: r.total_bookings for r in publish.read_current(spark, root, "customers").collect()}


def test_a_customer_without_bookings_keeps_last_nights_value(spark, tmp_path):
    root = str(tmp_path)
    first = refresh.publish_refresh(night(spark, ["c1", "c1", "c2"]), root, ONE)
    assert counts(spark, root) == {"c1": 2, "c2": 1, "c3": 4} and first["rows_updated"] == 2
    second = night(spark, ["c2", "c2", "c2"])
    for _ in range(2):                                         # the same night again gives the same rows
        refresh.publish_refresh(second, root, TWO)
        assert counts(spark, root) == {"c1": 2, "c2": 3, "c3": 4}
    assert [v.tag for v in publish.versions(spark, root, "customers")] == ["2025-07-01", "2025-07-02", "2025-07-02"]
    refresh.publish_refresh(second, root, dt.date(2025, 7, 3), corrected=True)
    assert counts(spark, root) == {"c1": 0, "c2": 3, "c3": 0}


def test_a_crash_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    refresh.publish_refresh(night(spark, ["c1"]), root, ONE)
    with monkeypatch.context() as broken:
        broken.setattr(publish, "switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh.publish_refresh(night(spark, ["c2"]), root, TWO)
    assert counts(spark, root) == {"c1": 1, "c2": 0, "c3": 4}
    refresh.publish_refresh(night(spark, ["c2"]), root, TWO)
    assert counts(spark, root) == {"c1": 1, "c2": 1, "c3": 4}


def test_two_publishers_of_one_number(spark, tmp_path):
    root, df = str(tmp_path), spark.range(3)
    publish.publish(df, root, "t", "1")
    seen = publish.current(spark, root, "t")
    path = publish.stage(spark.range(9), root, "t")
    publish.publish(spark.range(5), root, "t", "2")
    with pytest.raises(publish.PublishConflict):
        publish.switch(spark, root, "t", "2", path, df.schema, seen)
    assert publish.read_current(spark, root, "t").count() == 5
    assert publish.forget(spark, root, "t", keep=1) >= 1
    assert publish.read_current(spark, root, "t").count() == 5 and len(publish.versions(spark, root, "t")) == 1


def test_empty_versions_keep_their_schema(spark, tmp_path):
    publish.publish(spark.range(0), str(tmp_path), "t", "1")
    got = publish.read_current(spark, str(tmp_path), "t")
    assert got.count() == 0 and got.columns == ["id"]
    with pytest.raises(FileNotFoundError):
        publish.read_current(spark, str(tmp_path), "other")
