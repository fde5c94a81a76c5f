"""SP1 nightly refresh of customers.total_bookings (write path)."""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from slotwise.functions.dates import ts_lit
from slotwise.session import ensure_checkpoint_dir
from slotwise.sources import publish
from slotwise.sources.sinks import write_table
from slotwise.sources.tables import Tables

log = logging.getLogger(__name__)


def refresh_total_bookings(t: Tables, corrected: bool = False) -> DataFrame:
    """Customers with ``total_bookings`` set to their number of appointments.

    As written customers without any appointment keep their stored value (the update only
    touches matched rows); ``corrected=True`` resets them to 0.  Bookings are counted per
    customer with partial aggregation before the shuffle, then meet the customer table
    once, already partitioned by the key.
    """
    counts = t.appointments.groupBy("customer_id").agg(F.count(F.lit(1)).alias("booking_count"))
    fallback = F.lit(0) if corrected else F.col("total_bookings")
    return (t.customers.join(counts, "customer_id", "left")
            .select(*[F.coalesce(F.col("booking_count").cast("int"), fallback).alias("total_bookings")
                      if c == "total_bookings" else F.col(c) for c in t.customers.columns],
                    F.col("booking_count").isNotNull().alias("_matched")))


def run_refresh(t: Tables, path: str, corrected: bool = False) -> dict:
    """Write the refreshed customers table to ``path`` and report duration and rows updated.

    The row count is gathered with an ``Observation`` during the write itself (no second
    pass over the data).
    """
    start = time.monotonic()
    obs = Observation("refresh_total_bookings")
    df = refresh_total_bookings(t, corrected).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_matched"), 1)).alias("updated"))
    write_table(df.drop("_matched"), path)
    metrics = obs.get
    out = {"duration_ms": int((time.monotonic() - start) * 1000), "rows_written": metrics["rows"],
           "rows_updated": metrics["updated"], "path": path}
    log.info("Refresh complete. Duration: %dms. Rows updated: %d", out["duration_ms"], out["rows_updated"])
    return out


def refreshed_customers(t: Tables, corrected: bool = False) -> DataFrame:
    return refresh_total_bookings(t, corrected).drop("_matched")


def carried_over(t: Tables, last: DataFrame | None, corrected: bool = False) -> DataFrame:
    """Customers with the booking counts of this night; who has no booking keeps last night's published
    value (the stored one for who isn't in it), or 0 if ``corrected``."""
    if last is None:
        return refresh_total_bookings(t, corrected)
    stored = last.select("customer_id", F.col("total_bookings").alias("_last"))
    kept = t.customers.join(stored, "customer_id", "left").withColumn("total_bookings", F.coalesce("_last", "total_bookings"))
    return refresh_total_bookings(t.with_tables(customers=kept.select(*t.customers.columns)), corrected)


def publish_refresh(t: Tables, root: str, as_of: dt.date, corrected: bool = False, name: str = "customers") -> dict:
    """The nightly update of customers: counts of tonight over last night's published table, published
    as the next version under ``root``.

    Last night's is the newest version of an earlier ``as_of``, so a night run again gives the same rows
    again, as one more version.  Readers see the old version until the new one is complete.
    """
    start = time.monotonic()
    tag = as_of.isoformat()
    before = publish.current(t.spark, root, name, before=tag)
    obs = Observation("publish_refresh")
    rows = carried_over(t, publish.read(t.spark, before) if before else None, corrected).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_matched"), 1)).alias("updated"))
    version = publish.publish(rows.drop("_matched"), root, name, tag)
    out = {"duration_ms": int((time.monotonic() - start) * 1000), "rows_written": obs.get["rows"], "rows_updated": obs.get["updated"],
           "path": version.path, "version": version.number}
    log.info("Refresh published as version %d. Duration: %dms. Rows updated: %d", version.number, out["duration_ms"], out["rows_updated"])
    return out


def refresh_two_nights(t: Tables, first: dt.date, second: dt.date) -> DataFrame:
    """The customers table after two nights: the first counts the bookings scheduled before its date, the
    second, as if those had been archived, the later ones up to its date."""
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/published/{uuid.uuid4().hex}"
    early = t.appointments.where(F.col("scheduled_at") < ts_lit(first))
    late = t.appointments.where((F.col("scheduled_at") >= ts_lit(first)) & (F.col("scheduled_at") < ts_lit(second)))
    publish_refresh(t.with_tables(appointments=early), root, first)
    publish_refresh(t.with_tables(appointments=late), root, second)
    return publish.read_current(t.spark, root, "customers")
