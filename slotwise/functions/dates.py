"""Date helpers with the calendar semantics the metrics are defined in.

All helpers are built-in Column expressions (codegen'd, JVM side) and are independent
of ``spark.sql.session.timeZone``: facts are TIMESTAMP_NTZ and every difference is taken
between NTZ values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values ------------------------------------------------------------------------
# Fiscal weeks count Sunday-started weeks since 2025-01-01; 2024-12-29 is the Sunday that
# starts the week containing that day.
FISCAL_ANCHOR_SUNDAY = dt.date(2024, 12, 29)
EPOCH_NTZ = dt.datetime(1970, 1, 1)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(d: dt.date | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (constant folded; comparable with NTZ columns and pushed to the scan)."""
    if not isinstance(d, dt.datetime):
        d = dt.datetime(d.year, d.month, d.day)
    return F.lit(d.isoformat(sep=" ")).cast(T.TimestampNTZType())


def date_lit(d: dt.date) -> Column:
    return F.lit(d).cast(T.DateType())


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def weeks_before(as_of: dt.date, weeks: int) -> dt.date:
    return as_of - dt.timedelta(weeks=weeks)


def months_before(as_of: dt.date, months: int) -> dt.date:
    """Calendar month shift with month-end clamp (2025-08-31 minus 6 months = 2025-02-28)."""
    total = as_of.year * 12 + (as_of.month - 1) - months
    y, m = divmod(total, 12)
    m += 1
    last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m, min(as_of.day, last))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ timestamp (floor, so it is a second boundary)."""
    return F.timestamp_diff("SECOND", ts_lit(EPOCH_NTZ), col_(ts))


def boundary_diff(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:06:00 is 6 minutes (boundaries at :01 ... :06), not the 5 minutes of
    elapsed time that ``timestampdiff`` returns.  NULL in, NULL out.
    """
    size = {"second": 1, "minute": 60, "hour": 3600}[unit.lower()]
    a, b = epoch_seconds(start), epoch_seconds(end)
    if size == 1:
        return b - a
    return F.floor(b / F.lit(size)) - F.floor(a / F.lit(size))


def month_diff(start, end) -> Column:
    """Month boundaries crossed between two dates."""
    s, e = col_(start), col_(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def us_week(d) -> Column:
    """US week of year: week 1 contains 1 January, weeks start on Sunday (not ISO)."""
    d = col_(d)
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def fiscal_week(d) -> Column:
    """Sunday-bounded weeks since 2025-01-01, counting that week as 1."""
    return (F.floor(F.datediff(col_(d), date_lit(FISCAL_ANCHOR_SUNDAY)) / 7) + 1).cast("int")


def month_start(d) -> Column:
    return F.trunc(col_(d), "month")


# Time-partitioned layouts carry a month partition column next to the event time, named
# below; window filters also constrain that column so the scan skips whole directories.
PARTITION_COLUMNS = {"scheduled_at": "scheduled_month", "sent_at": "sent_month",
                     "triggered_at": "triggered_month"}
MONTH_FORMAT = "yyyy-MM"
# Event tables also carry the month their booking is scheduled in, as their first partition column.
BOOKING_MONTH = "appointment_month"


def month_key(d: dt.date | dt.datetime) -> str:
    return f"{d.year:04d}-{d.month:02d}"


def since(df, col: str, start: dt.date | dt.datetime):
    """``df`` rows with ``col >= start``; on a month-partitioned layout the same bound is also
    put on the partition column, which Spark evaluates as a partition filter.  The partition
    column must be the month of ``col`` (as ``sources.layout`` writes it); a DataFrame that
    rewrites ``col`` must drop or recompute it."""
    out = df.where(F.col(col) >= ts_lit(start))
    pcol = PARTITION_COLUMNS.get(col)
    if pcol and pcol in df.columns:
        out = out.where(F.col(pcol) >= F.lit(month_key(start)))
    return out


def booked_since(events, start: dt.date | dt.datetime):
    """Events that can belong to a booking scheduled on or after ``start``: on a layout with the booking's
    month a partition filter, else all.  A prune only: who joins bookings must bound them too."""
    if BOOKING_MONTH in events.columns:
        return events.where(F.col(BOOKING_MONTH) >= F.lit(month_key(start)))
    return events


def met_by(appointments, events):
    """The bookings that ``events`` (a window of them) can belong to: on layouts with months, those of the
    events' booking months only.

    The months are a few values a year, so they are broadcast, and the scan of the bookings is pruned
    by them at run time (dynamic partition pruning).  Bookings without a time share the month of
    events without one.  A prune only: the join on the booking's id still decides.
    """
    month = PARTITION_COLUMNS["scheduled_at"]
    if BOOKING_MONTH not in events.columns or month not in appointments.columns:
        return appointments
    none = F.lit("")
    months = events.groupBy(F.coalesce(F.col(BOOKING_MONTH), none).alias("_month")).agg(F.count(F.lit(1)).alias("_n"))
    return appointments.join(F.broadcast(months), F.coalesce(F.col(month), none) == F.col("_month")).drop("_month", "_n")


def within(df, col: str, start: dt.date, end_exclusive: dt.date):
    """``df`` rows with ``start <= col < end_exclusive`` (partition-pruned like ``since``)."""
    out = since(df, col, start).where(F.col(col) < ts_lit(end_exclusive))
    pcol = PARTITION_COLUMNS.get(col)
    if pcol and pcol in df.columns:
        last = end_exclusive - dt.timedelta(days=1)
        out = out.where(F.col(pcol) <= F.lit(month_key(last)))
    return out
