"""Co-located storage layout: the fact tables bucketed by ``appointment_id``.

Nearly every event metric groups events per appointment and joins them to appointments.
When ``appointments``, ``reminder_events`` and ``delay_events`` are stored as catalog tables
bucketed on ``appointment_id`` into the same number of buckets, those aggregations and
sort-merge joins read pre-partitioned data: Spark plans them without any exchange, so the
largest shuffles of a 100 TB run disappear (see ``tests/test_layout.py``).  Each bucket is
written by one task (``repartition`` on the key first), so the layout has ``buckets`` files
per table, sorted by the key.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from slotwise.sources.calendar import DEFAULT_END, DEFAULT_START, build_calendar

BUCKETED = {"appointments": "appointment_id", "reminder_events": "appointment_id",
            "delay_events": "appointment_id", "customers": "customer_id"}
PLAIN = ("salons",)


def write_bucketed(t, database: str, root: str, buckets: int) -> list[str]:
    """Save the tables of ``t`` as external catalog tables under ``root``."""
    spark = t.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    names = []
    for name, key in BUCKETED.items():
        df = getattr(t, name).repartition(buckets, key)
        (df.write.mode("overwrite").option("path", f"{root}/{name}")
           .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}"))
        names.append(name)
    for name in PLAIN:
        getattr(t, name).write.mode("overwrite").option("path", f"{root}/{name}").saveAsTable(f"{database}.{name}")
        names.append(name)
    return names


def tables_from_catalog(spark: SparkSession, database: str, cal_start=DEFAULT_START, cal_end=DEFAULT_END):
    from slotwise.sources.tables import Tables

    tb = {n: spark.table(f"{database}.{n}") for n in (*BUCKETED, *PLAIN)}
    return Tables(calendar=build_calendar(spark, cal_start, cal_end), cal_start=cal_start, cal_end=cal_end, **tb)


# --- month-partitioned layout -----------------------------------------------------------
TIME_COLUMNS = {"appointments": "scheduled_at", "reminder_events": "sent_at", "delay_events": "triggered_at"}


def with_booking_month(events, appointments):
    """Events with the month their booking is scheduled in (null: no such booking).

    Bookings come as (id, month) only and are read once per id; AQE splits a booking that many
    events belong to.
    """
    from pyspark.sql import functions as F

    from slotwise.functions.dates import BOOKING_MONTH, MONTH_FORMAT

    months = appointments.groupBy("appointment_id").agg(F.date_format(F.max("scheduled_at"), MONTH_FORMAT).alias(BOOKING_MONTH))
    return events.drop(BOOKING_MONTH).join(months, "appointment_id", "left").select(*[c for c in events.columns if c != BOOKING_MONTH], BOOKING_MONTH)


def restamp(events, moved):
    """Events after some bookings were moved: ``moved`` holds their (appointment_id, scheduled_at).  The
    events of other bookings keep their month."""
    from pyspark.sql import functions as F

    from slotwise.functions.dates import BOOKING_MONTH, MONTH_FORMAT

    months = moved.groupBy("appointment_id").agg(F.date_format(F.max("scheduled_at"), MONTH_FORMAT).alias("_month"))
    return (events.join(months, "appointment_id", "left").withColumn(BOOKING_MONTH, F.coalesce("_month", BOOKING_MONTH))
            .select(*events.columns))


def move_bookings(spark, root: str, name: str, moved) -> list[str]:
    """Bring a stored event table up to date with moved bookings: only the months that moved events leave
    or enter are read and written.  Returns those months.

    The months' new rows are written beside the table first, then take the place of theirs; a job
    that dies in between is run again with the same ``moved`` (a month that was replaced already
    gives the same rows once more).
    """
    import uuid

    from pyspark.sql import functions as F

    from slotwise.functions.dates import BOOKING_MONTH, MONTH_FORMAT, PARTITION_COLUMNS
    from slotwise.session import ensure_checkpoint_dir
    from slotwise.sources import publish, schemas

    path = f"{root}/{name}"
    pcol = PARTITION_COLUMNS[TIME_COLUMNS[name]]
    events = spark.read.schema(_with_text(schemas.SCHEMAS[name], BOOKING_MONTH, pcol)).parquet(path)
    goes = moved.select("appointment_id", F.date_format("scheduled_at", MONTH_FORMAT).alias("_to")).join(
        events.select("appointment_id", BOOKING_MONTH), "appointment_id").where(~F.col(BOOKING_MONTH).eqNullSafe(F.col("_to")))
    # a few values a booking month, however many bookings moved
    months = sorted({m for r in goes.select(BOOKING_MONTH, "_to").distinct().collect() for m in r if m is not None})
    lost = goes.where(F.col(BOOKING_MONTH).isNull()).limit(1).count() > 0
    if not months:
        return []
    touched = F.col(BOOKING_MONTH).isin(months) | (F.col(BOOKING_MONTH).isNull() if lost else F.lit(False))
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/moved/{uuid.uuid4().hex}"
    rows, columns = time_partitioned(restamp(events.where(touched), moved), name)
    rows.write.partitionBy(*columns).parquet(stage)
    fs, folder = publish._hadoop(spark, path)
    for month in [*months, *(["__HIVE_DEFAULT_PARTITION__"] if lost else [])]:
        _, new = publish._hadoop(spark, f"{stage}/{BOOKING_MONTH}={month}")
        _, old = publish._hadoop(spark, f"{path}/{BOOKING_MONTH}={month}")
        fs.delete(old, True)
        if fs.exists(new):
            fs.rename(new, old)
    return months


def _with_text(schema, *names: str):
    from pyspark.sql import types as T

    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in names]])


def time_partitioned(df, name: str, partitions: int | None = None, dealt: bool = False):
    """``df`` with its month partition column, range-partitioned on the event time and sorted.

    Range partitioning (sampled boundaries) rather than hashing on the month keeps the write
    balanced when one month holds a large share of the rows; each task then writes files for
    the one or two months its time range covers, sorted so row-group statistics are tight.
    Events with their booking's month are partitioned by it first.  ``dealt``: the rows are already.
    Returns (DataFrame, partition columns).
    """
    from pyspark.sql import functions as F

    from slotwise.functions.dates import BOOKING_MONTH, MONTH_FORMAT, PARTITION_COLUMNS
    from slotwise.sources.schemas import PRIMARY_KEYS

    col = TIME_COLUMNS[name]
    pcol = PARTITION_COLUMNS[col]
    out = df.withColumn(pcol, F.date_format(F.col(col), MONTH_FORMAT))
    first = [BOOKING_MONTH] if BOOKING_MONTH in df.columns else []
    # the key parts rows of equal (or no) time: they never meet in one task
    by = [*first, F.col(col), F.col(PRIMARY_KEYS[name])]
    if not dealt:
        out = out.repartitionByRange(partitions, *by) if partitions else out.repartitionByRange(*by)
    return out.sortWithinPartitions(*first, col), [*first, pcol]


def write_time_partitioned(t, root: str) -> list[str]:
    """Write the three fact tables month-partitioned (and the dimensions plain) under ``root``."""
    from slotwise.sources.sinks import write_table

    for name in TIME_COLUMNS:
        df = getattr(t, name)
        df, columns = time_partitioned(df if name == "appointments" else with_booking_month(df, t.appointments), name)
        write_table(df, f"{root}/{name}", partition_by=columns)
    for name in ("salons", "customers"):
        write_table(getattr(t, name), f"{root}/{name}")
    return [*TIME_COLUMNS, "salons", "customers"]
