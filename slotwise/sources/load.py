"""The checked load: raw rows become table rows or quarantine rows, in one pass.

Enum values are compared without case and trailing blanks by the source system, so they are stored
in lower case without them; later filters on them are plain comparisons that reach the parquet
scan.  NULLs of columns with a declared default get it.  What then still breaks a rule (NOT NULL, enum
domain, declared length) goes to the quarantine with the names of all rules it breaks, unchanged.
Both kinds are written by the same job into one published version, in two folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.quality import apply_defaults, rules
from slotwise.sources import publish, schemas
from slotwise.sources.calendar import build_calendar
from slotwise.sources.tables import ENUM_COLUMNS, Tables

LOADED = ("salons", "customers", "appointments", "reminder_events", "delay_events")
BROKEN, RAW, KEPT = "_broken", "_raw", "_quarantined"


@dataclass(frozen=True)
class Loaded:
    version: publish.Version
    rows: int
    quarantined: int
    normalised: int
    defaulted: int


def _normalised(raw: DataFrame, name: str) -> DataFrame:
    return raw.withColumns({c: F.lower(F.rtrim(F.col(c))) for c in ENUM_COLUMNS.get(name, [])})


def _changed(name: str) -> tuple[Column, Column]:
    """Whether a raw row has an enum value to be normalised, and a NULL that a default fills."""
    no = F.lit(False)
    enums, defaults = ENUM_COLUMNS.get(name, []), schemas.DEFAULTS.get(name, {})
    a = [F.coalesce(F.col(c) != F.lower(F.rtrim(F.col(c))), no) for c in enums]
    b = [F.col(c).isNull() for c in defaults]
    return (F.greatest(no, no, *a), F.greatest(no, no, *b))


def checked(raw: DataFrame, name: str) -> DataFrame:
    """Columns of the table as it is stored, the rules a row breaks (``_broken``, empty if none) and, if it
    breaks one, the row as it came (``_raw``, a map of strings).

    Columns the raw rows lack are NULL (or the default); columns the table doesn't know go.
    """
    fields = schemas.SCHEMAS[name].fields
    rows = raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    came = F.create_map(*[x for f in fields for x in (F.lit(f.name), F.col(f.name).cast("string"))])
    normal, filled = _changed(name)
    rows = rows.withColumns({"_normalised": normal, "_defaulted": filled, RAW: came})
    rows = apply_defaults(_normalised(rows, name), name)
    broken = F.filter(F.array(*[F.when(F.expr(wrong), f"{column}: {rule}") for column, rule, wrong in rules(name)]), lambda x: x.isNotNull())
    rows = rows.withColumn(BROKEN, broken)
    return rows.withColumn(RAW, F.when(F.size(BROKEN) > 0, F.col(RAW)))


def load(raw: DataFrame, name: str, root: str, tag: str) -> Loaded:
    """Publish the checked rows of a table: one scan of ``raw``, one write, counts gathered by it."""
    spark = raw.sparkSession
    obs = Observation(f"load-{name}")
    rows = checked(raw, name)
    bad = F.size(BROKEN) > 0
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("quarantined"),
                        F.count(F.when(F.col("_normalised") & ~bad, 1)).alias("normalised"), F.count(F.when(F.col("_defaulted") & ~bad, 1)).alias("defaulted"))
    out = rows.drop("_normalised", "_defaulted").withColumn(KEPT, bad)
    after = publish.current(spark, root, name)
    path = publish.stage(out, root, name, partition_by=[KEPT])
    version = publish.switch(spark, root, name, tag, path, out.schema, after)
    n = obs.get
    return Loaded(version, n["rows"] - n["quarantined"], n["quarantined"], n["normalised"], n["defaulted"])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of the current version that passed; a partition filter leaves the quarantine unread."""
    rows = publish.read_current(spark, root, name).where(~F.col(KEPT))
    return rows.select(*[f.name for f in schemas.SCHEMAS[name].fields])


def quarantine(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(raw, broken): the rows of the current version that didn't pass."""
    return publish.read_current(spark, root, name).where(F.col(KEPT)).select(F.col(RAW).alias("raw"), F.col(BROKEN).alias("broken"))


def loaded_tables(spark: SparkSession, root: str, cal_start: dt.date, cal_end: dt.date) -> Tables:
    """Tables over the current versions.  Enum columns are stored normalised: nothing wraps them."""
    return Tables(calendar=build_calendar(spark, cal_start, cal_end), cal_start=cal_start, cal_end=cal_end, **{n: table(spark, root, n) for n in LOADED})


# --- a load of dirty rows, for checking ---------------------------------------------------------

def dirty_appointments(appointments: DataFrame) -> DataFrame:
    """Bookings as a careless source would send them: what is wrong follows from the day of creation."""
    day = F.dayofmonth("created_at")
    return appointments.select([f.name for f in schemas.SCHEMAS["appointments"].fields]).withColumns({
        "payment_status": F.when(day == 1, None).when(day == 2, F.concat(F.upper("payment_status"), F.lit("  "))).otherwise(F.col("payment_status")),
        "status": F.when(day == 2, F.initcap("status")).when(day == 3, "lost").otherwise(F.col("status")),
        "discount_pct": F.when(day == 4, None).otherwise(F.col("discount_pct")),
        "is_priority": F.when(day == 5, None).otherwise(F.col("is_priority")),
        "customer_id": F.when(day.isin(3, 6), None).otherwise(F.col("customer_id")),
        "service_name": F.when(day == 7, F.lpad("service_name", 256, "x")).otherwise(F.col("service_name")),
    })


def load_report(t: Tables) -> DataFrame:
    """What a load of dirty bookings stores and holds back: rows per status, payment status, priority and
    discount, and quarantined rows per broken rule."""
    import uuid

    from slotwise.session import ensure_checkpoint_dir

    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/loads/{uuid.uuid4().hex}"
    load(dirty_appointments(t.appointments), "appointments", root, "1")
    kept = table(t.spark, root, "appointments").groupBy("status", "payment_status", "is_priority").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("discount_pct").cast("decimal(20,2)").alias("discounts"))
    held = quarantine(t.spark, root, "appointments").select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))
    return kept.select(F.lit("stored").alias("part"), F.concat_ws("/", "status", "payment_status", F.col("is_priority").cast("string")).alias("what"), "n_rows", "discounts").unionByName(
        held.select(F.lit("quarantine").alias("part"), F.col("rule").alias("what"), "n_rows", F.lit(None).cast("decimal(20,2)").alias("discounts")))
