"""The input tables of every metric, bundled with the calendar they are bucketed by."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.sources import schemas
from slotwise.sources.calendar import DEFAULT_END, DEFAULT_START, build_calendar

# --- fixed values: calendar range covering the driver test data (orders 1995..2001) ------
FIXTURE_CAL_START = dt.date(1995, 1, 1)
FIXTURE_CAL_END = dt.date(2001, 12, 31)

ENUM_COLUMNS = {
    "salons": ["plan_tier"],
    "appointments": ["status", "payment_status"],
    "reminder_events": ["reminder_type", "delivery_status", "customer_action"],
    "delay_events": ["delay_band", "customer_action"],
}


@dataclass(frozen=True)
class Tables:
    salons: DataFrame
    customers: DataFrame
    appointments: DataFrame
    reminder_events: DataFrame
    delay_events: DataFrame
    calendar: DataFrame
    cal_start: dt.date = DEFAULT_START
    cal_end: dt.date = DEFAULT_END
    root: str | None = None        # folder of the parquet tables, when read from files

    @property
    def spark(self) -> SparkSession:
        return self.appointments.sparkSession

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str,
                     cal_start: dt.date = FIXTURE_CAL_START,
                     cal_end: dt.date = FIXTURE_CAL_END, materialize: bool = True) -> "Tables":
        """Tables derived from the driver's parquet files (see ``sources.adapter``).

        ``materialize`` writes the derived tables once to the shared checkpoint folder and
        reads them back (lineage cut, real size statistics for the optimizer); otherwise
        the derivation stays inline in every plan.
        """
        from slotwise.sources.adapter import load_fixture, materialize_fixture

        if materialize:
            root = materialize_fixture(spark, sf_dir)
            return cls.from_parquet(spark, root, cal_start, cal_end, normalize=False)
        t = load_fixture(spark, sf_dir)
        return cls(calendar=build_calendar(spark, cal_start, cal_end),
                   cal_start=cal_start, cal_end=cal_end, **t)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str,
                     cal_start: dt.date = DEFAULT_START, cal_end: dt.date = DEFAULT_END,
                     normalize: bool = True) -> "Tables":
        """Domain tables stored as ``{root}/{table}`` parquet, read with explicit schemas.

        ``normalize`` lower-cases and trims enum columns: the source system compares them
        case- and trailing-blank-insensitively, Spark compares bytes.
        """
        dfs = {}
        for name in ("salons", "customers", "appointments", "reminder_events", "delay_events"):
            df = spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{root}/{name}")
            if normalize:
                for c in ENUM_COLUMNS.get(name, []):
                    df = df.withColumn(c, F.lower(F.rtrim(F.col(c))))
            dfs[name] = df
        return cls(calendar=build_calendar(spark, cal_start, cal_end),
                   cal_start=cal_start, cal_end=cal_end, root=root, **dfs)

    def with_tables(self, **kw) -> "Tables":
        return replace(self, **kw)

    def with_calendar(self, start: dt.date, end: dt.date) -> "Tables":
        return replace(self, calendar=build_calendar(self.spark, start, end), cal_start=start, cal_end=end)

    def cal(self) -> DataFrame:
        """The calendar behind a broadcast hint; its size is bounded by ``build_calendar``."""
        return F.broadcast(self.calendar)
