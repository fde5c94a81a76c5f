"""Metrics kept up to date from new rows only: all days, late rows included.

Each metric is one Structured Streaming query over the tables' folders (``availableNow``: a run takes
the files added since the last one).  No watermark is set, so nothing is ever too late: a row for an
old day changes that day.  What must be remembered lies in tables below the state folder, one
folder per micro-batch; a batch that is run again after a failure writes its folder again, so its
rows count once.

* ``DeliveryDays`` (M5): counts per day in the state store (one row a day), changed days
  upserted into a published table.
* ``ActiveCustomers`` (V3): one row per day, customer, salon and appointment that was active; acted
  reminders find their appointment among all appointments so far, those whose appointment is
  still to come wait for it.
* ``ActivityBitmaps`` (V3, D4): the same activity as exact bitmaps per day, over numbers that each
  customer, salon and appointment gets once; days and weeks merge by OR, no id is read again.
* ``AppointmentSummary`` (V4, V8, V11, M4, M8): one row per appointment over all its events, merged
  with the aggregate of the new ones.
* ``MergePairs`` (V12): new reminders meet all stored seconds of delay events, and new delay events
  all stored reminders, of the days around them only; the pairs of a batch are appended.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from slotwise.functions.dates import MONTH_FORMAT, epoch_seconds, month_key, ts_lit, weeks_before
from slotwise.operators import activity, adoption, dashboard, delays, funnel, product
from slotwise.operators.activity import ACTIVE_STATUSES
from slotwise.operators.delays import band_rank
from slotwise.operators.merge import MERGE_REMINDER_TYPES, delay_seconds, meeting, weekly_compliance
from slotwise.operators.product import DELIVERY_ALERT_PCT, FAILURE_ALERT_PCT
from slotwise.session import ensure_checkpoint_dir
from slotwise.sources import publish, schemas

DAY_SECONDS = 86_400


def state_folder(t, name: str) -> str:
    """The metric's state for these tables: the same folder at every run, so a run goes on from the last."""
    if not t.root:
        raise ValueError("incremental refresh needs tables stored as parquet folders (Tables.root)")
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/deltas/{name}-{hashlib.sha1(t.root.encode()).hexdigest()[:16]}"


@dataclass(frozen=True)
class Delta:
    """A metric's stream over the tables below ``root`` with its state below ``state``."""
    spark: SparkSession
    root: str
    state: str
    state_partitions: int | None = None

    def _session(self) -> SparkSession:
        """A session of its own: the partitions of a stream's state are fixed by a setting when its
        checkpoint is made, and the caller's setting stays as it is."""
        session = self.spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", str(self.state_partitions or self.spark.sparkContext.defaultParallelism))
        session.conf.set("spark.sql.session.timeZone", "UTC")
        return session

    def _stream(self, session: SparkSession, table: str) -> DataFrame:
        return session.readStream.schema(schemas.SCHEMAS[table]).parquet(f"{self.root}/{table}")

    def _run(self, rows: DataFrame, mode: str) -> None:
        query = (rows.writeStream.outputMode(mode).option("checkpointLocation", f"{self.state}/_checkpoint")
                 .trigger(availableNow=True).foreachBatch(self._apply).start())
        query.awaitTermination()

    def _write(self, rows: DataFrame, table: str, batch: int, day: Column | None = None) -> None:
        """A batch's rows of a state table, in place of what an earlier try of the batch wrote; with ``day`` in
        folders by month, dealt to tasks by ranges of days, so each writes few months however large one is."""
        if day is not None:
            rows = rows.withColumn("month", F.date_format(day, MONTH_FORMAT)).repartitionByRange("month", day)
        writer = rows.write.mode("overwrite")
        (writer.partitionBy("month") if day is not None else writer).parquet(f"{self.state}/{table}/batch={batch}")

    def _read(self, spark: SparkSession, table: str, schema: str, below: int | None = None, since: int = 0) -> DataFrame:
        """A state table's rows, of the batches from ``since`` and below a number; empty before the first batch."""
        fields = T.StructType.fromDDL(f"{schema}, batch long")
        fs, path = publish._hadoop(spark, f"{self.state}/{table}")
        if not fs.exists(path):
            return spark.createDataFrame([], fields).drop("batch")
        rows = spark.read.schema(fields).option("basePath", f"{self.state}/{table}").parquet(f"{self.state}/{table}")
        rows = rows.where(F.col("batch") >= since)
        return (rows if below is None else rows.where(F.col("batch") < below)).drop("batch")

    def _apply(self, batch: DataFrame, number: int) -> None:
        raise NotImplementedError


def _tag(batch: int) -> str:
    return f"{batch:012d}"


class DeliveryDays(Delta):
    def refresh(self) -> None:
        rem = self._stream(self._session(), "reminder_events").where(F.col("sent_at").isNotNull())
        days = rem.groupBy(F.col("sent_at").cast("date").alias("sent_date")).agg(
            F.count(F.lit(1)).alias("reminders"),
            F.count(F.when(F.col("delivery_status") == "failed", 1)).alias("failed"),
            F.count(F.when(F.col("delivery_status") == "sent", 1)).alias("delivered"))
        self._run(days, "update")

    def _apply(self, batch: DataFrame, number: int) -> None:
        """Changed days replace theirs in the version of the batch before, so a batch run again gives the
        same days again; it is always read whole, which the state store needs to go on."""
        spark = batch.sparkSession
        before = publish.current(spark, self.state, "days", before=_tag(number))
        changed = batch.persist()
        rows = changed
        if before:
            same = publish.read(spark, before).join(F.broadcast(changed.select("sent_date")), "sent_date", "left_anti")   # a row a day
            rows = same.unionByName(changed)
        publish.publish(rows, self.state, "days", _tag(number))
        changed.unpersist()
        publish.forget(spark, self.state, "days", keep=3)

    def days(self) -> DataFrame:
        """Every day with reminders: counts and the two alerts, tested on the counts."""
        return publish.read_current(self.spark, self.state, "days").select(
            "sent_date", "reminders", "failed", "delivered",
            (F.col("failed") * 100 > F.col("reminders") * FAILURE_ALERT_PCT).alias("failure_alert"),
            (F.col("delivered") * 100 < F.col("reminders") * DELIVERY_ALERT_PCT).alias("delivery_alert"))


class ActiveCustomers(Delta):
    KNOWN = "appointment_id string, customer_id string, salon_id string"
    ACTIVE = "activity_date date, customer_id string, salon_id string, appointment_id string"

    def refresh(self) -> None:
        session = self._session()
        booked = self._stream(session, "appointments").select(
            "appointment_id", "customer_id", "salon_id", F.col("scheduled_at").cast("date").alias("activity_date"),
            F.col("status").isin(ACTIVE_STATUSES).alias("active"), F.lit(True).alias("booking"))
        acted = (self._stream(session, "reminder_events").where(F.col("customer_action").isNotNull() & F.col("sent_at").isNotNull())
                 .select("appointment_id", *[F.lit(None).cast("string").alias(c) for c in ("customer_id", "salon_id")],
                         F.col("sent_at").cast("date").alias("activity_date"), F.lit(True).alias("active"), F.lit(False).alias("booking")))
        self._run(booked.unionByName(acted), "append")

    def _apply(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        bookings = batch.where("booking")
        self._write(bookings.select("appointment_id", "customer_id", "salon_id").distinct(), "known", number)
        known = self._read(spark, "known", self.KNOWN, number + 1)
        waiting = publish.current(spark, self.state, "waiting", before=_tag(number))
        acts = batch.where("NOT booking").select("appointment_id", "activity_date").distinct()
        if waiting:
            acts = acts.unionByName(publish.read(spark, waiting))
        columns = ["activity_date", "customer_id", "salon_id", "appointment_id"]
        met = acts.join(known.withColumn("met", F.lit(True)), "appointment_id", "left").persist()         # once for both outcomes
        active = bookings.where("active").select(*columns).unionByName(met.where("met").select(*columns))
        self._write(active.distinct(), "active", number, F.col("activity_date"))
        publish.publish(met.where("met IS NULL").select(*acts.columns), self.state, "waiting", _tag(number))
        publish.forget(spark, self.state, "waiting", keep=3)
        met.unpersist()
        batch.unpersist()

    def daily(self) -> DataFrame:
        """Every day with activity: distinct customers, salons and appointments."""
        rows = self._read(self.spark, "active", self.ACTIVE)
        return rows.groupBy("activity_date").agg(
            F.count_distinct("customer_id").alias("dau"), F.count_distinct("salon_id").alias("active_salons"),
            F.count_distinct("appointment_id").alias("active_appointments"))


class ActivityBitmaps(ActiveCustomers):
    """A batch gives its new ids the next numbers and adds one bitmap row per (day, kind, stretch of 32,768
    numbers); figures are bit counts of the ORed rows, so a late batch changes old days exactly."""
    KINDS = ("customer_id", "salon_id", "appointment_id")
    NUMBERS = "kind string, id string, n long"
    BITS = "activity_date date, kind string, bucket long, bits binary"
    GROUPS = 256

    def _apply(self, batch: DataFrame, number: int) -> None:
        super()._apply(batch, number)
        spark = batch.sparkSession
        rows = self._read(spark, "active", self.ACTIVE, number + 1, number).select("activity_date", F.inline(F.array(
            *[F.struct(F.lit(k).alias("kind"), F.col(k).alias("id")) for k in self.KINDS]))).where(F.col("id").isNotNull()).distinct()
        known = self._read(spark, "numbers", self.NUMBERS, number)
        new = rows.select("kind", "id").distinct().join(known, ["kind", "id"], "left_anti").withColumn("g", F.pmod(F.xxhash64("id"), F.lit(self.GROUPS)))
        new = new.persist()
        # new ids are ranked inside hash groups, whose sizes (a few rows a kind) give each its first number
        sizes = new.groupBy("kind", "g").agg(F.count(F.lit(1)).alias("size"))
        before = F.coalesce(F.sum("size").over(Window.partitionBy("kind").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        firsts = sizes.select("kind", "g", before.alias("before"))
        used = known.groupBy("kind").agg((F.max("n") + 1).alias("used"))
        rank = F.row_number().over(Window.partitionBy("kind", "g").orderBy("id")) - 1
        numbered = (new.withColumn("r", rank).join(F.broadcast(firsts), ["kind", "g"]).join(F.broadcast(used), "kind", "left")
                    .select("kind", "id", (F.coalesce("used", F.lit(0)) + F.col("before") + F.col("r")).alias("n")))
        self._write(numbered, "numbers", number)
        new.unpersist()
        placed = rows.join(self._read(spark, "numbers", self.NUMBERS, number + 1), ["kind", "id"])
        bits = placed.groupBy("activity_date", "kind", F.bitmap_bucket_number("n").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
        self._write(bits, "bits", number, F.col("activity_date"))

    def distinct(self, *by: Column) -> DataFrame:
        """Distinct customers, salons and appointments per ``by`` (expressions over activity_date)."""
        merged = self._read(self.spark, "bits", self.BITS).groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        names = [c for c in merged.columns if c not in ("kind", "bucket", "bits")]
        counted = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits"))), F.lit(0)).alias(a)
                   for k, a in zip(self.KINDS, ("dau", "active_salons", "active_appointments"), strict=True)]
        return merged.groupBy(*names).agg(*counted)

    def daily(self) -> DataFrame:
        return self.distinct(F.col("activity_date"))


class MergePairs(Delta):
    REMINDERS = "event_id string, appointment_id string, delivery_status string, sent_at timestamp_ntz, rs long, day date, month string"
    SECONDS = "appointment_id string, ds long, n long, day date, month string"
    PAIRS = "event_id string, delivery_status string, sent_at timestamp_ntz, n_pairs long"

    def refresh(self) -> None:
        session = self._session()
        rem = (self._stream(session, "reminder_events").where(F.col("reminder_type").isin(MERGE_REMINDER_TYPES) & F.col("sent_at").isNotNull())
               .select("event_id", "appointment_id", "delivery_status", F.col("sent_at").alias("at"), F.lit("reminder").alias("kind")))
        dl = self._stream(session, "delay_events").select(
            "event_id", "appointment_id", F.lit(None).cast("string").alias("delivery_status"), F.col("triggered_at").alias("at"), F.lit("delay").alias("kind"))
        self._run(rem.unionByName(dl), "append")

    @staticmethod
    def _around(rows: DataFrame, of: DataFrame) -> DataFrame:
        """The rows of the days of ``of`` and those beside them: one value a day, however many rows; their
        months prune folders."""
        days = {r["day"] for r in of.select("day").distinct().collect()}
        days = sorted({d + dt.timedelta(days=k) for d in days for k in (-1, 0, 1)})
        return rows.where(F.col("month").isin(sorted({month_key(d) for d in days})) & F.col("day").isin(days)).drop("day", "month")

    def _apply(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        rem = batch.where("kind = 'reminder'").select("event_id", "appointment_id", "delivery_status", F.col("at").alias("sent_at"),
                                                      epoch_seconds("at").alias("rs"))
        rem = rem.withColumn("day", F.col("sent_at").cast("date")).persist()
        seconds = delay_seconds(batch.where("kind = 'delay'").select("appointment_id", F.col("at").alias("triggered_at")))
        seconds = seconds.withColumn("day", F.date_from_unix_date(F.floor(F.col("ds") / DAY_SECONDS).cast("int"))).persist()
        self._write(rem, "reminders", number, F.col("day"))
        self._write(seconds, "seconds", number, F.col("day"))
        # each pair meets once: in the batch of its later side
        all_seconds = self._around(self._read(spark, "seconds", self.SECONDS, number + 1), rem)
        old_reminders = self._around(self._read(spark, "reminders", self.REMINDERS, number), seconds)
        pairs = meeting(rem.drop("day"), all_seconds).unionByName(meeting(old_reminders, seconds.drop("day")))
        self._write(pairs.groupBy("event_id", "delivery_status", "sent_at").agg(F.sum("n").alias("n_pairs")), "pairs", number)
        for rows in (seconds, rem, batch):
            rows.unpersist()

    def pairs(self) -> DataFrame:
        """(event_id, delivery_status, sent_at, n_pairs): per reminder and batch, the delay events that meet it."""
        return self._read(self.spark, "pairs", self.PAIRS)


class AppointmentSummary(Delta):
    """One mergeable row per appointment over its reminder and delay events.

    A batch adds the aggregate of its new events; counts add up, flags and worst values take the largest,
    the last delay is the largest (time, event, minutes).  After ``compact_after`` batches the rows
    are merged into a published version, dealt by hash of the appointment, so reading costs one merge
    of that and the few batches since, however long the event history.
    """
    ROW = ("appointment_id string, r_n long, r_engaged long, r_asked long, r_sent int, d_n long, d_max int, d_rank int, d_offered long, "
           "d_rescheduled long, d_last struct<at:timestamp_ntz,event_id:string,minutes:int>")
    SUMS = ("r_n", "r_engaged", "r_asked", "d_n", "d_offered", "d_rescheduled")
    LARGEST = ("r_sent", "d_max", "d_rank", "d_last")
    compact_after = 16

    def refresh(self) -> None:
        session = self._session()
        action = F.col("customer_action")

        def one(condition: Column, kind: str = "long") -> Column:
            return F.when(condition, 1).otherwise(0).cast(kind)

        given = {
            "reminder_events": {"r_n": F.lit(1), "r_engaged": one(action.isNotNull()), "r_asked": one(action.isin("reschedule", "cancel")),
                                "r_sent": one(F.col("delivery_status") == "sent", "int")},
            "delay_events": {"d_n": F.lit(1), "d_max": F.col("delay_minutes"), "d_rank": band_rank(F.col("delay_band")), "d_offered": one(F.col("reschedule_shown")),
                             "d_rescheduled": one(action == "reschedule"),
                             "d_last": F.struct(F.col("triggered_at").alias("at"), "event_id", F.col("delay_minutes").alias("minutes"))},
        }
        fields = T.StructType.fromDDL(self.ROW).fields
        rows = [self._stream(session, name).select(*[
            F.col(f.name) if f.name == "appointment_id" else own.get(f.name, F.lit(0 if f.name in self.SUMS else None)).cast(f.dataType).alias(f.name)
            for f in fields]) for name, own in given.items()]
        self._run(rows[0].unionByName(rows[1]), "append")

    def _merged(self, rows: DataFrame) -> DataFrame:
        names = T.StructType.fromDDL(self.ROW).names[1:]
        return rows.groupBy("appointment_id").agg(*[(F.sum if c in self.SUMS else F.max)(c).alias(c) for c in names])

    def _since(self, spark: SparkSession, base: publish.Version | None, below: int | None = None) -> DataFrame:
        parts = self._read(spark, "parts", self.ROW, below, int(base.tag) + 1 if base else 0)
        return publish.read(spark, base).select(*parts.columns).unionByName(parts) if base else parts

    def _apply(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        self._write(self._merged(batch), "parts", number)
        base = publish.current(spark, self.state, "summary", before=_tag(number))
        if number - (int(base.tag) if base else -1) >= self.compact_after:
            whole = self._merged(self._since(spark, base, number + 1)).repartition("appointment_id").sortWithinPartitions("appointment_id")
            publish.publish(whole, self.state, "summary", _tag(number))
            publish.forget(spark, self.state, "summary", keep=2)

    def rows(self) -> DataFrame:
        return self._merged(self._since(self.spark, publish.current(self.spark, self.state, "summary")))

    def reminder_flags(self, corrected: bool = False) -> DataFrame:
        r = self.rows().where(F.col("r_n") > 0)
        return r.select("appointment_id", F.col("r_sent").alias("was_delivered"), (F.col("r_asked" if corrected else "r_engaged") > 0).cast("int").alias("was_engaged"))

    def reminder_counts(self, corrected: bool = False) -> DataFrame:
        return self.rows().where(F.col("r_n") > 0).select("appointment_id", F.col("r_n").alias("n_events"), F.col("r_asked" if corrected else "r_engaged").alias("n_engaged"))

    def delays(self) -> DataFrame:
        return self.rows().where(F.col("d_n") > 0).select(
            "appointment_id", F.col("d_max").alias("max_delay_minutes"), F.col("d_rank").alias("worst_band_rank"), F.col("d_n").alias("n_events"),
            F.col("d_offered").alias("n_offered"), F.col("d_rescheduled").alias("n_rescheduled"), F.col("d_last.minutes").alias("estimate"))


#: The views that read the summary in place of the events.
SUMMARY_VIEWS = {
    "conversion_funnel": lambda t, s, as_of: funnel.conversion_funnel(t, as_of, flags=s.reminder_flags()),
    "feature_adoption": lambda t, s, as_of: adoption.feature_adoption(t, as_of, counts=s.reminder_counts()),
    "delay_bands": lambda t, s, as_of: delays.bands_from_per_appointment(t, s.delays()),
    "attendance_after_reminder": lambda t, s, as_of: product.attendance_after_reminder(t, as_of, flags=s.reminder_flags()),
    "delay_estimate_accuracy": lambda t, s, as_of: product.delay_estimate_accuracy(t, as_of, last=s.delays().select("appointment_id", "estimate")),
}


def from_summary(t, view: str, as_of, state: str | None = None) -> DataFrame:
    """A view from the per-appointment summary kept for these tables, brought up to date first."""
    kept = AppointmentSummary(t.spark, t.root, state or state_folder(t, "summary"))
    kept.refresh()
    return SUMMARY_VIEWS[view](t, kept, as_of)


def delivery_daily(t, state: str | None = None) -> DataFrame:
    """M5 per day from the state kept for these tables, brought up to date first."""
    kept = DeliveryDays(t.spark, t.root, state or state_folder(t, "delivery"))
    kept.refresh()
    return kept.days()


def active_daily(t, state: str | None = None) -> DataFrame:
    """V3's daily figures from the state kept for these tables, brought up to date first."""
    kept = ActiveCustomers(t.spark, t.root, state or state_folder(t, "active"))
    kept.refresh()
    return kept.daily()


def active_customers(t, state: str | None = None) -> DataFrame:
    return active_daily(t, state).select("activity_date", "dau")


def _bitmaps(t, state: str | None) -> ActivityBitmaps:
    kept = ActivityBitmaps(t.spark, t.root, state or state_folder(t, "bitmaps"))
    kept.refresh()
    return kept


def daily_active_users(t, as_of, days: int = 90, corrected: bool = False, state: str | None = None) -> DataFrame:
    """V3 from the daily bitmaps, brought up to date first: only new rows are scanned."""
    return activity.over_calendar(t, _bitmaps(t, state).daily(), as_of, days, corrected)


def weekly_dau(t, as_of, weeks: int = 12, state: str | None = None) -> DataFrame:
    """D4 from the daily bitmaps."""
    return dashboard.weekly_dau_of(daily_active_users(t, as_of, weeks * 7 - 1, state=state))


def merge_compliance(t, as_of, weeks: int = 4, corrected: bool = False, state: str | None = None) -> DataFrame:
    """V12 from the pairs kept for these tables, brought up to date first."""
    kept = MergePairs(t.spark, t.root, state or state_folder(t, "merge"))
    kept.refresh()
    rows = kept.pairs().where(F.col("sent_at") >= ts_lit(weeks_before(as_of, weeks)))
    per_reminder = rows.select("event_id", "delivery_status", F.col("sent_at").cast("date").alias("sent_date"), "n_pairs")
    return weekly_compliance(t, per_reminder, corrected)
