"""Incremental refresh of the merge-compliance pairs with Structured Streaming.

The metrics are refreshed on a schedule (nightly).  Instead of re-joining all reminders with
all delay events each night, the (reminder, delay) overlap pairs are kept by a stream-stream
join over the domain-table folders: each run (``trigger(availableNow=True)``) reads only the
files added since the last run, joins them against the buffered state of the other side
inside the event-time bounds, appends the new pairs to a parquet table and commits its
progress to the checkpoint.  The weekly figures are then a small batch rollup of that table,
equal to the batch view on the same (closed) data; events arriving later than the watermark
allows are not matched.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.dates import epoch_seconds, ts_lit, weeks_before
from slotwise.operators.merge import MERGE_REMINDER_TYPES, MERGE_WINDOW_SECONDS, weekly_compliance
from slotwise.session import ensure_checkpoint_dir
from slotwise.sources import schemas

PAIR_COLUMNS = ["event_id", "delivery_status", "sent_at", "delay_event_id"]


def _start(spark: SparkSession, writer, *args, state_partitions: int | None = None) -> StreamingQuery:
    """Start a streaming query with ``state_partitions`` state-store partitions.

    The partition count of a stateful query is fixed by ``spark.sql.shuffle.partitions`` when
    its checkpoint is first created; the query takes a copy of the session conf at start, so
    the setting is applied only around ``start`` and the caller's value is restored.  Default:
    the cluster's default parallelism (one state partition per core).
    """
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        return writer.start(*args)
    finally:
        spark.conf.set(key, old)


def merge_pairs_stream(spark: SparkSession, root: str, sink: str, checkpoint: str,
                       watermark: str = "6 hours", window: int = MERGE_WINDOW_SECONDS,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream-stream join of 2h/1h reminders with delay events on the same
    appointment less than ``window`` seconds apart; new pairs are appended to ``sink``."""
    rem = (spark.readStream.schema(schemas.REMINDER_EVENTS).parquet(f"{root}/reminder_events")
           .where(F.col("reminder_type").isin(MERGE_REMINDER_TYPES) & F.col("sent_at").isNotNull())
           .select("event_id", "appointment_id", "delivery_status", "sent_at",
                   epoch_seconds("sent_at").alias("rs"))
           .withColumn("r_time", F.timestamp_seconds("rs"))
           .withWatermark("r_time", watermark))
    dl = (spark.readStream.schema(schemas.DELAY_EVENTS).parquet(f"{root}/delay_events")
          .select(F.col("event_id").alias("delay_event_id"), F.col("appointment_id").alias("d_appointment_id"),
                  epoch_seconds("triggered_at").alias("ds"))
          .withColumn("d_time", F.timestamp_seconds("ds"))
          .withWatermark("d_time", watermark))
    bound = F.expr(f"INTERVAL {window} SECONDS")
    cond = ((F.col("appointment_id") == F.col("d_appointment_id"))
            & (F.col("d_time") >= F.col("r_time") - bound) & (F.col("d_time") <= F.col("r_time") + bound)
            & (F.abs(F.col("ds") - F.col("rs")) < window))
    pairs = rem.join(dl, cond).select(*PAIR_COLUMNS)
    w = (pairs.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return _start(spark, w, sink)


def refresh_merge_pairs(spark: SparkSession, root: str, state_dir: str | None = None) -> str:
    """Run one incremental refresh to completion; return the pairs table path."""
    base = state_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/merge_pairs-{uuid.uuid4().hex[:12]}"
    q = merge_pairs_stream(spark, root, f"{base}/pairs", f"{base}/_checkpoint")
    q.awaitTermination()
    return f"{base}/pairs"


def merge_compliance_from_pairs(t, pairs: DataFrame, as_of: dt.date, weeks: int = 4,
                                corrected: bool = False) -> DataFrame:
    """V12 from the incrementally maintained pairs table."""
    start = weeks_before(as_of, weeks)
    per_reminder = (pairs.where(F.col("sent_at") >= ts_lit(start))
                    .groupBy("event_id", "delivery_status", F.col("sent_at").cast("date").alias("sent_date"))
                    .agg(F.count(F.lit(1)).alias("n_pairs")))
    return weekly_compliance(t, per_reminder, corrected)


def merge_compliance_incremental(t, as_of: dt.date, weeks: int = 4, corrected: bool = False) -> DataFrame:
    """Refresh the pairs table from the tables' folders, then roll it up (needs ``t.root``)."""
    if not t.root:
        raise ValueError("incremental refresh needs tables stored as parquet folders (Tables.root)")
    spark = t.spark
    path = refresh_merge_pairs(spark, t.root)
    pairs = spark.read.schema("event_id string, delivery_status string, sent_at timestamp_ntz, "
                              "delay_event_id string").parquet(path)
    return merge_compliance_from_pairs(t, pairs, as_of, weeks, corrected)


# --- daily reminder delivery (M5 alerts) as an event-time windowed aggregation -------------

def delivery_daily_stream(spark: SparkSession, root: str, sink: str, checkpoint: str,
                          lateness: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Reminders sent per calendar day with failures and deliveries, appended once a day is
    closed: a day is final when the watermark (latest send time seen minus ``lateness``) has
    passed its end; reminders arriving later than that are not counted."""
    from slotwise.operators.product import DELIVERY_ALERT_PCT, FAILURE_ALERT_PCT

    rem = (spark.readStream.schema(schemas.REMINDER_EVENTS).parquet(f"{root}/reminder_events")
           .where(F.col("sent_at").isNotNull())
           .withColumn("sent_time", F.timestamp_seconds(epoch_seconds("sent_at")))
           .withWatermark("sent_time", lateness))
    daily = rem.groupBy(F.window("sent_time", "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("reminders"),
        F.count(F.when(F.col("delivery_status") == "failed", 1)).alias("failed"),
        F.count(F.when(F.col("delivery_status") == "sent", 1)).alias("delivered"))
    out = daily.select(
        # windows are aligned to UTC days of the epoch-based event time: date from epoch days
        F.date_from_unix_date(F.floor(F.unix_seconds(F.col("day.start")) / 86400).cast("int")).alias("sent_date"),
        "reminders", "failed", "delivered",
        (F.col("failed") * 100 > F.col("reminders") * FAILURE_ALERT_PCT).alias("failure_alert"),
        (F.col("delivered") * 100 < F.col("reminders") * DELIVERY_ALERT_PCT).alias("delivery_alert"))
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return _start(spark, w, sink)


def delivery_daily_incremental(t, lateness_days: int = 1) -> DataFrame:
    """Run the daily delivery stream once over the tables' folders (one availableNow run) and
    return the closed days it has written."""
    if not t.root:
        raise ValueError("incremental refresh needs tables stored as parquet folders (Tables.root)")
    spark = t.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/delivery_daily-{uuid.uuid4().hex[:12]}"
    q = delivery_daily_stream(spark, t.root, f"{base}/daily", f"{base}/_checkpoint",
                              lateness=f"{lateness_days} day")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/daily")


# --- per-appointment delay state (V8) as an update-mode streaming aggregation ----------------

STATE_COLUMNS = ["appointment_id", "max_delay_minutes", "worst_band_rank", "n_events", "n_offered",
                 "n_rescheduled"]


def delay_state_stream(spark: SparkSession, root: str, log_path: str, checkpoint: str,
                       available_now: bool = True) -> StreamingQuery:
    """Keep the per-appointment delay aggregate of V8 in the state store; every micro-batch
    appends the appointments whose aggregate changed, tagged with the batch id, to a state log.

    A re-executed batch (after a failure) appends identical rows under the same batch id, so
    the log stays correct; ``latest_delay_state`` reads the newest row per appointment.  The
    state holds one row per appointment with delays (use the RocksDB state store provider at
    scale).
    """
    from slotwise.operators.delays import band_rank

    de = spark.readStream.schema(schemas.DELAY_EVENTS).parquet(f"{root}/delay_events")
    agg = de.groupBy("appointment_id").agg(
        F.max("delay_minutes").alias("max_delay_minutes"),
        F.max(band_rank(F.col("delay_band"))).alias("worst_band_rank"),
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("reschedule_shown"), 1)).alias("n_offered"),
        F.count(F.when(F.col("customer_action") == "reschedule", 1)).alias("n_rescheduled"))

    def append_changes(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(log_path)

    w = (agg.writeStream.outputMode("update").foreachBatch(append_changes)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return _start(spark, w)


def latest_delay_state(spark: SparkSession, log_path: str) -> DataFrame:
    """Newest state row per appointment from the log (one shuffle on the key, partial-aggregated)."""
    log = spark.read.parquet(log_path)
    latest = log.groupBy("appointment_id").agg(
        F.max_by(F.struct(*STATE_COLUMNS[1:]), F.col("batch_id")).alias("s"))
    return latest.select("appointment_id", "s.*")


def delay_bands_incremental(t, corrected: bool = False) -> DataFrame:
    """V8 from the streamed per-appointment state (one availableNow run over the folders)."""
    from slotwise.operators.delays import bands_from_per_appointment

    if not t.root:
        raise ValueError("incremental refresh needs tables stored as parquet folders (Tables.root)")
    spark = t.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/delay_state-{uuid.uuid4().hex[:12]}"
    delay_state_stream(spark, t.root, f"{base}/log", f"{base}/_checkpoint").awaitTermination()
    return bands_from_per_appointment(t, latest_delay_state(spark, f"{base}/log"), corrected=corrected)


# --- daily active customers (V3 dau) with de-duplication inside the watermark ---------------

def active_customers_stream(spark: SparkSession, root: str, sink: str, checkpoint: str,
                            lateness: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Distinct active customers per day, appended once a day is closed.

    Activity is a booking with an outcome (at its scheduled time) or a reminder the customer
    acted on (at its send time, customer looked up with a stream-static join).  A customer is
    counted once per day: ``dropDuplicatesWithinWatermark`` keeps the first (day, customer)
    row while later ones can still arrive, then a watermarked daily window counts the rows.
    """
    from slotwise.operators.activity import ACTIVE_STATUSES

    appts_static = spark.read.schema(schemas.APPOINTMENTS).parquet(f"{root}/appointments") \
        .select("appointment_id", "customer_id")
    booked = (spark.readStream.schema(schemas.APPOINTMENTS).parquet(f"{root}/appointments")
              .where(F.col("status").isin(ACTIVE_STATUSES))
              .select(F.col("scheduled_at").alias("at"), "customer_id"))
    acted = (spark.readStream.schema(schemas.REMINDER_EVENTS).parquet(f"{root}/reminder_events")
             .where(F.col("customer_action").isNotNull() & F.col("sent_at").isNotNull())
             .join(appts_static, "appointment_id")
             .select(F.col("sent_at").alias("at"), "customer_id"))
    act = (booked.unionByName(acted)
           .select(F.timestamp_seconds(epoch_seconds("at")).alias("event_time"),
                   F.col("at").cast("date").alias("activity_date"), "customer_id")
           .withWatermark("event_time", lateness)
           .dropDuplicatesWithinWatermark(["activity_date", "customer_id"]))
    daily = act.groupBy(F.window("event_time", "1 day").alias("day")).agg(F.count(F.lit(1)).alias("dau"))
    out = daily.select(
        F.date_from_unix_date(F.floor(F.unix_seconds(F.col("day.start")) / 86400).cast("int")).alias("activity_date"),
        "dau")
    w = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return _start(spark, w, sink)


def active_customers_incremental(t, lateness_days: int = 1) -> DataFrame:
    """Run the active-customer stream once over the tables' folders; return the closed days."""
    if not t.root:
        raise ValueError("incremental refresh needs tables stored as parquet folders (Tables.root)")
    spark = t.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/active_customers-{uuid.uuid4().hex[:12]}"
    active_customers_stream(spark, t.root, f"{base}/daily", f"{base}/_checkpoint",
                            lateness=f"{lateness_days} day").awaitTermination()
    return spark.read.parquet(f"{base}/daily")
