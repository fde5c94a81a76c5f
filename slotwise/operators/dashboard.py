"""The dashboard's derived figures, computed from the views instead of typed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.dates import met_by, since, weeks_before
from slotwise.functions.rates import count_if, dec, pct
from slotwise.operators import activity, adoption, cohort, delays, funnel, kpi, reminders, weekly
from slotwise.sources.tables import Tables

# --- fixed values: KPI cards (name, V1 column, target, divisor of the attainment bar) -------
KPI_CARDS = [
    ("no_show_rate", "no_show_rate_pct", "30.0", "40.0"),
    ("reminder_engagement", "engagement_rate_pct", "60.0", "60.0"),
    ("delay_delivery", "delay_delivery_pct", "95.0", "95.0"),
    ("reschedule_via_delay", "reschedule_via_delay_pct", "70.0", "70.0"),
    ("prepay_adoption", "prepay_adoption_pct", "55.0", "55.0"),
    ("priority_ontime", "priority_ontime_pct", "90.0", "90.0"),
]
LOWER_IS_BETTER = {"no_show_rate"}
# --- fixed values: funnel steps and their targets (% of bookings) --------------------------
FUNNEL_STEPS = [
    (1, "Booking created", "step1_bookings", "100.0"),
    (2, "Reminder delivered", "step2_reminder_delivered", "95.0"),
    (3, "Reminder engaged", "step3_reminder_engaged", "60.0"),
    (4, "Shows up / reschedules", "step4_attended_rescheduled", "70.0"),
    (5, "No-show", "step5_no_show", "30.0"),
]
NESTED_STEPS = 3          # steps 1..3 are nested; later steps are outcomes, not subsets
RETENTION_MONTHS = 5      # M0..M4
RETENTION_BANDS = [(70, "high"), (50, "mid")]


def _kpi_long(t: Tables, as_of: dt.date) -> DataFrame:
    snap = kpi.kpi_snapshot(t, as_of)
    args = [F.lit(len(KPI_CARDS))]
    for name, col, target, divisor in KPI_CARDS:
        args += [F.lit(name), F.col(col), dec(target, 3, 1), dec(divisor, 3, 1)]
    return snap.select(F.stack(*args).alias("kpi", "value", "target_pct", "reference_pct"))


def attainment_pct(value, reference) -> F.Column:
    """Bar width: value / reference in whole percent (half to even), capped at 100."""
    ratio = F.lit(100) * value / reference
    return F.least(F.bround(ratio, 0), F.lit(100)).cast("int")


def kpi_attainment(t: Tables, as_of: dt.date) -> DataFrame:
    """Bar width per KPI card = value / reference, in whole percent (half to even),
    capped at 100; the no-show card is measured against its baseline."""
    k = _kpi_long(t, as_of)
    return k.select("kpi", "value", "target_pct", "reference_pct",
                    attainment_pct(F.col("value"), F.col("reference_pct")).alias("attainment_pct"))


def kpi_target_status(t: Tables, as_of: dt.date) -> DataFrame:
    """Target line per KPI card with a check mark when met (no-show: at or below)."""
    k = _kpi_long(t, as_of)
    met = F.when(F.col("kpi").isin(*LOWER_IS_BETTER), F.col("value") <= F.col("target_pct")) \
           .otherwise(F.col("value") >= F.col("target_pct"))
    target_txt = F.concat(F.lit("Target "), F.col("target_pct").cast("int").cast("string"), F.lit("%"))
    line = F.when(F.col("kpi") == "no_show_rate",
                  F.concat(target_txt, F.lit(" · Baseline "), F.col("reference_pct").cast("int").cast("string"),
                           F.lit("%"))).otherwise(target_txt)
    return k.select("kpi", "value", "target_pct", met.alias("met"),
                    F.concat(line, F.when(met, F.lit(" ✓")).otherwise(F.lit(""))).alias("target_line"))


def reminder_engagement_weekly(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """Weekly reminder engagement (no view exists for it): reminders sent per US week of the
    send date, counted as in the by-type view (existing appointment, any action)."""
    start = weeks_before(as_of, weeks)
    rem = since(t.reminder_events, "sent_at", start)
    rem = rem.join(met_by(t.appointments, rem).select("appointment_id"), "appointment_id", "left_semi")
    return (weekly.with_week(rem, F.col("sent_at").cast("date"), t).groupBy("year", "week_number")
            .agg(F.count(F.lit(1)).alias("reminders_sent"),
                 count_if(F.col("customer_action").isNotNull()).alias("reminders_engaged"))
            .withColumn("reminder_engagement_pct", pct("reminders_engaged", "reminders_sent")))


def weekly_secondary_kpis(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """Reminder engagement, prepay adoption and priority on-time per (year, US week),
    outer-joined so a week with any of the three appears (each side <= weeks+1 rows)."""
    r = reminder_engagement_weekly(t, as_of, weeks).select("year", "week_number", "reminder_engagement_pct")
    p = weekly.prepay_funnel(t, as_of, weeks).select("year", "week_number", F.col("adoption_rate_pct")
                                                     .alias("prepay_adoption_pct"))
    o = weekly.priority_ontime(t, as_of, weeks).select("year", "week_number", F.col("on_time_rate_pct")
                                                       .alias("priority_ontime_pct"))
    j = r.join(p, ["year", "week_number"], "full").join(o, ["year", "week_number"], "full")
    # one row per calendar week: bounded by the calendar size
    first_day = t.cal().groupBy("year", "week_number").agg(F.min("full_date").alias("week_start"))
    return j.join(F.broadcast(first_day), ["year", "week_number"], "left").select(
        "year", "week_number", "week_start", "reminder_engagement_pct", "prepay_adoption_pct",
        "priority_ontime_pct")


def recent_weeks_summary(t: Tables, as_of: dt.date, n: int = 4) -> DataFrame:
    """D3: the latest ``n`` weeks of the no-show trend with the WoW arrow and an
    'In progress' status for weeks not closed at ``as_of`` (a top-n report: the limit is
    the feature)."""
    w = weekly.weekly_noshow(t, as_of).orderBy(F.col("year").desc(), F.col("iso_week").desc()).limit(n)
    arrow = F.when(F.col("wow_change_pct") > 0, "▲").when(F.col("wow_change_pct") < 0, "▼").otherwise("–")
    return w.select("year", "iso_week", "week_start", "total_appointments", "no_shows", "no_show_rate_pct",
                    "wow_change_pct", arrow.alias("wow_direction"),
                    F.when(F.col("week_end") >= F.lit(as_of), "In progress").otherwise("Complete").alias("status"))


def weekly_dau(t: Tables, as_of: dt.date, weeks: int = 12) -> DataFrame:
    """Daily active users reduced to one point per week (mean of the days shown)."""
    return weekly_dau_of(activity.daily_active_users(t, as_of, days=weeks * 7 - 1))


def weekly_dau_of(d: DataFrame) -> DataFrame:
    """D4 from V3's rows."""
    return d.groupBy("year", "week_number").agg(
        F.min("activity_date").alias("week_start"),
        F.count(F.lit(1)).alias("days"),
        F.avg("dau").cast("decimal(12,2)").alias("avg_dau"),
        F.max("dau").alias("max_dau"))


def dau_trailing_rounded(t: Tables, as_of: dt.date, days: int = 90) -> DataFrame:
    """Trailing mean of up to 7 daily values rounded to the nearest integer."""
    d = activity.daily_active_users(t, as_of, days=days)
    w = Window.orderBy("activity_date").rowsBetween(-6, 0)
    return d.select("activity_date", "dau",
                    F.round(F.avg("dau").over(w), 0).cast("bigint").alias("dau_7day_avg_rounded"))


def monthly_outcome_share(t: Tables, as_of: dt.date) -> DataFrame:
    """Attended-or-rescheduled share against no-show share per month."""
    return funnel.conversion_funnel(t, as_of).select(
        "year", "month_number", "month_name", "month_start",
        F.col("pct_attended").alias("attended_share_pct"), F.col("pct_no_show").alias("no_show_share_pct"))


def _retention_pivot(t: Tables, as_of: dt.date, value: str) -> DataFrame:
    c = cohort.cohort_retention(t, as_of, corrected=True)
    months = list(range(RETENTION_MONTHS))
    return (c.groupBy("cohort_month", "cohort_label", "cohort_size")
            .pivot("months_since_first", months).agg(F.max(value))
            .select("cohort_month", "cohort_label", "cohort_size",
                    *[F.col(str(m)).alias(f"m{m}") for m in months]))


def retention_matrix(t: Tables, as_of: dt.date) -> DataFrame:
    """Cohort x M0..M4 retention % (corrected cohort sizes); NULL where no data yet,
    with the colour band of each cell."""
    p = _retention_pivot(t, as_of, "retention_rate_pct")

    def band(c):
        e = F.when(F.col(c).isNull(), F.lit(None).cast("string"))
        for lo, name in RETENTION_BANDS:
            e = e.when(F.col(c) >= lo, name)
        return e.otherwise("low")
    return p.select("*", *[band(f"m{m}").alias(f"band_m{m}") for m in range(RETENTION_MONTHS)]).drop("cohort_size")


def retained_counts_matrix(t: Tables, as_of: dt.date) -> DataFrame:
    """Cohort x M0..M4 retained customers with the cohort size."""
    return _retention_pivot(t, as_of, "retained_customers")


def delay_band_outcomes(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Attended / rescheduled-via-delay / no-show appointments per worst delay band."""
    return delays.delay_bands(t, corrected=True).select(
        "delay_band_label", "band_sort", F.col("ultimately_attended").alias("attended"),
        "rescheduled", F.col("ultimately_no_show").alias("no_show"))


def feature_adoption_summary(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Active salons with each feature and with all three (one global aggregate)."""
    s = t.salons.where(F.col("is_active"))
    all3 = F.col("reminder_30min") & F.col("delay_tracker") & F.col("prepay_enabled")
    return s.agg(F.count(F.lit(1)).alias("total_salons"),
                 count_if(F.col("reminder_30min")).alias("with_30min_reminder"),
                 count_if(F.col("delay_tracker")).alias("with_delay_tracker"),
                 count_if(F.col("prepay_enabled")).alias("with_prepay"),
                 count_if(all3).alias("with_all_three")) \
            .withColumn("full_adoption_pct", pct("with_all_three", "total_salons"))


def salon_feature_table(t: Tables, as_of: dt.date) -> DataFrame:
    """Per salon toggles, the discount where prepay is on, and the three rates."""
    return adoption.feature_adoption(t, as_of).select(
        "salon_id", "salon_name", "reminder_30min", "delay_tracker", "prepay_enabled",
        F.when(F.col("prepay_enabled"), F.col("prepay_discount")).alias("discount_pct"),
        "reminder_engagement_pct", "prepay_adoption_pct", "salon_noshow_rate_pct")


def reminder_performance(t: Tables, as_of: dt.date) -> DataFrame:
    """Engagement and failure % per reminder type, in type order."""
    return reminders.reminder_by_type(t, as_of).select(
        "reminder_type", "sort_order", "engagement_rate_pct", "failure_rate_pct")


def funnel_steps_long(t: Tables, as_of: dt.date) -> DataFrame:
    """The funnel as (month, step, count, % of bookings) rows."""
    f = funnel.conversion_funnel(t, as_of)
    args = [F.lit(len(FUNNEL_STEPS))]
    for step, name, col, _ in FUNNEL_STEPS:
        args += [F.lit(step), F.lit(name), F.col(col)]
    long = f.select("year", "month_number", "month_start", "step1_bookings",
                    F.stack(*args).alias("step", "step_name", "step_count"))
    return long.withColumn("pct_of_bookings", pct("step_count", "step1_bookings")).drop("step1_bookings")


def funnel_step_loss(t: Tables, as_of: dt.date) -> DataFrame:
    """Loss between consecutive nested steps in points of bookings (steps 2-3);
    outcome steps 4-5 are not subsets of step 3, so they carry no loss."""
    long = funnel_steps_long(t, as_of)
    w = Window.partitionBy("year", "month_number").orderBy("step")
    prev = F.lag("pct_of_bookings").over(w)
    loss = F.when((F.col("step") > 1) & (F.col("step") <= NESTED_STEPS), prev - F.col("pct_of_bookings"))
    return long.select("year", "month_number", "month_start", "step", "step_name", "step_count",
                       "pct_of_bookings", loss.cast("decimal(5,1)").alias("loss_pct"))


def funnel_targets(spark) -> DataFrame:
    schema = T.StructType([T.StructField("step", T.IntegerType(), False),
                           T.StructField("target_pct", T.DecimalType(4, 1), False)])
    from decimal import Decimal
    return spark.createDataFrame([(s, Decimal(v)) for s, _, _, v in FUNNEL_STEPS], schema)


def funnel_vs_targets(t: Tables, as_of: dt.date) -> DataFrame:
    """Each month's funnel step against the target funnel 100/95/60/70/30."""
    long = funnel_steps_long(t, as_of)
    tg = F.broadcast(funnel_targets(t.spark))     # five fixed rows
    return long.join(tg, "step").select(
        "year", "month_number", "month_start", "step", "step_name", "pct_of_bookings", "target_pct",
        (F.col("pct_of_bookings") - F.col("target_pct")).cast("decimal(5,1)").alias("gap_pct"))
