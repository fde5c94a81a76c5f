"""DuckDB oracles for the dashboard (D*) and product-definition (M*) metrics."""

from __future__ import annotations

from slotwise.plans import oracle as o
from slotwise.plans.oracle import AS_OF, COHORT_AS_OF, cnt, pct, with_tables


def _sub(sql: str) -> str:
    return f"(\n{sql}\n)"


def _exact_round(num: str, den: str, scale: int = 2, precision: int = 18) -> str:
    """num / den rounded half away from zero (HUGEINT arithmetic)."""
    unit = 10 ** scale
    q = (f"(sign({num}) * ((2 * {unit} * abs(CAST({num} AS HUGEINT)) + CAST({den} AS HUGEINT)) "
         f"// (2 * NULLIF(CAST({den} AS HUGEINT), 0))))")
    return (f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({10.0 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale})) "
            f"AS DECIMAL({precision},{scale}))")


KPI_CARDS = [("no_show_rate", "no_show_rate_pct", "30.0", "40.0"),
             ("reminder_engagement", "engagement_rate_pct", "60.0", "60.0"),
             ("delay_delivery", "delay_delivery_pct", "95.0", "95.0"),
             ("reschedule_via_delay", "reschedule_via_delay_pct", "70.0", "70.0"),
             ("prepay_adoption", "prepay_adoption_pct", "55.0", "55.0"),
             ("priority_ontime", "priority_ontime_pct", "90.0", "90.0")]


def _kpi_long(as_of: str = AS_OF) -> str:
    snap = _sub(o.kpi_snapshot(as_of))
    return "\nUNION ALL\n".join(
        f"SELECT '{k}' AS kpi, {c} AS value, CAST({t} AS DECIMAL(3,1)) AS target_pct, "
        f"CAST({r} AS DECIMAL(3,1)) AS reference_pct FROM {snap} s" for k, c, t, r in KPI_CARDS)


def kpi_attainment(as_of: str = AS_OF) -> str:
    n = "(CAST(value * 10 AS BIGINT) * 100)"
    d = "CAST(reference_pct * 10 AS BIGINT)"
    q, r = f"({n} // {d})", f"({n} % {d})"
    even = f"CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN {q} + 1 ELSE {q} END"
    return f"SELECT kpi, value, target_pct, reference_pct, CAST(LEAST({even}, 100) AS INTEGER) AS attainment_pct " \
           f"FROM ({_kpi_long(as_of)}) k"


def kpi_target_status(as_of: str = AS_OF) -> str:
    met = "CASE WHEN kpi = 'no_show_rate' THEN value <= target_pct ELSE value >= target_pct END"
    tgt = "'Target ' || CAST(CAST(target_pct AS INTEGER) AS VARCHAR) || '%'"
    line = (f"CASE WHEN kpi = 'no_show_rate' THEN {tgt} || ' · Baseline ' || "
            f"CAST(CAST(reference_pct AS INTEGER) AS VARCHAR) || '%' ELSE {tgt} END")
    return (f"SELECT kpi, value, target_pct, {met} AS met, "
            f"{line} || CASE WHEN {met} THEN ' ✓' ELSE '' END AS target_line FROM ({_kpi_long(as_of)}) k")


def weekly_secondary_kpis(as_of: str = AS_OF) -> str:
    rem = with_tables(f"""
SELECT d.year AS "year", d.week_number, {pct(cnt("re.customer_action IS NOT NULL"), "COUNT(*)")}
         AS reminder_engagement_pct
FROM reminder_events re
JOIN appointments a ON a.appointment_id = re.appointment_id
JOIN dim_date d ON CAST(re.sent_at AS DATE) = d.full_date
WHERE re.sent_at >= DATE '{as_of}' - INTERVAL 12 WEEK
GROUP BY d.year, d.week_number""")
    weeks = with_tables('SELECT "year", week_number, MIN(full_date) AS week_start FROM dim_date GROUP BY 1, 2')
    return f"""
SELECT "year", week_number, w.week_start, r.reminder_engagement_pct,
       p.adoption_rate_pct AS prepay_adoption_pct, q.on_time_rate_pct AS priority_ontime_pct
FROM {_sub(rem)} r
FULL JOIN {_sub(o.prepay_funnel(as_of))} p USING ("year", week_number)
FULL JOIN {_sub(o.priority_ontime(as_of))} q USING ("year", week_number)
LEFT JOIN {_sub(weeks)} w USING ("year", week_number)"""


def recent_weeks_summary(as_of: str = AS_OF, n: int = 4) -> str:
    return f"""
SELECT "year", iso_week, week_start, total_appointments, no_shows, no_show_rate_pct, wow_change_pct,
       CASE WHEN wow_change_pct > 0 THEN '▲' WHEN wow_change_pct < 0 THEN '▼' ELSE '–' END AS wow_direction,
       CASE WHEN week_end >= DATE '{as_of}' THEN 'In progress' ELSE 'Complete' END AS status
FROM {_sub(o.weekly_noshow(as_of))} v ORDER BY "year" DESC, iso_week DESC LIMIT {n}"""


def weekly_dau(as_of: str = AS_OF, weeks: int = 12) -> str:
    return f"""
SELECT "year", week_number, MIN(activity_date) AS week_start, COUNT(*) AS days,
       CAST(AVG(dau) AS DECIMAL(12,2)) AS avg_dau, MAX(dau) AS max_dau
FROM {_sub(o.daily_active_users(as_of, days=weeks * 7 - 1))} v GROUP BY "year", week_number"""


def dau_trailing_rounded(as_of: str = AS_OF) -> str:
    return f"""
SELECT activity_date, dau,
       CAST(round(AVG(dau) OVER (ORDER BY activity_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS BIGINT)
         AS dau_7day_avg_rounded
FROM {_sub(o.daily_active_users(as_of))} v"""


def monthly_outcome_share(as_of: str = AS_OF) -> str:
    return f"""SELECT "year", month_number, month_name, month_start, pct_attended AS attended_share_pct,
       pct_no_show AS no_show_share_pct FROM {_sub(o.conversion_funnel(as_of))} v"""


def _pivot(value: str, as_of: str, keep_size: bool) -> str:
    cells = ", ".join(f"MAX(CASE WHEN months_since_first = {m} THEN {value} END) AS m{m}" for m in range(5))
    size = "cohort_size, " if keep_size else ""
    return f"""SELECT cohort_month, cohort_label, {size}{cells}
FROM {_sub(o.cohort_retention_corrected(as_of))} v GROUP BY cohort_month, cohort_label, cohort_size"""


def retention_matrix(as_of: str = COHORT_AS_OF) -> str:
    bands = ", ".join(f"CASE WHEN m{m} IS NULL THEN NULL WHEN m{m} >= 70 THEN 'high' WHEN m{m} >= 50 THEN 'mid' "
                      f"ELSE 'low' END AS band_m{m}" for m in range(5))
    return f"SELECT *, {bands} FROM ({_pivot('retention_rate_pct', as_of, False)}) p"


def retained_counts_matrix(as_of: str = COHORT_AS_OF) -> str:
    return _pivot("retained_customers", as_of, True)


def delay_band_outcomes() -> str:
    return f"""SELECT delay_band_label, band_sort, ultimately_attended AS attended, rescheduled,
       ultimately_no_show AS no_show FROM {_sub(o.delay_bands_corrected())} v"""


def feature_adoption_summary() -> str:
    return with_tables(f"""
SELECT COUNT(*) AS total_salons, {cnt("reminder_30min")} AS with_30min_reminder,
       {cnt("delay_tracker")} AS with_delay_tracker, {cnt("prepay_enabled")} AS with_prepay,
       {cnt("reminder_30min AND delay_tracker AND prepay_enabled")} AS with_all_three,
       {pct(cnt("reminder_30min AND delay_tracker AND prepay_enabled"), "COUNT(*)")} AS full_adoption_pct
FROM salons WHERE is_active""")


def salon_feature_table(as_of: str = AS_OF) -> str:
    return f"""SELECT salon_id, salon_name, reminder_30min, delay_tracker, prepay_enabled,
       CASE WHEN prepay_enabled THEN prepay_discount END AS discount_pct,
       reminder_engagement_pct, prepay_adoption_pct, salon_noshow_rate_pct
FROM {_sub(o.feature_adoption(as_of))} v"""


def reminder_performance(as_of: str = AS_OF) -> str:
    return f"""SELECT reminder_type, sort_order, engagement_rate_pct, failure_rate_pct
FROM {_sub(o.reminder_by_type(as_of))} v"""


FUNNEL_STEPS = [(1, "Booking created", "step1_bookings", "100.0"),
                (2, "Reminder delivered", "step2_reminder_delivered", "95.0"),
                (3, "Reminder engaged", "step3_reminder_engaged", "60.0"),
                (4, "Shows up / reschedules", "step4_attended_rescheduled", "70.0"),
                (5, "No-show", "step5_no_show", "30.0")]


def _funnel_long(as_of: str) -> str:
    f = _sub(o.conversion_funnel(as_of))
    return "\nUNION ALL\n".join(
        f"""SELECT "year", month_number, month_start, {s} AS step, '{n}' AS step_name, {c} AS step_count,
       {pct(c, "step1_bookings")} AS pct_of_bookings FROM {f} v""" for s, n, c, _ in FUNNEL_STEPS)


def funnel_step_loss(as_of: str = AS_OF) -> str:
    return f"""SELECT "year", month_number, month_start, step, step_name, step_count, pct_of_bookings,
       CAST(CASE WHEN step > 1 AND step <= 3 THEN
         LAG(pct_of_bookings) OVER (PARTITION BY "year", month_number ORDER BY step) - pct_of_bookings END
         AS DECIMAL(5,1)) AS loss_pct
FROM ({_funnel_long(as_of)}) l"""


def funnel_vs_targets(as_of: str = AS_OF) -> str:
    targets = ", ".join(f"({s}, CAST({t} AS DECIMAL(4,1)))" for s, _, _, t in FUNNEL_STEPS)
    return f"""SELECT l."year", l.month_number, l.month_start, l.step, l.step_name, l.pct_of_bookings, t.target_pct,
       CAST(l.pct_of_bookings - t.target_pct AS DECIMAL(5,1)) AS gap_pct
FROM ({_funnel_long(as_of)}) l JOIN (VALUES {targets}) AS t(step, target_pct) ON t.step = l.step"""


# ---------------------------------------------------------------------------------------
# M-series
# ---------------------------------------------------------------------------------------

def _w30(as_of: str, days: int = 30) -> str:
    return f"a.scheduled_at >= DATE '{as_of}' - INTERVAL {days} DAY"


def noshow_rate_by_salon(as_of: str = AS_OF) -> str:
    return with_tables(f"""
SELECT a.salon_id, COUNT(*) AS total_appointments, {cnt("a.status = 'no_show'")} AS no_shows,
       {pct(cnt("a.status = 'no_show'"), "COUNT(*)")} AS no_show_rate_pct
FROM appointments a WHERE {_w30(as_of)} GROUP BY a.salon_id""")


def recovered_revenue(as_of: str = AS_OF, weeks: int = 12) -> str:
    num = "((40 * n - 100 * s) * p_cents)"
    den = f"(10000 * {weeks} * c)"
    return with_tables(f"""
g AS (
  SELECT a.salon_id, COUNT(*) AS n, {cnt("a.status = 'no_show'")} AS s,
         CAST(COALESCE(SUM(a.original_price), 0) * 100 AS HUGEINT) AS p_cents, COUNT(a.original_price) AS c
  FROM appointments a WHERE a.scheduled_at >= DATE '{as_of}' - INTERVAL {weeks} WEEK GROUP BY a.salon_id
)
SELECT salon_id, n AS bookings, s AS no_shows, {_exact_round("n", str(weeks))} AS bookings_per_week,
       {pct("s", "n")} AS no_show_rate_pct,
       {_exact_round("p_cents", "(100 * c)")} AS avg_price,
       {_exact_round(num, den)} AS recovered_per_week,
       {_exact_round(num + " * 52", den)} AS recovered_per_year
FROM g""")


def attendance_rate_weekly(as_of: str = AS_OF) -> str:
    return f"""SELECT "year", iso_week, week_start, total_appointments, attended,
       {pct("attended", "total_appointments")} AS attendance_rate_pct, 60.0 AS baseline_pct, 70.0 AS target_pct
FROM {_sub(o.weekly_noshow(as_of))} v"""


def attendance_after_reminder(as_of: str = AS_OF) -> str:
    rate = pct(cnt("a.status = 'attended'"), "COUNT(*)")
    return with_tables(f"""
SELECT COALESCE(r.was_delivered, 0) = 1 AS reminder_delivered, COUNT(*) AS appointments,
       {cnt("a.status = 'attended'")} AS attended, {rate} AS attendance_rate_pct,
       CAST({rate} - 60.0 AS DECIMAL(5,1)) AS uplift_vs_baseline_pct
FROM appointments a
LEFT JOIN (SELECT appointment_id, MAX(CASE WHEN delivery_status = 'sent' THEN 1 ELSE 0 END) AS was_delivered
           FROM reminder_events GROUP BY appointment_id) r ON r.appointment_id = a.appointment_id
WHERE {_w30(as_of)}
GROUP BY 1""")


def delivery_alerts(as_of: str = AS_OF) -> str:
    fail = pct(cnt("re.delivery_status = 'failed'"), "COUNT(*)")
    deliv = pct(cnt("re.delivery_status = 'sent'"), "COUNT(*)")
    return with_tables(f"""
SELECT d.year AS "year", d.week_number, MIN(d.full_date) AS week_start, COUNT(*) AS reminders,
       {cnt("re.delivery_status = 'failed'")} AS failed, {cnt("re.delivery_status = 'sent'")} AS delivered,
       {fail} AS failure_rate_pct, {deliv} AS delivery_rate_pct,
       20 * {cnt("re.delivery_status = 'failed'")} > COUNT(*) AS failure_alert,
       20 * {cnt("re.delivery_status = 'sent'")} < 19 * COUNT(*) AS delivery_alert
FROM reminder_events re JOIN dim_date d ON CAST(re.sent_at AS DATE) = d.full_date
WHERE re.sent_at >= DATE '{as_of}' - INTERVAL 12 WEEK
GROUP BY d.year, d.week_number""")


def prepay_conversion(as_of: str = AS_OF) -> str:
    return f"""SELECT "year", week_number, week_start, eligible_bookings, chose_prepay, paid_successfully,
       slot_hold_expired, {pct("slot_hold_expired", "chose_prepay")} AS slot_hold_expiry_rate_pct,
       {pct("paid_successfully", "chose_prepay")} AS checkout_paid_rate_pct,
       {pct("chose_prepay", "eligible_bookings")} AS click_through_proxy_pct
FROM {_sub(o.prepay_funnel(as_of))} v"""


def delay_estimate_accuracy() -> str:
    ok = "abs(l.delay_minutes - date_diff('minute', a.scheduled_at, a.marked_at)) <= 5"
    return with_tables(f"""
l AS (
  SELECT appointment_id, delay_minutes FROM (
    SELECT appointment_id, delay_minutes,
           ROW_NUMBER() OVER (PARTITION BY appointment_id ORDER BY triggered_at DESC, event_id DESC) AS rn
    FROM delay_events) x WHERE rn = 1
)
SELECT COUNT(*) AS appointments, {cnt(ok)} AS within_tolerance, {pct(cnt(ok), "COUNT(*)")} AS accuracy_pct
FROM l JOIN appointments a ON a.appointment_id = l.appointment_id
WHERE a.status = 'attended' AND a.marked_at IS NOT NULL""")


def reschedule_rate_by_prepay(as_of: str = AS_OF) -> str:
    return with_tables(f"""
SELECT a.payment_status = 'successful' AS prepaid, COUNT(*) AS appointments,
       {cnt("a.status = 'rescheduled'")} AS rescheduled,
       {pct(cnt("a.status = 'rescheduled'"), "COUNT(*)")} AS reschedule_rate_pct
FROM appointments a WHERE {_w30(as_of)} GROUP BY 1""")


def missed_reminders(as_of: str = AS_OF) -> str:
    types = [("confirmation", True), ("24h", True), ("2h", True), ("1h", True), ("30min", False)]
    plan = "\nUNION ALL\n".join(
        f"SELECT a.appointment_id, '{t}' AS reminder_type FROM appointments a JOIN salons s ON s.salon_id = a.salon_id "
        f"WHERE {_w30(as_of)}{'' if always else ' AND s.reminder_30min'}" for t, always in types)
    missing = ("COUNT(CASE WHEN NOT EXISTS (SELECT 1 FROM reminder_events re WHERE re.appointment_id = p.appointment_id "
               "AND re.reminder_type = p.reminder_type AND re.sent_at IS NOT NULL) THEN 1 END)")
    return with_tables(f"""
p AS ({plan})
SELECT reminder_type, COUNT(*) AS expected, {missing} AS missing, {pct(missing, "COUNT(*)")} AS missing_pct
FROM p GROUP BY reminder_type""")


def delay_check_coverage(as_of: str = AS_OF) -> str:
    return with_tables(f"""
w AS (
  SELECT a.appointment_id FROM appointments a JOIN salons s ON s.salon_id = a.salon_id
  WHERE {_w30(as_of)} AND s.delay_tracker
),
r AS (SELECT appointment_id, COUNT(*) AS recorded FROM delay_events GROUP BY appointment_id)
SELECT COUNT(*) AS appointments, CAST(7 * COUNT(*) AS BIGINT) AS planned_checks,
       CAST(COALESCE(SUM(r.recorded), 0) AS BIGINT) AS recorded_checks,
       {pct("COALESCE(SUM(r.recorded), 0)", "7 * COUNT(*)")} AS coverage_pct
FROM w LEFT JOIN r ON r.appointment_id = w.appointment_id""")


def confirmation_sla(as_of: str = AS_OF) -> str:
    ok = "date_diff('second', a.created_at, re.sent_at) < 60"
    return with_tables(f"""
SELECT d.year AS "year", d.week_number, MIN(d.full_date) AS week_start, COUNT(*) AS confirmations,
       {cnt(ok)} AS within_sla, {pct(cnt(ok), "COUNT(*)")} AS sla_pct
FROM reminder_events re
JOIN appointments a ON a.appointment_id = re.appointment_id
JOIN dim_date d ON CAST(re.sent_at AS DATE) = d.full_date
WHERE re.reminder_type = 'confirmation' AND re.sent_at >= DATE '{as_of}' - INTERVAL 12 WEEK
GROUP BY d.year, d.week_number""")


def fiscal_outcomes(as_of: str = AS_OF) -> str:
    """From the bookings themselves: fiscal weeks as Sundays passed since the one before 2025-01-01."""
    day = "CAST(scheduled_at AS DATE)"
    return with_tables(f"""
SELECT CAST(year({day}) AS INTEGER) AS "year", CAST(quarter({day}) AS INTEGER) AS "quarter",
       CAST(date_diff('day', DATE '1994-12-25', {day}) // 7 - 1566 AS INTEGER) + 1 AS fiscal_week,
       MIN(CAST(strftime({day}, '%Y%m%d') AS INTEGER)) AS first_date_key,
       MAX(CAST(strftime({day}, '%Y%m%d') AS INTEGER)) AS last_date_key, COUNT(*) AS total_appointments,
       {cnt("status = 'no_show'")} AS no_shows, {cnt(f"isodow({day}) IN (6, 7)")} AS weekend_appointments,
       {pct(cnt("status = 'no_show'"), "COUNT(*)")} AS no_show_rate_pct
FROM appointments
WHERE scheduled_at >= DATE '{as_of}' - INTERVAL 26 WEEK
  AND {day} BETWEEN DATE '{o.CAL_START}' AND DATE '{o.CAL_END}'
GROUP BY 1, 2, 3""")


def reschedule_cta_rule_check() -> str:
    return with_tables("""
SELECT delay_minutes >= 60 AS delay_60_plus, reschedule_shown, COUNT(*) AS events,
       (delay_minutes >= 60) = reschedule_shown AS rule_ok
FROM delay_events GROUP BY 1, 2""")


def retry_rule_check() -> str:
    return with_tables(f"""
SELECT reminder_type, COUNT(*) AS reminders, {cnt("retry_count > 2")} AS over_retry_limit,
       CAST(MAX(retry_count) AS INTEGER) AS max_retry_count
FROM reminder_events GROUP BY reminder_type""")


def delivery_daily() -> str:
    """All days with reminders."""
    return with_tables("""
per AS (SELECT CAST(sent_at AS DATE) AS sent_date, delivery_status AS s, COUNT(*) AS n FROM reminder_events WHERE sent_at IS NOT NULL GROUP BY 1, 2)
SELECT sent_date, CAST(SUM(n) AS BIGINT) AS reminders, CAST(SUM(CASE WHEN s = 'failed' THEN n ELSE 0 END) AS BIGINT) AS failed,
       CAST(SUM(CASE WHEN s = 'sent' THEN n ELSE 0 END) AS BIGINT) AS delivered,
       SUM(CASE WHEN s = 'failed' THEN 20 * n ELSE 0 END) > SUM(n) AS failure_alert,
       SUM(CASE WHEN s = 'sent' THEN 20 * n ELSE 0 END) < 19 * SUM(n) AS delivery_alert
FROM per GROUP BY sent_date""")


def active_customers_daily(figures: bool = False) -> str:
    """Distinct customers of all days with activity; with ``figures`` salons and appointments too."""
    more = ", COUNT(DISTINCT a.salon_id) AS active_salons, COUNT(DISTINCT a.appointment_id) AS active_appointments" if figures else ""
    return with_tables(f"""
days AS (
  SELECT CAST(scheduled_at AS DATE) AS activity_date, appointment_id FROM appointments WHERE status <> 'confirmed'
  UNION
  SELECT CAST(sent_at AS DATE), appointment_id FROM reminder_events WHERE customer_action IS NOT NULL AND sent_at IS NOT NULL)
SELECT activity_date, COUNT(DISTINCT a.customer_id) AS dau{more}
FROM days JOIN appointments a USING (appointment_id) GROUP BY activity_date""")


def refresh_two_nights(first, second) -> str:
    """Each night's counts by one conditional tally per customer; the later night's wins where it has any."""
    return with_tables(f"""
n AS (SELECT customer_id, COUNT(*) FILTER (scheduled_at < DATE '{first}') AS early,
             COUNT(*) FILTER (scheduled_at >= DATE '{first}' AND scheduled_at < DATE '{second}') AS late
      FROM appointments GROUP BY customer_id)
SELECT c.customer_id, c.salon_id, c.phone_hash, c.first_seen,
       CAST(CASE WHEN late > 0 THEN late WHEN early > 0 THEN early ELSE c.total_bookings END AS INTEGER) AS total_bookings, c.created_at
FROM customers c LEFT JOIN n ON n.customer_id = c.customer_id""")


def load_report() -> str:
    """The load of dirty bookings: each day of creation has its own fault, so the outcome follows from it."""
    return with_tables("""
d AS (SELECT *, EXTRACT(day FROM created_at) AS day FROM appointments),
s AS (SELECT CASE WHEN day = 1 THEN 'not_applicable' ELSE payment_status END AS pay, status, day,
             CASE WHEN day = 5 THEN FALSE ELSE is_priority END AS prio, CASE WHEN day = 4 THEN 0 ELSE discount_pct END AS disc, service_name FROM d)
SELECT 'stored' AS part, status || '/' || pay || '/' || CAST(prio AS VARCHAR) AS what, COUNT(*) AS n_rows, CAST(SUM(disc) AS DECIMAL(20,2)) AS discounts
FROM s WHERE day NOT IN (3, 6) AND NOT (day = 7 AND service_name IS NOT NULL) GROUP BY status, pay, prio
UNION ALL SELECT 'quarantine', 'status: domain', COUNT(*), NULL FROM d WHERE day = 3 HAVING COUNT(*) > 0
UNION ALL SELECT 'quarantine', 'customer_id: not_null', COUNT(*), NULL FROM d WHERE day IN (3, 6) HAVING COUNT(*) > 0
UNION ALL SELECT 'quarantine', 'service_name: max_length_255', COUNT(*), NULL FROM d WHERE day = 7 AND service_name IS NOT NULL HAVING COUNT(*) > 0""")
