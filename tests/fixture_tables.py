"""Tiny hand-made domain tables for edge cases (expected values worked out by hand)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from slotwise.sources import schemas
from slotwise.sources.calendar import build_calendar
from slotwise.sources.tables import Tables

D = dt.datetime

SALON = dict(salon_name="S", city=None, plan_tier="standard", onboarded_at=dt.date(2025, 1, 1),
             reminder_30min=False, delay_tracker=True, prepay_enabled=False,
             prepay_discount=Decimal("10.00"), is_active=True, created_at=D(2025, 1, 1), updated_at=D(2025, 1, 1))
CUSTOMER = dict(salon_id="s1", phone_hash="x" * 64, first_seen=dt.date(2025, 1, 1), total_bookings=0,
                created_at=D(2025, 1, 1))
APPT = dict(salon_id="s1", customer_id="c1", service_name=None, status="confirmed",
            payment_status="not_applicable", is_priority=False, original_price=Decimal("100.00"),
            discount_pct=Decimal("0.00"), amount_paid=None, razorpay_txn_id=None, rescheduled_from=None,
            marked_at=None)
REMINDER = dict(reminder_type="24h", delivery_status="sent", retry_count=0, customer_action=None)
DELAY = dict(delay_minutes=0, delay_band="on_schedule", message_sent=True, merged_reminder=False,
             reschedule_shown=False, customer_action=None)


def _rows(defaults, rows, schema):
    out = []
    for r in rows:
        full = {**defaults, **r}
        if schema is schemas.APPOINTMENTS:
            full.setdefault("created_at", full["scheduled_at"] - dt.timedelta(days=1))
        if schema is schemas.REMINDER_EVENTS:
            full.setdefault("scheduled_at", full.get("sent_at") or D(2025, 1, 1))
            full.setdefault("sent_at", full["scheduled_at"])
        out.append(tuple(full[f.name] for f in schema.fields))
    return out


def make_tables(spark, salons=(), customers=(), appointments=(), reminders=(), delays=(),
                cal_start=dt.date(2025, 1, 1), cal_end=dt.date(2026, 12, 31)) -> Tables:
    if not salons:
        salons = [{"salon_id": "s1"}]
    mk = lambda d, rows, sch: spark.createDataFrame(_rows(d, rows, sch), sch)
    return Tables(
        salons=mk(SALON, salons, schemas.SALONS),
        customers=mk(CUSTOMER, customers, schemas.CUSTOMERS),
        appointments=mk(APPT, appointments, schemas.APPOINTMENTS),
        reminder_events=mk(REMINDER, reminders, schemas.REMINDER_EVENTS),
        delay_events=mk(DELAY, delays, schemas.DELAY_EVENTS),
        calendar=build_calendar(spark, cal_start, cal_end),
        cal_start=cal_start, cal_end=cal_end,
    )
