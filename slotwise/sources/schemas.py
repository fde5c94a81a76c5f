"""Schemas and value domains of the six domain tables (explicit, never inferred)."""

from pyspark.sql import types as T

S, D, TS, B, I, SH = (T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(),
                      T.IntegerType(), T.ShortType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


SALONS = T.StructType([
    _f("salon_id", S, False), _f("salon_name", S, False), _f("city", S),
    _f("plan_tier", S, False), _f("onboarded_at", D, False),
    _f("reminder_30min", B, False), _f("delay_tracker", B, False), _f("prepay_enabled", B, False),
    _f("prepay_discount", T.DecimalType(5, 2), False), _f("is_active", B, False),
    _f("created_at", TS, False), _f("updated_at", TS, False),
])

CUSTOMERS = T.StructType([
    _f("customer_id", S, False), _f("salon_id", S, False), _f("phone_hash", S, False),
    _f("first_seen", D, False), _f("total_bookings", I, False), _f("created_at", TS, False),
])

APPOINTMENTS = T.StructType([
    _f("appointment_id", S, False), _f("salon_id", S, False), _f("customer_id", S, False),
    _f("service_name", S), _f("scheduled_at", TS, False), _f("created_at", TS, False),
    _f("status", S, False), _f("payment_status", S, False), _f("is_priority", B, False),
    _f("original_price", T.DecimalType(10, 2)), _f("discount_pct", T.DecimalType(5, 2), False),
    _f("amount_paid", T.DecimalType(10, 2)), _f("razorpay_txn_id", S), _f("rescheduled_from", S),
    _f("marked_at", TS),
])

REMINDER_EVENTS = T.StructType([
    _f("event_id", S, False), _f("appointment_id", S, False), _f("reminder_type", S, False),
    _f("scheduled_at", TS, False), _f("sent_at", TS), _f("delivery_status", S),
    _f("retry_count", SH, False), _f("customer_action", S),
])

DELAY_EVENTS = T.StructType([
    _f("event_id", S, False), _f("appointment_id", S, False), _f("triggered_at", TS, False),
    _f("delay_minutes", I, False), _f("delay_band", S, False), _f("message_sent", B, False),
    _f("merged_reminder", B, False), _f("reschedule_shown", B, False), _f("customer_action", S),
])

DIM_DATE = T.StructType([
    _f("date_key", I, False), _f("full_date", D, False), _f("day_of_week", I, False),
    _f("day_name", S, False), _f("week_number", I, False), _f("month_number", I, False),
    _f("month_name", S, False), _f("quarter", I, False), _f("year", I, False),
    _f("is_weekend", B, False), _f("fiscal_week", I, False),
])

SCHEMAS = {
    "salons": SALONS, "customers": CUSTOMERS, "appointments": APPOINTMENTS,
    "reminder_events": REMINDER_EVENTS, "delay_events": DELAY_EVENTS, "dim_date": DIM_DATE,
}

# Primary and foreign keys as declared by the source schema.
PRIMARY_KEYS = {
    "salons": "salon_id", "customers": "customer_id", "appointments": "appointment_id",
    "reminder_events": "event_id", "delay_events": "event_id", "dim_date": "date_key",
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("customers", "salon_id", "salons", "salon_id"),
    ("appointments", "salon_id", "salons", "salon_id"),
    ("appointments", "customer_id", "customers", "customer_id"),
    ("appointments", "rescheduled_from", "appointments", "appointment_id"),
    ("reminder_events", "appointment_id", "appointments", "appointment_id"),
    ("delay_events", "appointment_id", "appointments", "appointment_id"),
]

# --- fixed values: enum domains stated by the source schema comments -------------------
DOMAINS = {
    ("salons", "plan_tier"): ["standard", "premium"],
    ("appointments", "status"): ["confirmed", "attended", "no_show", "cancelled", "rescheduled"],
    ("appointments", "payment_status"): ["not_applicable", "pending", "successful", "failed", "expired"],
    ("reminder_events", "reminder_type"): ["confirmation", "24h", "2h", "1h", "30min"],
    ("reminder_events", "delivery_status"): ["sent", "failed", "skipped", "merged"],
    ("reminder_events", "customer_action"): ["none", "reschedule", "cancel"],
    ("delay_events", "delay_band"): ["on_schedule", "minor", "moderate", "major"],
    ("delay_events", "customer_action"): ["none", "reschedule", "wait"],
}

# --- fixed values: column defaults declared by the source schema ------------------------
DEFAULTS = {
    "salons": {"plan_tier": "standard", "reminder_30min": False, "delay_tracker": True,
               "prepay_enabled": False, "prepay_discount": "10.00", "is_active": True},
    "customers": {"total_bookings": 0},
    "appointments": {"payment_status": "not_applicable", "is_priority": False, "discount_pct": "0"},
    "reminder_events": {"retry_count": 0},
    "delay_events": {"message_sent": False, "merged_reminder": False, "reschedule_shown": False},
}

# Maximum declared string lengths (NVARCHAR(n)); Spark does not enforce them.
MAX_LENGTHS = {
    ("salons", "salon_id"): 36, ("salons", "salon_name"): 255, ("salons", "city"): 100,
    ("salons", "plan_tier"): 50, ("customers", "customer_id"): 36, ("customers", "salon_id"): 36,
    ("customers", "phone_hash"): 64, ("appointments", "appointment_id"): 36,
    ("appointments", "salon_id"): 36, ("appointments", "customer_id"): 36,
    ("appointments", "service_name"): 255, ("appointments", "status"): 30,
    ("appointments", "payment_status"): 20, ("appointments", "razorpay_txn_id"): 100,
    ("appointments", "rescheduled_from"): 36, ("reminder_events", "event_id"): 36,
    ("reminder_events", "appointment_id"): 36, ("reminder_events", "reminder_type"): 20,
    ("reminder_events", "delivery_status"): 20, ("reminder_events", "customer_action"): 20,
    ("delay_events", "event_id"): 36, ("delay_events", "appointment_id"): 36,
    ("delay_events", "delay_band"): 20, ("delay_events", "customer_action"): 20,
}
