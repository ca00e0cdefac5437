"""Reservation data model: raw column names, typing groups, month dimension.

Fixed values: these must equal the source system's contract for results to be
right (column names and their order feed the row fingerprint; month names and
numbers feed ``arrival_date`` / ``year_month``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the 32 raw columns, in file/fingerprint order --------------
RAW_COLUMNS: list[str] = [
    "hotel",
    "is_canceled",
    "booking_to_arrival_time",
    "arrival_date_year",
    "arrival_date_month",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "board",
    "country",
    "market_segment",
    "acquisition_channel",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "reserved_room_type",
    "assigned_room_type",
    "booking_changes",
    "deposit_type",
    "agent",
    "company",
    "days_in_waiting_list",
    "customer_type",
    "adr",
    "parking_lot",
    "total_of_special_requests",
    "reservation_status",
    "reservation_status_date",
]

# --- Fixed values: text that means "missing" (exact, case-sensitive) ----------
SENTINELS: tuple[str, str] = ("NA", "NULL")

# --- Fixed values: month dimension (name -> two-digit number) -----------------
MONTHS: list[tuple[str, str]] = [
    ("January", "01"),
    ("February", "02"),
    ("March", "03"),
    ("April", "04"),
    ("May", "05"),
    ("June", "06"),
    ("July", "07"),
    ("August", "08"),
    ("September", "09"),
    ("October", "10"),
    ("November", "11"),
    ("December", "12"),
]

# --- Fixed values: columns typed as INTEGER in the cleaned layer (sentinels -> NULL, then cast).
INT_COLUMNS: list[str] = [
    "is_canceled",
    "booking_to_arrival_time",
    "arrival_date_year",
    "arrival_date_week_number",
    "arrival_date_day_of_month",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "adults",
    "children",
    "babies",
    "is_repeated_guest",
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "parking_lot",
    "total_of_special_requests",
]

# --- Fixed values: text columns that get sentinel -> NULL but stay text.
NULLABLE_TEXT_COLUMNS: list[str] = ["country", "agent", "company"]

# --- Fixed values: renames applied in the cleaned layer
RENAMES: dict[str, str] = {
    "hotel": "hotel_type",
    "booking_to_arrival_time": "lead_time",
}

RATE_TYPE = T.DecimalType(10, 2)  # adr
MONEY_TYPE = T.DecimalType(18, 2)  # revenue and money sums

LINEAGE_COLUMNS: list[str] = ["_loaded_at", "_source_file", "_row_hash"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("_loaded_at", T.TimestampType(), True),
        T.StructField("_source_file", T.StringType(), True),
        T.StructField("_row_hash", T.StringType(), True),
    ]
)


def silver_name(raw: str) -> str:
    """Column name of a raw column in the cleaned layer."""
    return RENAMES.get(raw, raw)
