from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from innkeep.schema import RAW_COLUMNS  # noqa: E402
from innkeep.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="innkeep-tests", shuffle_partitions=8)
    yield s
    s.stop()


def raw_row(**values: str) -> dict[str, str]:
    """A valid completed reservation as raw text, with overrides."""
    base = {
        "hotel": "Hotel",
        "is_canceled": "0",
        "booking_to_arrival_time": "10",
        "arrival_date_year": "2016",
        "arrival_date_month": "July",
        "arrival_date_week_number": "27",
        "arrival_date_day_of_month": "1",
        "stays_in_weekend_nights": "1",
        "stays_in_week_nights": "2",
        "adults": "2",
        "children": "0",
        "babies": "0",
        "board": "BB",
        "country": "PRT",
        "market_segment": "Online TA",
        "acquisition_channel": "TA/TO",
        "is_repeated_guest": "0",
        "previous_cancellations": "0",
        "previous_bookings_not_canceled": "0",
        "reserved_room_type": "A",
        "assigned_room_type": "A",
        "booking_changes": "0",
        "deposit_type": "No Deposit",
        "agent": "9",
        "company": "NULL",
        "days_in_waiting_list": "0",
        "customer_type": "Transient",
        "adr": "100.00",
        "parking_lot": "0",
        "total_of_special_requests": "0",
        "reservation_status": "Check-Out",
        "reservation_status_date": "2016-07-04",
    }
    base.update(values)
    return base


def raw_df(spark, rows: list[dict[str, str]]):
    from innkeep.schema import RAW_SCHEMA

    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def bronze_df(spark, rows: list[dict[str, str]], source: str = "test.csv"):
    from pyspark.sql import functions as F

    from innkeep.operators.bronze import with_lineage

    return with_lineage(raw_df(spark, rows), source, F.lit("2024-01-01 00:00:00").cast("timestamp"))
