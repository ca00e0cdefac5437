"""Reservation-shaped raw rows derived from the driver's order tables.

The source CSV of the original pipeline is not available, so raw rows are
derived deterministically from ``orders ⋈ customer ⋈ nation`` (every value is
text, like a CSV field). Base rows whose arrival day is divisible by 4 appear
twice, as exact duplicates.

Plan: customer ⋈ nation is a broadcast join (nation's row count is checked
first: 25 rows at every scale); the orders join shuffles on the customer key
(AQE splits a customer that holds a large share of orders); the joined rows
are rebalanced (narrow columns) only when the orders scan has fewer splits
than there are cores, so the text projection runs in parallel; duplicates
come from one ``explode`` over the joined rows, so the tables are scanned
and joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.schema import RAW_COLUMNS
from innkeep.sources.tables import read_table

# Board codes by order key modulo 5.
BOARD_CODES = ["BB", "HB", "FB", "SC", "Undefined"]


def _s(c: Column) -> Column:
    return c.cast("string")


def _room(k: Column) -> Column:
    return F.char(F.lit(65) + k % 6)


def _rate_text(k: Column) -> Column:
    n = (F.lit(7919) * k) % 50000
    return F.concat(_s(F.floor(n / 100)), F.lit("."), F.lpad(_s(n % 100), 2, "0"))


# A dimension is broadcast only when its counted rows are within this bound
# (nation holds 25 rows at every scale; the count makes that a checked fact).
BROADCAST_MAX_ROWS = 100_000


def _faults(k: Column, values: dict[str, Column]) -> dict[str, Column]:
    """``values`` with faults by key modulo (see FIXTURES.md), so that every check has something to find."""
    february = k % 43 == 0
    return values | {
        "hotel": F.when(k % 23 == 0, "Hostel").otherwise(values["hotel"]),
        "is_canceled": F.when(k % 29 == 0, "2").when(k % 4 != 0, "1").otherwise("0"),
        "booking_to_arrival_time": F.when(k % 31 == 0, "1.0").when(k % 37 == 0, "").otherwise(values["booking_to_arrival_time"]),
        "arrival_date_year": F.when(k % 47 == 0, "NA").when(k % 59 == 0, "NULL").otherwise(values["arrival_date_year"]),
        "arrival_date_month": F.when(k % 41 == 0, "Julio").when(february, "February").otherwise(values["arrival_date_month"]),
        "arrival_date_day_of_month": F.when(february, "30").otherwise(values["arrival_date_day_of_month"]),
        "adr": F.when(k % 17 == 0, "-0.004").when(k % 19 == 0, "-12.50").when(k % 53 == 0, "cheap").otherwise(values["adr"]),
        "reservation_status_date": F.when(k % 61 == 0, "soon").otherwise(values["reservation_status_date"]),
    }


def raw_reservations_from(orders: DataFrame, customer: DataFrame, nation: DataFrame, faults: bool = False) -> DataFrame:
    """Raw reservation rows (32 text columns) from the three driver tables.

    ``faults``: some values are replaced by ones that the checks and the
    lenient parser must notice.
    """
    names = nation.select("n_nationkey", "n_name")
    if names.count() <= BROADCAST_MAX_ROWS:  # Parquet answers from footers
        names = F.broadcast(names)
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        names,
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    base = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").join(
        cust, F.col("o_custkey") == F.col("c_custkey")
    )
    # When the orders scan has fewer splits than the cluster has cores (a
    # small single-file table), rebalance the narrow joined rows (AQE sizes
    # the partitions) so the wide text projection below runs in parallel. A
    # large table is read in many splits and the join output is spread
    # already, so no extra shuffle is added there. (Split count is known at
    # planning time; no job runs.)
    if orders.rdd.getNumPartitions() < orders.sparkSession.sparkContext.defaultParallelism:
        base = base.hint("rebalance")
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    d = F.col("o_orderdate")
    canceled = (k % 8).isin(1, 4, 6)
    room = _room(k)
    values: dict[str, Column] = {
        "hotel": F.when(k % 3 == 0, "Apartment").otherwise("Hotel"),
        "is_canceled": F.when(canceled, "1").otherwise("0"),
        "booking_to_arrival_time": F.when(k % 101 == 0, "NA").otherwise(_s((13 * k) % 365)),
        "arrival_date_year": _s(F.year(d)),
        "arrival_date_month": F.date_format(d, "MMMM"),
        "arrival_date_week_number": _s(F.weekofyear(d)),
        "arrival_date_day_of_month": _s(F.dayofmonth(d)),
        "stays_in_weekend_nights": F.when(k % 97 == 0, "NA").otherwise(_s(c % 3)),
        "stays_in_week_nights": _s(k % 6),
        "adults": _s(1 + c % 3),
        "children": F.when(k % 89 == 0, "NA").otherwise(_s(k % 4)),
        "babies": _s(k % 2),
        "board": F.element_at(F.array(*[F.lit(b) for b in BOARD_CODES]), (k % 5 + 1).cast("int")),
        "country": F.when(k % 50 == 0, "NULL").when(k % 53 == 0, "NA").otherwise(F.col("n_name")),
        "market_segment": F.col("c_mktsegment"),
        "acquisition_channel": F.col("o_orderpriority"),
        "is_repeated_guest": F.when(c % 31 == 0, "1").otherwise("0"),
        "previous_cancellations": _s(c % 2),
        "previous_bookings_not_canceled": _s(c % 5),
        "reserved_room_type": room,
        "assigned_room_type": F.when(k % 7 == 0, "H").otherwise(room),
        "booking_changes": _s(k % 4),
        "deposit_type": F.when(k % 10 == 0, "Refundable")
        .when(k % 10 == 1, "Non Refund")
        .otherwise("No Deposit"),
        "agent": F.when(k % 6 == 0, "NULL").otherwise(_s(c % 40)),
        "company": F.when(k % 19 == 0, _s(c % 20)).otherwise("NULL"),
        "days_in_waiting_list": _s(k % 15),
        "customer_type": F.when(k % 4 == 0, "Group").otherwise("Transient"),
        "adr": F.when(k == 42, "-6.38")
        .when(k % 211 == 0, "NA")
        .when(k % 61 == 0, "0")
        .otherwise(_rate_text(k)),
        "parking_lot": F.when(k % 9 == 0, "1").otherwise("0"),
        "total_of_special_requests": _s(k % 5),
        "reservation_status": F.when(canceled, "Canceled").otherwise("Check-Out"),
        "reservation_status_date": _s(d.cast("date")),
    }
    if faults:
        values = _faults(k, values)
    copies = F.when(F.dayofmonth(d) % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        base.select(*[values[name].alias(name) for name in RAW_COLUMNS], F.explode(copies).alias("_copy"))
        .drop("_copy")
    )


def raw_reservations(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Raw reservation rows for a driver scale-factor folder."""
    return raw_reservations_from(
        read_table(spark, sf_dir, "orders"),
        read_table(spark, sf_dir, "customer"),
        read_table(spark, sf_dir, "nation"),
        faults,
    )
