"""Column expressions that turn raw text into typed values.

Two parsing modes: *strict* (bad text fails the job, like a typed SQL model)
and *lenient* (bad text becomes NULL, like a dashboard coercing numbers).
Everything stays a built-in expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from innkeep.schema import MONEY_TYPE, RATE_TYPE, SENTINELS

DATE_PATTERN = "yyyy-MM-dd"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_null(c: str | Column) -> Column:
    """``NA`` and ``NULL`` text -> NULL (exact, case-sensitive, untrimmed)."""
    v = col_(c)
    return F.when(v.isin(*SENTINELS), F.lit(None).cast("string")).otherwise(v)


def _ansi() -> bool:
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.ansi.enabled", "false").lower() == "true"


def _checked(text: Column, parsed: Column, what: str) -> Column:
    """``parsed`` but fail the task when non-NULL ``text`` did not parse."""
    return F.when(
        text.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"invalid {what}: '"), text, F.lit("'"))),
    ).otherwise(parsed)


def parse(text: Column, dtype: str, strict: bool = True) -> Column:
    """Cast text to ``dtype``; strict fails on bad input, lenient yields NULL.

    Strict mode is Spark's ANSI cast when the session runs with ANSI on (the
    library default); otherwise an explicit check raises the error.
    """
    if not strict:
        return text.try_cast(dtype)
    if _ansi():
        return text.cast(dtype)
    return _checked(text, text.try_cast(dtype), dtype)


def parse_date(text: Column, pattern: str | None = None, strict: bool = True) -> Column:
    """Text -> DATE (ISO ``yyyy-MM-dd`` by default)."""
    if strict and _ansi():
        return F.to_date(text, pattern) if pattern else text.cast("date")
    parsed = F.try_to_date(text, pattern) if pattern else text.try_cast("date")
    return _checked(text, parsed, "date") if strict else parsed


def typed_int(c: str, strict: bool = True) -> Column:
    return parse(sentinel_null(c), "int", strict)


def typed_rate(c: str = "adr", strict: bool = True) -> Column:
    return parse(sentinel_null(c), RATE_TYPE.simpleString(), strict)


def typed_date(c: str, strict: bool = True) -> Column:
    return parse_date(sentinel_null(c), None, strict)


def total_nights(weekend: Column, week: Column) -> Column:
    """Missing stay counts count as 0 here (the stay columns stay NULL)."""
    return F.coalesce(weekend, F.lit(0)) + F.coalesce(week, F.lit(0))


def revenue(canceled_text: Column, rate: Column, nights: Column) -> Column:
    """Rate x nights for completed stays, else 0.

    "Completed" is the *text* ``'0'`` after sentinel removal, so ``' 0'``
    (which types to 0) still earns nothing.
    """
    amount = F.coalesce(rate, F.lit(0).cast(RATE_TYPE)) * nights
    return (
        F.when(sentinel_null(canceled_text) == F.lit("0"), amount)
        .otherwise(F.lit(0))
        .cast(MONEY_TYPE)
    )


def arrival_date(year: Column, month_number: Column, day: Column, strict: bool = True) -> Column:
    """Date from raw year text, matched month number and raw day text.

    ``'NA'`` year/day or an unmatched month give NULL; other bad text (e.g.
    ``'NULL'``) reaches the parser and fails in strict mode.
    """
    # concat is NULL if any part is, so only the 'NA' text needs a test
    known = (year != F.lit("NA")) & (day != F.lit("NA"))
    text = F.when(known, F.concat(year, F.lit("-"), month_number, F.lit("-"), F.lpad(day, 2, "0")))
    return parse_date(text, DATE_PATTERN, strict)


def year_month(year: Column, month_number: Column) -> Column:
    """``YYYY-MM`` text; NULL when the year is ``NA``/NULL or the month unmatched."""
    return F.when(
        (year != F.lit("NA")) & month_number.isNotNull(),
        F.concat(year, F.lit("-"), month_number),
    )


def room_changed(reserved: Column, assigned: Column) -> Column:
    """TRUE only when both sides are known and differ."""
    return F.when(reserved != assigned, F.lit(True)).otherwise(F.lit(False))
