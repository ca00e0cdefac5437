"""Row fingerprint: lower-hex SHA-256 of the raw values joined with ``|``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from innkeep.schema import RAW_COLUMNS

SEPARATOR = "|"


def row_hash(columns: Sequence[str] = RAW_COLUMNS) -> Column:
    """SHA-256 (UTF-8, lower hex) of ``columns`` joined by ``|`` in the given order.

    A NULL value hashes as the empty string: ``concat_ws`` would otherwise skip
    it and shift the remaining fields.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def is_hash_text(c: Column) -> Column:
    """True when ``c`` looks like a fingerprint: 64 lower-case hex characters."""
    return c.rlike("^[0-9a-f]{64}$")
