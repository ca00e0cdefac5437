"""Declared checks, compiled into as few passes as they need.

A check names a table, columns, a kind and a parameter. All checks of a table
that can be told from one pass over its rows become columns of a single
aggregate; uniqueness needs rows of equal values together and is one grouped
pass over the columns declared unique. A report has the counts that the single
checks of :mod:`innkeep.operators.quality` have as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.functions.fingerprint import is_hash_text, row_hash
from innkeep.operators.quality import unique_fingerprint
from innkeep.schema import RAW_COLUMNS


@dataclass(frozen=True)
class Check:
    """``name``: under which the count is reported (checks of one name add up); ``table``: which rows."""

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    parameter: object = None


UNIQUE = ("unique", "unique_fingerprint")


def _sum(parts: Sequence[Column]) -> Column:
    return sum(parts[1:], parts[0]) if parts else F.lit(0).cast("bigint")


def _flag(bad: Column) -> Column:
    return F.coalesce(bad, F.lit(False)).cast("int").cast("bigint")


def _share(bad: Column) -> Column:
    """Percent of the rows; NULL without rows."""
    return F.try_divide((F.count_if(bad) * 100).cast("double"), F.count(F.lit(1)).cast("double"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _violations(check: Check) -> Column:
    """The aggregate that counts a check's violations in one pass over the rows."""
    columns, given = check.columns, check.parameter
    if check.kind == "not_null":
        return _sum([F.count_if(F.col(c).isNull()) for c in columns])
    if check.kind == "accepted_values":
        return _sum([F.count_distinct(F.when(~_text(c).isin(list(given[c])), _text(c))) for c in columns])
    if check.kind == "value_set":
        parts = []
        for c in columns:
            parts.append(F.count_distinct(F.when(~_text(c).isin(list(given[c])), _text(c))))
            parts.append(_flag(F.max(F.col(c).isNull())))
            parts += [F.lit(1).cast("bigint") - _flag(F.max(_text(c) == F.lit(v))) for v in given[c]]
        return _sum(parts)
    if check.kind == "non_negative":
        return _sum([F.count_distinct(F.when(F.col(c) < 0, F.col(c))) for c in columns])
    if check.kind == "min_rows":
        return _flag(F.count(F.lit(1)) < given)
    if check.kind == "share_within":
        value, low, high = given
        share = _share(F.col(columns[0]) == F.lit(value))
        return _flag((share < low) | (share > high))
    if check.kind == "min_distinct":
        least, left_out = given
        return _flag(F.count_distinct(F.when(F.col(columns[0]) != F.lit(left_out), F.col(columns[0]))) < least)
    if check.kind == "negative_share_below":
        return _flag(_share(F.col(columns[0]).try_cast("double") < 0) >= given)
    if check.kind == "row_hash":
        hash_ = F.col(columns[0])
        return F.count_if(~F.coalesce(is_hash_text(hash_), F.lit(False)) | (hash_ != row_hash(RAW_COLUMNS)))
    raise ValueError(f"{check.name}: no check of kind {check.kind!r}")


def _aggregate(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(k, violations): one row for each check, from one aggregate over the rows."""
    counted = rows.agg(*[_violations(c).cast("bigint").alias(str(k)) for k, c in enumerate(checks)])
    return counted.unpivot([], counted.columns, "k", "violations").select(F.col("k").cast("int").alias("k"), "violations")


def _repeated(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(k, violations): the number of values that occur more than once, all columns in one grouped pass."""
    if len(checks) == 1 and checks[0].kind == "unique_fingerprint":
        found = unique_fingerprint(rows, checks[0].columns[0], checks[0].table).select(F.lit(0).alias("k"))
    else:
        pairs = [F.struct(F.lit(k).alias("k"), _text(col).alias("value")) for k, c in enumerate(checks) for col in c.columns]
        found = rows.select(F.explode(F.array(*pairs)).alias("p")).select("p.k", "p.value").where("value IS NOT NULL")
        found = found.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = found.groupBy("k").agg(F.count(F.lit(1)).alias("violations"))
    every = rows.sparkSession.createDataFrame([(k,) for k in range(len(checks))], "k int")
    return every.join(counted, "k", "left").select("k", F.coalesce("violations", F.lit(0)).alias("violations"))


def report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """check_name, violations, passed: each table is read once, and once more if columns are declared unique."""
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for table, rows in tables.items():
        own = [c for c in checks if c.table == table]
        for some, count in (([c for c in own if c.kind not in UNIQUE], _aggregate), ([c for c in own if c.kind in UNIQUE], _repeated)):
            if some:
                names = spark.createDataFrame([(k, c.name) for k, c in enumerate(some)], "k int, check_name string")
                parts.append(count(rows, some).join(F.broadcast(names), "k").select("check_name", "violations"))
    if unknown := {c.table for c in checks} - set(tables):
        raise ValueError(f"checks of tables that are not given: {sorted(unknown)}")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("check_name").agg(F.sum("violations").alias("violations"))
    return found.withColumn("passed", F.col("violations") == 0)
