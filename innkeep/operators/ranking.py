"""Whole-table rank and share without funnelling every row into one task.

``RANK() OVER (ORDER BY v DESC)`` needs a global order. Instead of sorting all
rows in a single partition, rank = 1 + number of rows with a strictly larger
``v``. That only needs the histogram of distinct ``v`` values: its running sum
is an unpartitioned window, but over distinct values only. For row counts
``v`` (as here: bookings per group) the number of distinct values d obeys
1 + 2 + … + d <= N, i.e. d <= sqrt(2N) — about 1.4 million for 10**12 rows.
The histogram is joined back on ``v``; AQE turns that into a broadcast join
when the histogram is small, and a shuffle join otherwise. For a column with
any number of distinct values, :func:`rank_by` deals the histogram out by ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.session import staging_path


def rank_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``name`` = SQL ``RANK() OVER (ORDER BY value DESC)`` (ties share, gaps follow).

    NULL values sort last, after all non-NULL values.
    """
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col(value).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select(
        F.col(value).alias("_v"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias(name),
    )
    return df.join(ranks, df[value].eqNullSafe(ranks["_v"]), "inner").drop("_v")


def grand_total(df: DataFrame, value: str) -> Column:
    """``SUM(value) OVER ()`` as a scalar subquery (one value, no row movement)."""
    return df.select(F.sum(value)).scalar()


def rank_by(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """Add ``name`` = SQL ``RANK() OVER (ORDER BY value)`` for a column with any number of distinct values.

    The distinct values with their counts are dealt out by ranges (Spark
    samples the splitters), each task ranks its own range, and ranges are moved
    on by the rows of the ranges before them: one number a range, summed on the
    driver. No task holds more than a range of distinct values, and copies of
    one value are one row. NULLs stand last in either direction. Ranks are
    joined back on the value, so ``df`` is read twice.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_last()
    hist = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = hist.repartitionByRange(ranges, order).withColumn("_range", F.spark_partition_id())
    path = staging_path(spark, "rank-ranges")
    dealt.write.parquet(path)  # where each value lies must not change between the two passes
    dealt = spark.read.schema(dealt.schema).parquet(path)
    offsets, before = [], 0
    for r in dealt.groupBy("_range").agg(F.sum("_n").alias("n")).orderBy("_range").collect():  # at most one row a range
        offsets.append((r["_range"], before))
        before += r["n"]
    moved = spark.createDataFrame(offsets, "_range int, _before long")
    local = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = dealt.withColumn("_local", F.coalesce(F.sum("_n").over(local), F.lit(0))).join(F.broadcast(moved), "_range")
    ranks = ranks.select("_v", (F.col("_local") + F.col("_before") + 1).alias(name))
    return df.join(ranks, df[value].eqNullSafe(ranks["_v"]), "inner").drop("_v")
