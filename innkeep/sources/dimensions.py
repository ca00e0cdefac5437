"""Small literal dimensions (inline VALUES relations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innkeep.schema import MONTHS


def month_map(spark: SparkSession) -> DataFrame:
    """12-row ``(month_name, month_number)`` relation, January/01 … December/12.

    A ``LocalTableScan``: its size is fixed, so broadcasting it is always safe.
    """
    return spark.createDataFrame(MONTHS, "month_name string, month_number string")
