"""Output checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.tables import read_partitioned


def partition_check(spark: SparkSession, root: str, year: int, month: int, day: int) -> DataFrame:
    """One row: does the day's partition exist, and how many rows it holds.

    The day is pruned at planning time, so only its files are read.
    """
    day_rows = read_partitioned(spark, root, year, month, day)
    return day_rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(int(year)).alias("year"),
        F.lit(int(month)).alias("month"),
        F.lit(int(day)).alias("day"),
        (F.col("row_count") > 0).alias("present"),
        "row_count",
    )
