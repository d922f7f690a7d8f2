"""Settlement kept up to date from the days that changed.

Silver runs note the days that they wrote in a change log. An update compares
the log with the partials it holds, which carry the change that they reflect,
reads the Silver of the days that differ, and replaces their folders: sum, count and largest amount per merchant, which merge exactly over
days. Settlement of a day, a month or everything is read from the partials.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import date_key
from ledgerlake.session import require_utc
from ledgerlake.sinks.parquet import write_partitioned
from ledgerlake.sources.tables import path_exists

CHANGES = "date_key int, change string"
#: What a row of the settlement stands for, as an expression over the day's key.
PERIODS = {"day": "date_key", "month": "date_key div 100", "year": "date_key div 10000"}


def log_changes(spark: SparkSession, changes_path: str, days: DataFrame) -> None:
    """Note that the days (year, month, day of ``days``) were written. Changes sort by their time."""
    name = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"
    key = (F.col("year") * 10000 + F.col("month") * 100 + F.col("day")).cast("int")
    rows = days.select(key.alias("date_key"), F.lit(name).alias("change")).distinct()
    rows.coalesce(1).write.mode("append").parquet(changes_path)


def changed_days(spark: SparkSession, changes_path: str, partials_path: str) -> DataFrame:
    """Days (date_key, change) whose partials are missing or reflect another change than the last."""
    if not path_exists(spark, changes_path):
        return spark.createDataFrame([], CHANGES)
    last = spark.read.schema(CHANGES).parquet(changes_path).groupBy("date_key").agg(F.max("change").alias("change"))
    if not path_exists(spark, partials_path):
        return last
    held = spark.read.parquet(partials_path).groupBy(F.col("date_key").alias("_d")).agg(F.max("change").alias("_c"))
    return last.join(held, (F.col("date_key") == F.col("_d")) & (F.col("change") == F.col("_c")), "left_anti")


def partial_settlement(silver: DataFrame) -> DataFrame:
    return silver.groupBy(date_key("event_time").alias("date_key"), "merchant_id").agg(
        F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("txn_count"), F.max("amount").alias("max_amount")
    )


def update_settlement(spark: SparkSession, silver_path: str, changes_path: str, partials_path: str) -> list[int]:
    """Bring the partials of changed days up to date, in one job; returns these days (one short row each).

    Every changed day also gets a row without payments, which carries its
    change: a day that has no Silver rows any more then holds nothing else.
    """
    require_utc(spark)
    changed = changed_days(spark, changes_path, partials_path).collect()
    if not changed:
        return []
    days = sorted(r.date_key for r in changed)
    changes = spark.createDataFrame(changed, CHANGES)
    partials = partial_settlement(silver_days(spark, silver_path, days)).join(changes, "date_key")
    marks = changes.withColumn("txn_count", F.lit(0).cast("long"))
    rows = partials.unionByName(marks, allowMissingColumns=True)
    write_partitioned(rows.hint("rebalance", "date_key"), partials_path, mode="overwrite", partition_by=("date_key",))
    return days


def silver_days(spark: SparkSession, silver_path: str, days: list[int]) -> DataFrame:
    """The Silver rows of some days: only their folders are listed."""
    root = silver_path.rstrip("/")
    leaves = [f"{root}/year={k // 10000}/month={k // 100 % 100}/day={k % 100}" for k in days]
    leaves = [x for x in leaves if path_exists(spark, x)]
    if leaves:
        return spark.read.option("basePath", root).parquet(*leaves)
    return spark.read.parquet(root).limit(0)


def settlement(spark: SparkSession, partials_path: str, period: str = "day") -> DataFrame:
    """Settlement per period and merchant, merged from the partials (the period's key is named ``date_key``)."""
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    merged = (
        spark.read.parquet(partials_path)
        .filter("txn_count > 0")
        .groupBy(F.expr(PERIODS[period]).cast("int").alias("date_key"), "merchant_id")
        .agg(
            F.sum("total_amount").cast("decimal(28,2)").alias("total_amount"),
            F.sum("txn_count").alias("txn_count"),
            F.max("max_amount").alias("max_amount"),
        )
    )
    average = F.col("total_amount").cast("decimal(38,6)") / F.col("txn_count").cast("decimal(20,0)")
    return merged.select(
        "date_key", "merchant_id", "total_amount", "txn_count", average.cast("decimal(22,6)").alias("avg_amount"), "max_amount"
    )
