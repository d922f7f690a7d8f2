"""Silver job: Bronze -> dedup -> types -> critical nulls -> cleaning -> Silver."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import PARTITION_COLUMNS, PAYMENT_COLUMNS
from ledgerlake.operators.dedup import keep_first, not_seen_elsewhere
from ledgerlake.plans.bronze import BATCH_COLUMN
from ledgerlake.operators.enrich import with_partition_columns
from ledgerlake.operators.refine import clean_strings, drop_critical_nulls, standardize_types
from ledgerlake.plans.settlement import log_changes
from ledgerlake.session import require_utc
from ledgerlake.sinks.manifest import read_committed
from ledgerlake.sinks.parquet import write_day, write_partitioned
from ledgerlake.sources.tables import path_exists, read_partitioned


KEY = "transaction_id"


def first_copies(bronze: DataFrame, dedup_strategy: str = "window") -> DataFrame:
    """The first copy of every transaction."""
    df = with_partition_columns(bronze.drop(BATCH_COLUMN))
    return keep_first(df, KEY, "event_time", strategy=dedup_strategy, ties=list(PAYMENT_COLUMNS))


def refined(copies: DataFrame) -> DataFrame:
    return clean_strings(drop_critical_nulls(standardize_types(copies)))


def silver_transform(bronze: DataFrame, dedup_strategy: str = "window") -> DataFrame:
    """The Silver plan, in the surveyed order.

    Dedup runs before the critical-null drop, so a transaction whose first
    copy has a critical null is dropped entirely (reproduced on purpose).
    """
    return refined(first_copies(bronze, dedup_strategy))


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    mode: str = "overwrite",
    dedup_strategy: str = "window",
    keys_path: str | None = None,
    keys_days: int | None = None,
    manifest_path: str | None = None,
    changes_path: str | None = None,
) -> None:
    """Refine one day (or everything) of Bronze into Silver.

    Default ``mode="overwrite"`` is idempotent. One day: that day's folder is
    replaced as a whole, also when nothing is left of it; a day without a
    Bronze folder is an error. Everything: the days written are replaced
    (dynamic partition overwrite). ``"append"`` reproduces the surveyed job.

    ``keys_path``: a table of the transaction ids that each day has taken
    (one folder per day), so that an id repeated on another day, in whatever
    run, enters Silver once: with the day that was refined first (in order of
    days that is its first copy). Running a day again gives up its own ids
    and takes them anew. ``keys_days`` bounds the table that is read to so
    many days before and after the day (default: all of it).
    ``manifest_path``: read committed Bronze batches only. ``changes_path``:
    log the days written, for :mod:`ledgerlake.plans.settlement`.
    """
    require_utc(spark)
    if bronze_path.rstrip("/") == silver_path.rstrip("/"):
        raise ValueError("Bronze and Silver paths must differ")
    if manifest_path:
        bronze = read_committed(spark, bronze_path, manifest_path, year, month, day, missing="error")
    else:
        bronze = read_partitioned(spark, bronze_path, year, month, day, missing="error")
    copies = first_copies(bronze, dedup_strategy)
    _refine_and_write(spark, copies, silver_path, year, month, day, mode, keys_path, keys_days)
    if changes_path:
        # After the write: a day is noted once its rows are there.
        if year is not None:
            days = spark.createDataFrame([(int(year), int(month), int(day))], "year int, month int, day int")
        else:
            days = spark.read.parquet(silver_path).select(*PARTITION_COLUMNS).distinct()
        log_changes(spark, changes_path, days)


def _refine_and_write(spark, copies: DataFrame, silver_path, year, month, day, mode, keys_path, keys_days) -> None:
    if keys_path is None:
        _write(refined(copies), silver_path, year, month, day, mode)
        return
    if year is not None:
        copies = not_seen_elsewhere(copies, taken_ids(spark, keys_path, year, month, day, keys_days), KEY)
    copies = copies.persist(StorageLevel.MEMORY_AND_DISK)  # both writes read it
    try:
        # The ids first: if the job ends between the two writes, its next run takes the same ids again.
        ids = copies.filter(F.col(KEY).isNotNull()).select(KEY, *PARTITION_COLUMNS)
        _write(ids, keys_path, year, month, day, "overwrite")
        _write(refined(copies), silver_path, year, month, day, mode)
    finally:
        copies.unpersist()


def taken_ids(
    spark: SparkSession, keys_path: str, year: int, month: int, day: int, days: int | None = None
) -> DataFrame:
    """Ids that other days have taken; with ``days`` only the folders of days so near are listed."""
    own = date(int(year), int(month), int(day))
    if days is None:
        if not path_exists(spark, keys_path):
            return spark.createDataFrame([], f"{KEY} string")
        own_day = (F.col("year") == own.year) & (F.col("month") == own.month) & (F.col("day") == own.day)
        return spark.read.parquet(keys_path).filter(~own_day).select(KEY)
    near = [own + timedelta(days=k) for k in range(-days, days + 1) if k]
    leaves = [f"{keys_path.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}" for d in near]
    leaves = [x for x in leaves if path_exists(spark, x)]
    return spark.read.parquet(*leaves).select(KEY) if leaves else spark.createDataFrame([], f"{KEY} string")


def _write(silver: DataFrame, silver_path: str, year, month, day, mode: str) -> None:
    if year is not None and mode == "overwrite":
        write_day(silver, silver_path, year, month, day)
        return
    if year is None:
        # Dedup left every task holding every day. A rebalance by day gives
        # about one file per day and splits a hot day, without a sampling pass.
        silver = silver.hint("rebalance", *PARTITION_COLUMNS)
    write_partitioned(silver, silver_path, mode=mode)
