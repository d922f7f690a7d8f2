"""Partitioned Parquet and JSON writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.config import PARTITION_COLUMNS


def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: tuple[str, ...] = PARTITION_COLUMNS,
    dynamic: bool = True,
) -> None:
    """Write a year/month/day-partitioned Parquet table.

    ``mode="overwrite"`` uses dynamic partition overwrite (passed as a write
    option, so the session setting is untouched): only the days present in
    ``df`` are replaced, which makes re-running a day idempotent.
    Rows are sorted by the partition keys inside each task so every task
    keeps one open file at a time. ``dynamic=False`` replaces the whole table.
    """
    writer = df.sortWithinPartitions(*partition_by).write.partitionBy(*partition_by)
    if mode == "overwrite":
        kind = "dynamic" if dynamic else "static"
        writer = writer.mode("overwrite").option("partitionOverwriteMode", kind)
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    writer.parquet(path)


def write_day(df: DataFrame, root: str, year: int, month: int, day: int) -> None:
    """Replace one day's folder by ``df`` (rows of that day), also if ``df`` is empty."""
    leaf = f"{root.rstrip('/')}/year={int(year)}/month={int(month)}/day={int(day)}"
    df.drop(*PARTITION_COLUMNS).write.mode("overwrite").parquet(leaf)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; null fields are omitted by the writer."""
    df.write.mode(mode).json(path)
