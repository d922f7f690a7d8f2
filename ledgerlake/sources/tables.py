"""Batch readers: driver tables and partition-scoped medallion tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partition_filter(year: int | None, month: int | None, day: int | None):
    """Predicate on the Hive partition columns, or ``None`` for the whole table.

    All three of year, month and day, or none: a partial date is an error
    (the surveyed job silently read everything instead).
    """
    given = [v is not None for v in (year, month, day)]
    if any(given) and not all(given):
        raise ValueError("give all of year, month and day, or none of them")
    if not any(given):
        return None
    return (F.col("year") == int(year)) & (F.col("month") == int(month)) & (F.col("day") == int(day))


def read_partitioned(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    missing: str = "empty",
) -> DataFrame:
    """Read a year/month/day-partitioned Parquet table, optionally one day.

    For one day only that day's folder is listed (read with ``basePath``, so
    year/month/day stay columns) instead of discovering every partition of
    the table; the partition filter is applied as well, so the scan shows
    ``PartitionFilters``. A day without a folder yields no rows, or with
    ``missing="error"`` (the jobs) fails: an absent upstream day or a wrong
    date must not look like success.
    """
    if missing not in ("empty", "error"):
        raise ValueError(f"unknown missing={missing!r}")
    cond = partition_filter(year, month, day)
    if cond is None:
        return spark.read.parquet(root)
    leaf = f"{root.rstrip('/')}/year={int(year)}/month={int(month)}/day={int(day)}"
    if path_exists(spark, leaf):
        return spark.read.option("basePath", root).parquet(leaf).filter(cond)
    if missing == "error":
        raise FileNotFoundError(f"no partition {leaf}")
    return spark.read.parquet(root).filter(cond)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def partition_values(spark: SparkSession, root: str, column: str, marker: str = "") -> list[str]:
    """Values of the folders ``column=<value>`` under ``root``, sorted; with ``marker``, of those that hold such a file.

    One glob through the cluster's Hadoop file system: names only, no data file is listed.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{column}=*/{marker}".rstrip("/"))
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    folders = [(f.getPath().getParent() if marker else f.getPath()).getName() for f in found or []]
    return sorted(name.split("=", 1)[1] for name in folders)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p).close()


def folder_markers(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """Folder -> value of the file ``name=<value>`` in it, for the folders under ``root`` that hold one (one glob)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/{name}=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    paths = [f.getPath() for f in found or []]
    return {f.getParent().getName(): f.getName().split("=", 1)[1] for f in paths}
