"""Commit manifest of micro-batches: which write of a batch counts.

A batch names every attempt anew and writes its rows under that name. Once
all its sinks are written, one row is put under ``run=<id>/batch=<n>`` of the
manifest; the file appears there by a rename, so a batch is committed or not.
Readers keep the rows of committed attempts only: what a failed attempt left
is never seen, and a batch found committed is not written again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.tables import path_exists, read_partitioned

#: Partition column of the Bronze rows that carries the attempt's name.
ATTEMPT_COLUMN = "bronze_batch"
SCHEMA = "attempt string, counts string, run string, batch long"


def _folder(root: str, run_id: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/run={run_id}/batch={batch_id}"


def commit_batch(spark: SparkSession, root: str, run_id: str, batch_id: int, attempt: str, counts: dict) -> None:
    row = spark.createDataFrame([(attempt, json.dumps(counts))], "attempt string, counts string")
    row.coalesce(1).write.mode("overwrite").json(_folder(root, run_id, batch_id))


def committed_batch(spark: SparkSession, root: str, run_id: str, batch_id: int) -> dict | None:
    """The counts of a batch that is committed, else None."""
    folder = _folder(root, run_id, batch_id)
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        return None
    return json.loads(spark.read.schema("attempt string, counts string").json(folder).first().counts)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed batch: run, batch, attempt and its counts as JSON."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(root)


def read_committed(
    spark: SparkSession,
    bronze_path: str,
    manifest_path: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    missing: str = "empty",
) -> DataFrame:
    """Bronze rows of committed attempts, all or of one day.

    A semi join on the attempt, which is a partition column: Spark prunes the
    folders of other attempts while the query runs.
    """
    rows = read_partitioned(spark, bronze_path, year, month, day, missing=missing)
    attempts = read_manifest(spark, manifest_path).select(F.col("attempt").alias(ATTEMPT_COLUMN))
    return rows.join(attempts, ATTEMPT_COLUMN, "left_semi").drop(ATTEMPT_COLUMN)


def only_committed(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of per-batch folders (``run=``/``batch=`` columns) whose batch is committed."""
    return rows.join(manifest.select("run", "batch"), ["run", "batch"], "left_semi")
