"""Bronze stage: decoded payments -> flags -> routes -> sinks.

:func:`enrich` is the whole row-level plan (lazy). :func:`process_batch` is
one micro-batch (or one batch run over a table): it persists the routed
frame once, takes every count in a single aggregate, and writes each sink
from the cached rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.config import DEFAULT_CONFIG, PipelineConfig
from ledgerlake.operators.enrich import with_currency_check, with_event_time, with_partition_columns
from ledgerlake.operators.routing import (
    dead_letter_rows,
    unparseable_rows,
    valid_rows,
    with_route,
)
from ledgerlake.operators.rules import FraudDetector
from ledgerlake.session import require_utc
from ledgerlake.sinks.manifest import ATTEMPT_COLUMN, commit_batch, committed_batch
from ledgerlake.sinks.messages import to_messages, write_messages
from ledgerlake.sinks.parquet import write_json, write_partitioned
from ledgerlake.sources.transport import FAULTS

# Columns that are routing state, not Bronze data.
ROUTING_COLUMNS = ("is_fraud", "is_invalid", "route")
# The message as it came, for the structural dead letter.
PAYLOAD_COLUMNS = ("raw_value", FAULTS)
# Partition column of the replay-safe Bronze layout (dropped by Silver).
BATCH_COLUMN = ATTEMPT_COLUMN


def enrich(payments: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Parse, partition columns, currency check, rules, route label (lazy at every size).

    With ``decode_faults`` in the input, an event time that does not parse is
    one more fault, and faulty rows go to the structural dead letter.
    """
    require_utc(payments.sparkSession)
    df = with_event_time(payments, cfg.ts_format)
    if FAULTS in df.columns:
        fault = F.struct(F.lit("ts_event").alias("field"), F.col("ts_event").alias("value"))
        bad_time = F.col("event_time").isNull() & F.col("ts_event").isNotNull()
        df = df.withColumn(FAULTS, F.when(bad_time, F.array_append(FAULTS, fault)).otherwise(F.col(FAULTS)))
    df = with_partition_columns(df)
    df = with_currency_check(df, cfg.valid_currencies)
    df = FraudDetector.from_config(cfg).apply(df)
    return with_route(df, cfg.null_policy)


def bronze_rows(routed: DataFrame) -> DataFrame:
    """Valid rows in the Bronze layout (country, flags and reasons kept)."""
    return valid_rows(routed).drop(*ROUTING_COLUMNS, *PAYLOAD_COLUMNS)


def dead_letter_messages(routed: DataFrame) -> DataFrame:
    """Flagged or invalid rows as (card key, JSON value) messages."""
    return to_messages(dead_letter_rows(routed).drop(*PAYLOAD_COLUMNS), exclude=("route",))


def structural_dead_letter(routed: DataFrame, batch_id: int) -> DataFrame:
    """Rows whose timestamp or another field did not parse, with the raw payload and their faults kept."""
    cols = list(C.PAYMENT_COLUMNS) + ["event_time"] + [c for c in PAYLOAD_COLUMNS if c in routed.columns]
    return unparseable_rows(routed).select(*cols, F.lit(batch_id).cast("long").alias("batch_id"))


@dataclass(frozen=True)
class BronzeTargets:
    bronze_path: str
    # Root of the structural dead letter; without it unparseable rows would go nowhere.
    structural_path: str
    dead_letter_transport: str = "kafka"
    dead_letter_topic: str = "payments.deadletter"
    dead_letter_bootstrap: str | None = None
    dead_letter_path: str | None = None  # folder when transport == "file"
    # Replay-safe Bronze: partition by year/month/day/bronze_batch and
    # overwrite dynamically, so a replayed micro-batch replaces its own files
    # instead of appending them again.
    replay_safe: bool = False
    # Exactly once: every attempt of a batch writes under a name of its own,
    # and the manifest at this path tells which attempt counts
    # (``ledgerlake.sinks.manifest.read_committed``).
    manifest_path: str | None = None
    # Rows behind the watermark of a stateful stream (JSON, payload kept).
    late_path: str | None = None
    # Rows per Bronze write task: the writers are coalesced (no shuffle) to
    # ceil(rows / rows_per_task) tasks, so a small batch does not leave one
    # small file per day per input task. These are the rows of the batch, not
    # only the valid ones: a writer reads all rows of its part of the batch
    # cache, however few it keeps. Message sinks write one file per task and
    # keep their tasks.
    rows_per_task: int = 1_000_000

    def __post_init__(self):
        if not self.structural_path:
            raise ValueError("structural_path is required: unparseable rows are written there")
        if self.manifest_path and self.replay_safe:
            raise ValueError("choose replay_safe or manifest_path")
        if self.manifest_path and self.dead_letter_transport != "file":
            raise ValueError("a manifest covers file sinks only; messages to a broker are sent at least once")


def batch_folder(root: str, run_id: str, batch_id: int) -> str:
    """Output folder of one batch of one run.

    Batch ids start at 0 again with every new checkpoint, so a batch is known
    by the run (the stream's own id, kept in its checkpoint) and its number:
    a replay finds its folder again, another run never does.
    """
    return f"{root}/run={run_id}/batch={batch_id}"


def process_batch(
    batch: DataFrame,
    batch_id: int,
    targets: BronzeTargets,
    cfg: PipelineConfig = DEFAULT_CONFIG,
    run_id: str | None = None,
    late: DataFrame | None = None,
) -> dict:
    """Route one batch to Bronze, the dead letter and the structural dead letter.

    Returns the batch counts and, as ``partitions``, the valid rows per
    (year, month, day); both come from one aggregate. An empty batch writes
    nothing. ``run_id``: of the stream, or of a batch job that may be
    repeated; by default a new one, so that nothing earlier is overwritten.

    ``late``: rows of the batch that came behind the watermark; they are
    written to ``targets.late_path``, counted and not routed.

    With a manifest, a batch that is committed already is not written again
    (its counts are returned, ``replayed``), and readers see none of an
    uncommitted one.

    The routed rows are persisted once; parallelism is the source's (Kafka:
    ``minPartitions``).
    """
    run_id = run_id or uuid.uuid4().hex
    spark = batch.sparkSession
    if targets.manifest_path:
        done = committed_batch(spark, targets.manifest_path, run_id, batch_id)
        if done is not None:
            return done | {"replayed": True}
    routed = enrich(batch, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {"received": 0, "unparseable": 0, "valid": 0, "dead_letter": 0, "unrouted": 0}
        partitions = []
        # One row per route and day of the batch.
        for r in routed.groupBy("route", *C.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n")).collect():
            counts["received"] += r.n
            counts[r.route] += r.n
            if r.route == C.ROUTE_VALID:
                partitions.append({"year": r.year, "month": r.month, "day": r.day, "row_count": r.n})
        counts |= {"batch_id": batch_id, "run_id": run_id}
        attempt = f"{run_id}-{batch_id}-{uuid.uuid4().hex[:12]}"
        counts["partitions"] = sorted(partitions, key=lambda x: (x["year"], x["month"], x["day"]))

        if counts["valid"]:
            rows = bronze_rows(routed).coalesce(max(1, -(-counts["received"] // max(1, targets.rows_per_task))))
            if targets.manifest_path:
                write_partitioned(
                    rows.withColumn(BATCH_COLUMN, F.lit(attempt)),
                    targets.bronze_path,
                    mode="append",
                    partition_by=C.PARTITION_COLUMNS + (BATCH_COLUMN,),
                )
            elif targets.replay_safe:
                rows = rows.withColumn(BATCH_COLUMN, F.lit(f"{run_id}-{batch_id}"))
                write_partitioned(
                    rows, targets.bronze_path, mode="overwrite", partition_by=C.PARTITION_COLUMNS + (BATCH_COLUMN,)
                )
            else:
                write_partitioned(rows, targets.bronze_path, mode="append")
        if counts["dead_letter"]:
            path = targets.dead_letter_path
            write_messages(
                dead_letter_messages(routed),
                targets.dead_letter_transport,
                topic=targets.dead_letter_topic,
                bootstrap=targets.dead_letter_bootstrap,
                path=batch_folder(path, run_id, batch_id) if path else None,
                mode="overwrite",
            )
        if counts["unparseable"]:
            # One folder per batch, overwritten: a replayed batch rewrites it.
            write_json(
                structural_dead_letter(routed, batch_id),
                batch_folder(targets.structural_path, run_id, batch_id),
                mode="overwrite",
            )
        if late is not None:
            counts["late"] = late.count()
            counts["received"] += counts["late"]
            if counts["late"]:
                write_json(late, batch_folder(targets.late_path, run_id, batch_id), mode="overwrite")
        if targets.manifest_path and counts["received"]:
            commit_batch(spark, targets.manifest_path, run_id, batch_id, attempt, counts)
        return counts
    finally:
        routed.unpersist()
