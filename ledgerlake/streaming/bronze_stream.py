"""The Bronze streaming query: one query, every sink inside ``foreachBatch``.

raw messages -> decode (PERMISSIVE, raw payload kept) -> per micro-batch:
persist -> parse -> rules -> route -> Bronze Parquet / dead-letter messages /
structural dead letter. Progress is in the checkpoint, so a restarted query
resumes at the first uncommitted batch; a replayed batch appends Bronze
again (Silver's dedup absorbs it) and rewrites its dead-letter folders,
which carry the stream's own id, so that another run on the same folders
never touches them.

With the window scope ``micro_batch`` windowed rules see only the rows of
their micro-batch, as in the surveyed pipeline. With ``stateful`` a row waits
beside the stream's state, in files under its checkpoint, until its windows
have closed and is routed by all rows of the stream
(:mod:`ledgerlake.streaming.window_verdicts`); rows behind the watermark go
to ``targets.late_path``. :mod:`ledgerlake.streaming.alerts`
reports windows, without waiting, as soon as they change.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.config import DEFAULT_CONFIG, PipelineConfig
from ledgerlake.plans.bronze import BronzeTargets, process_batch
from ledgerlake.sources.transport import decode_payload
from ledgerlake.streaming.window_verdicts import (
    hold,
    late_rows,
    late_watermark,
    ready_rows,
    settled_payments,
    with_stream_windows,
)

#: Folder of the rows that wait, in the checkpoint of a stateful stream.
WAITING_FOLDER = "waiting"


def start_bronze_stream(
    spark: SparkSession,
    raw: DataFrame,
    targets: BronzeTargets,
    checkpoint: str,
    cfg: PipelineConfig = DEFAULT_CONFIG,
    *,
    available_now: bool = False,
    query_name: str | None = None,
    watermark: str = "10 minutes",
    on_batch: Callable[[dict], None] | None = None,
) -> StreamingQuery:
    """Start the query over a raw ``key, value`` stream.

    ``available_now=True`` processes what is there and stops (tests, backfill);
    otherwise it triggers every ``cfg.trigger_interval``. ``watermark`` (scope
    ``stateful``): how far behind the newest event time a row may come; rows
    whose windows are still open when the query stops stay in its checkpoint.
    """
    if cfg.window_scope == "table":
        raise ValueError("window scope 'table' needs a static table; use 'micro_batch' or 'stateful' for a stream")
    stateful = cfg.window_scope == "stateful"
    if stateful and not targets.late_path:
        raise ValueError("window scope 'stateful' needs a late_path: rows behind the watermark are written there")
    decoded = decode_payload(raw, keep_raw=True, faults=True)
    rows = with_stream_windows(decoded, cfg, watermark) if stateful else decoded
    run_ids: list[str] = []

    def _batch(batch_df: DataFrame, batch_id: int) -> None:
        if not run_ids:
            run_ids.append(stream_id(spark, checkpoint))
        if not stateful:
            counts = process_batch(batch_df, batch_id, targets, cfg, run_id=run_ids[0])
        else:
            # The batch's own offsets are logged before it runs: the watermark up to which it closes windows.
            behind, reached = (late_watermark(spark, checkpoint, n) for n in (batch_id, batch_id + 1))
            waiting = f"{checkpoint}/{WAITING_FOLDER}"
            hold(batch_df, waiting, batch_id, behind)
            late = late_rows(ready_rows(spark, batch_df.schema, waiting, batch_id, behind), behind, cfg)
            settled = settled_payments(spark, batch_df.schema, waiting, batch_id, (behind, reached), cfg)
            counts = process_batch(settled, batch_id, targets, cfg, run_id=run_ids[0], late=late)
        if on_batch is not None:
            on_batch(counts)

    writer = rows.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream and keeps in its checkpoint, over all restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
