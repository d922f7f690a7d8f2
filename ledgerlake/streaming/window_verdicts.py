"""Window rules decided inside the stream (window scope ``stateful``).

Rows wait until the longest rule window around them has closed, that is until
the watermark has passed its end; then they are emitted once, with the flags
of every window rule over all rows of the stream, whatever the micro-batches
were:

    rows ── window, card, shortest bucket ── aggregates in state ── closed buckets ─┐
    rows ── files of their batch ── rows whose window closed ───────── join ────────┴─ flagged rows

The stream's state holds one row per (card, window, shortest bucket) of the
open windows; payments do not go through it. A batch is written once
(:func:`hold`): its buckets that closed, its payments that wait, and those
that are ready. The window ends between the watermarks of the batch before
and of this batch are those that this batch closes, in the state and in the
files alike, so a replayed batch finds the same rows. Rows that come behind
the watermark, and rows that belong to no window (no card or no event time),
do not wait. :func:`settled_payments` and :func:`late_rows` together return
every row once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.config import DEFAULT_CONFIG, PipelineConfig
from ledgerlake.functions import bucket_end, bucket_start, country_of, duration_micros, parse_event_time
from ledgerlake.operators.rules import rules_from_config
from ledgerlake.operators.windows import _named_aggs, flag_by_buckets, rolled_up
from ledgerlake.sources.tables import create_marker, delete_folder, folder_markers, path_exists

#: Helper columns of a batch: is the row ready, the end of its longest window, and in rows that are no payments a closed bucket.
SETTLED, WINDOW_END, BUCKET = "_settled", "_window_end", "_bucket"
#: The parts of a batch that was held, and the file that names the last window end its payments wait for.
PART, WAITING, READY, BUCKETS, LAST = "part", "waiting", "ready", "buckets", "last"


def window_rules(cfg: PipelineConfig) -> list:
    return [r for r in rules_from_config(cfg) if r.windowed]


def longest_window(rules: list) -> str:
    """The longest duration; every other must divide it and be made of the shortest one."""
    longest = max((r.duration for r in rules), key=duration_micros)
    if rolled_up(rules) is None or any(duration_micros(longest) % duration_micros(r.duration) for r in rules):
        raise ValueError("window scope 'stateful' needs mergeable rules whose durations nest in the longest one")
    return longest


def with_stream_windows(decoded: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, watermark: str = "10 minutes") -> DataFrame:
    """A stream of decoded payments with ``SETTLED`` and ``WINDOW_END``, and of the buckets of windows that closed.

    Append mode. A payment comes once, as it arrives, settled if it belongs to
    no window; a row with ``BUCKET`` holds the window rules' aggregates of one
    card and shortest bucket, once its longest window has closed. The source
    is read by both branches.
    """
    rules = window_rules(cfg)
    at = parse_event_time("ts_event", cfg.ts_format)
    if not rules:
        return decoded.withColumns({SETTLED: F.lit(True), WINDOW_END: F.lit(None).cast("timestamp")})
    longest, base = longest_window(rules), rolled_up(rules)
    # Null if the payment belongs to no window. F.window leaves those out above the
    # watermark; a filter below it would be pushed down and parse every message again.
    timed = decoded.withColumn("_at", F.when(F.col("card_hash").isNotNull(), at))
    buckets = (
        timed.withWatermark("_at", watermark)
        .withColumn("country", country_of("location"))
        .groupBy(F.window("_at", longest), F.col("card_hash").alias("_wk_card"), bucket_start("_at", base).alias("_wk_bkt"))
        .agg(*[a.alias(n) for n, a in _named_aggs(rules).items()])
    )
    closed = buckets.select(F.struct("_wk_card", "_wk_bkt", *_named_aggs(rules)).alias(BUCKET))
    end = F.when(F.col("card_hash").isNotNull(), bucket_end(bucket_start(at, longest), longest))
    arriving = decoded.withColumn(WINDOW_END, end).withColumn(SETTLED, F.col(WINDOW_END).isNull())
    return arriving.unionByName(closed, allowMissingColumns=True)


def hold(batch: DataFrame, root: str, batch_id: int, watermark_millis: int) -> None:
    """Write a batch by its parts, in one run of the stream's plan; a replayed batch is written anew.

    ``watermark_millis``: behind it rows are late. Folders whose payments all
    wait for windows behind it are deleted: batches before this one, which
    have ended, settled them.
    """
    spark = batch.sparkSession
    folder = f"{root}/batch={batch_id}"
    for name, last in folder_markers(spark, root, LAST).items():
        if int(last) <= watermark_millis * 1000:
            delete_folder(spark, f"{root}/{name}")
    part = F.when(F.col(SETTLED) | _closed(watermark_millis), READY).otherwise(WAITING)
    if BUCKET in batch.columns:
        part = F.when(F.col(BUCKET).isNotNull(), BUCKETS).otherwise(part)
    batch = batch.withColumn(PART, part)
    if "raw_value" in batch.columns and "decode_faults" in batch.columns:
        # A payload waits only if a later stage writes it: with a fault in it.
        needed = (F.col(PART) != WAITING) | (F.size("decode_faults") > 0)
        batch = batch.withColumn("raw_value", F.when(needed, F.col("raw_value")))
    batch.write.mode("overwrite").partitionBy(PART).parquet(folder)
    waiting = _held(spark, f"{WINDOW_END} timestamp", [f"{folder}/{PART}={WAITING}"])
    last = waiting.agg(F.max(F.unix_micros(WINDOW_END))).first()[0]
    create_marker(spark, f"{folder}/{LAST}={last or 0}")


def _held(spark: SparkSession, schema, folders: list[str]) -> DataFrame:
    """The rows of those folders that exist."""
    found = [f for f in folders if path_exists(spark, f)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def ready_rows(spark: SparkSession, schema, root: str, batch_id: int, watermark_millis: int) -> DataFrame:
    """The payments of a held batch (columns ``schema``) that do not wait: those of no window, and late ones."""
    held = _held(spark, schema, [f"{root}/batch={batch_id}/{PART}={READY}"])
    return settled_or_late(held.drop(BUCKET), watermark_millis)


def settled_payments(
    spark: SparkSession, schema, root: str, batch_id: int, watermarks: tuple[int, int], cfg: PipelineConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The payments of all held batches whose verdict this batch decides, with their window flags.

    ``watermarks``: of the batch before and of this batch.
    """
    rules = window_rules(cfg)
    behind, reached = watermarks
    ready = settled_rows(ready_rows(spark, schema, root, batch_id, behind))
    settled = ready.withColumns({r.flag: F.lit(False) for r in rules})
    if not rules or reached <= behind:
        return settled
    still = [name for name, last in folder_markers(spark, root, LAST).items() if int(last) > behind * 1000]
    waiting = _held(spark, schema, [f"{root}/{name}/{PART}={WAITING}" for name in still])
    waiting = waiting.filter(~_closed(behind) & _closed(reached)).drop(SETTLED, WINDOW_END, BUCKET)
    buckets = _held(spark, schema, [f"{root}/batch={batch_id}/{PART}={BUCKETS}"]).select(f"{BUCKET}.*")
    timed = waiting.withColumn("_at", parse_event_time("ts_event", cfg.ts_format))
    return settled.unionByName(flag_by_buckets(timed, buckets, rules, time_col="_at").drop("_at"))


def settled_rows(batch: DataFrame) -> DataFrame:
    """The rows of a batch whose verdict is final."""
    return batch.filter(SETTLED).drop(SETTLED, WINDOW_END)


def _closed(watermark_millis: int) -> Column:
    return F.col(WINDOW_END) <= F.timestamp_millis(F.lit(watermark_millis))


def settled_or_late(batch: DataFrame, watermark_millis: int) -> DataFrame:
    """A batch without the rows that have only arrived and now wait."""
    return batch.filter(F.col(SETTLED) | _closed(watermark_millis))


def late_rows(batch: DataFrame, watermark_millis: int, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    """The rows that arrived after their window had closed: the stream's state dropped them."""
    return batch.filter(~F.col(SETTLED) & _closed(watermark_millis)).drop(SETTLED, *[r.flag for r in window_rules(cfg)])


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark (milliseconds) behind which a batch's rows are late: that of the batch before.

    Read from the stream's own offset log, so a replayed batch, also after a
    restart, finds the same one.
    """
    log = f"{checkpoint}/offsets/{batch_id - 1}"
    if batch_id == 0 or not path_exists(spark, log):
        return 0
    # The file's second line holds the settings of the batch.
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(log)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        lines = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    finally:
        stream.close()
    return int(json.loads(lines[1])["batchWatermarkMs"])
