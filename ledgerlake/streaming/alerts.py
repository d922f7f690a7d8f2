"""Card alerts over event-time state (window rules across micro-batches).

One streaming aggregation ``withWatermark(event_time) -> groupBy(window,
card)`` keeps the mergeable aggregates of each (card, window) in the state
store; the watermark bounds the state. The query runs in ``update`` mode so
an open window is reported as soon as it changes; every batch's updated
windows are written under ``window_date=<d>/batch_id=<n>`` (dynamic
overwrite: a replayed batch rewrites exactly its own folders), and
:func:`read_card_alerts` keeps the latest version of each window and returns
those that fire. A long-running stream adds a batch folder every trigger;
reading one day lists only that day's folders. Once the watermark has passed
the last window of a date, the running query closes the date: the latest
version of its windows goes to ``closed/`` and its batch folders are deleted,
so only open dates hold versions.

Rows behind the watermark change no window any more. With a ``late_path`` they
are written there, payment by payment.

When every rule duration is a multiple of the shortest one and every rule
says how its aggregates merge (``WindowRule.rollup``), a single query keeps
state per (card, shortest bucket) only -- one read of the source, one state
store -- and the reader rolls the buckets up into each rule's windows
(epoch-aligned buckets nest exactly). Otherwise one query per duration runs.
"""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.config import DEFAULT_CONFIG, REASON_SEPARATOR, PipelineConfig
from ledgerlake.functions import bucket_end, bucket_start, country_of, duration_micros, parse_event_time, reasons_of
from ledgerlake.operators.rules import rules_from_config
from ledgerlake.operators.windows import _MERGE, _group_by_duration, _named_aggs, rolled_up, shuffle_side
from ledgerlake.plans.bronze import batch_folder
from ledgerlake.session import write_scratch_table
from ledgerlake.sinks.parquet import write_json
from ledgerlake.sources.tables import delete_folder, partition_values, path_exists
from ledgerlake.streaming.bronze_stream import stream_id
from ledgerlake.streaming.window_verdicts import WINDOW_END, late_watermark

ROLLUP_FOLDER = "buckets"
# Below the alerts' folder: closed dates, each with Spark's marker of a finished write.
CLOSED_FOLDER = "closed"
MARKER = "_SUCCESS"
#: Helper column of a batch: a payment as it came, beside the updated windows.
ARRIVED = "_arrived"
DAY_MICROS = 86_400_000_000
WINDOW_KEY = ("card_hash", "window_start", "window_end")


def window_rule_groups(cfg: PipelineConfig = DEFAULT_CONFIG) -> list[list]:
    rules = [r for r in rules_from_config(cfg) if r.windowed]
    return list(_group_by_duration(rules).values())


def rollup_duration(cfg: PipelineConfig = DEFAULT_CONFIG) -> str | None:
    """The shortest rule duration if one stateful query can serve every rule."""
    rules = [r for g in window_rule_groups(cfg) for r in g]
    return rolled_up(rules) if rules else None


def _event_rows(decoded: DataFrame, cfg: PipelineConfig, watermark: str) -> DataFrame:
    return (
        decoded.withColumn("event_time", parse_event_time("ts_event", cfg.ts_format))
        .filter(F.col("event_time").isNotNull() & F.col("card_hash").isNotNull())
        .withColumn("country", country_of("location"))
        .withWatermark("event_time", watermark)
    )


def _window_aggregates(rows: DataFrame, rules: list, duration: str) -> DataFrame:
    aggs = _named_aggs(rules)
    return rows.groupBy(F.window("event_time", duration).alias("w"), "card_hash").agg(
        *[a.alias(n) for n, a in aggs.items()]
    )


def _flags(group: list, col) -> dict:
    return {
        r.flag: F.coalesce(r.predicate(lambda n, r=r: col(f"_wa_{r.flag}_{n}")), F.lit(False)) for r in group
    }


def card_window_updates(decoded: DataFrame, group: list, cfg: PipelineConfig, watermark: str) -> DataFrame:
    """Streaming (card, window) aggregates of one rule group, with its flags."""
    agg = _window_aggregates(_event_rows(decoded, cfg, watermark), group, group[0].duration)
    return agg.select(
        "card_hash",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *[c.alias(n) for n, c in _flags(group, F.col).items()],
    )


def card_bucket_updates(decoded: DataFrame, cfg: PipelineConfig, watermark: str) -> DataFrame:
    """Streaming (card, shortest bucket) partial aggregates of every rule."""
    rules = [r for g in window_rule_groups(cfg) for r in g]
    agg = _window_aggregates(_event_rows(decoded, cfg, watermark), rules, rollup_duration(cfg))
    return agg.select(
        "card_hash",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *_named_aggs(rules).keys(),
    )


def _with_arrivals(updates: DataFrame, decoded: DataFrame, cfg: PipelineConfig, duration: str) -> DataFrame:
    """The updated windows and, beside them, every payment as it comes with the end of its window.

    The second branch keeps no state; the source is read by both.
    """
    at = parse_event_time("ts_event", cfg.ts_format)
    arrivals = decoded.filter(at.isNotNull() & F.col("card_hash").isNotNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in updates.schema.fields],
        F.struct(*decoded.columns).alias(ARRIVED),
        bucket_end(bucket_start(at, duration), duration).alias(WINDOW_END),
    )
    none = {f.name: F.lit(None).cast(f.dataType) for f in arrivals.schema.fields if f.name in (ARRIVED, WINDOW_END)}
    return updates.withColumns(none).unionByName(arrivals)


def _last_window_end(date: str, duration: str) -> int:
    """End (microseconds) of the last window that starts on a date."""
    day = (Date.fromisoformat(date) + timedelta(days=1) - Date(1970, 1, 1)).days * DAY_MICROS
    micros = duration_micros(duration)
    return -(-day // micros) * micros


def close_alert_dates(spark: SparkSession, target: str, duration: str, watermark_millis: int) -> list[str]:
    """Close the dates whose windows all ended at or before the watermark; returns them.

    ``target``: a query's folder of versions. A date is written to its closed
    folder first and its versions are deleted only after that write is marked
    as finished; :func:`read_card_alerts` takes a date from where it is
    finished, so a close that failed anywhere is taken up again by the next.
    A reader that listed the versions just before must read again.
    """
    ready = [
        d for d in partition_values(spark, target, "window_date")
        if _last_window_end(d, duration) <= watermark_millis * 1000
    ]
    finished = set(partition_values(spark, f"{target}/{CLOSED_FOLDER}", "window_date", MARKER)) if ready else set()
    for date in ready:
        leaf = f"{target}/window_date={date}"
        if date not in finished:
            versions = spark.read.parquet(leaf)
            columns = [c for c in versions.columns if c not in (*WINDOW_KEY, "batch_id")]
            _latest_versions(versions, columns).write.mode("overwrite").parquet(
                f"{target}/{CLOSED_FOLDER}/window_date={date}"
            )
        delete_folder(spark, leaf)
    return ready


def _start(
    updates: DataFrame, decoded: DataFrame, duration: str, folder: str, out_path: str, checkpoint: str,
    cfg: PipelineConfig, available_now: bool, late_path: str | None, close_dates: bool,
) -> StreamingQuery:
    target, checkpoint = f"{out_path}/{folder}", f"{checkpoint}/{folder}"

    def _write(windows: DataFrame, batch_id: int) -> None:
        # Rebalanced by date: about one file per date instead of one per date
        # and state partition, and a date with most of the rows is split.
        (
            windows.withColumns(
                {"window_date": F.to_date("window_start"), "batch_id": F.lit(batch_id).cast("long")}
            )
            .hint("rebalance", "window_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_date", "batch_id")
            .parquet(target)
        )

    def _batch(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        passed = late_watermark(spark, checkpoint, batch_id) if late_path or close_dates else 0
        if late_path is None:
            _write(batch_df, batch_id)
        else:
            batch_df.persist(StorageLevel.MEMORY_AND_DISK)  # else the state would be asked once more for the late rows
            try:
                _write(batch_df.filter(F.col(ARRIVED).isNull()).drop(ARRIVED, WINDOW_END), batch_id)
                late = batch_df.filter(F.col(ARRIVED).isNotNull() & (F.unix_millis(WINDOW_END) <= F.lit(passed)))
                if not late.isEmpty():
                    at = batch_folder(f"{late_path}/{folder}", stream_id(spark, checkpoint), batch_id)
                    write_json(late.select(f"{ARRIVED}.*", F.col(WINDOW_END).alias("window_end")), at)
            finally:
                batch_df.unpersist()
        if close_dates:
            close_alert_dates(spark, target, duration, passed)

    if late_path is not None:
        updates = _with_arrivals(updates, decoded, cfg, duration)
    writer = updates.writeStream.outputMode("update").foreachBatch(_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()


def start_card_alerts(
    spark: SparkSession,
    decoded: DataFrame,
    out_path: str,
    checkpoint: str,
    cfg: PipelineConfig = DEFAULT_CONFIG,
    *,
    watermark: str = "1 hour",
    available_now: bool = False,
    state_store: str | None = None,
    late_path: str | None = None,
    close_dates: bool = True,
) -> list[StreamingQuery]:
    """Start the alert query (or one per duration); returns the started queries.

    Rows later than ``watermark`` are left out of the alerts; how many, the
    queries' progress tells (:func:`rows_dropped_as_late`). With ``late_path``
    each goes, with the end of the window it came too late for, as JSON under
    ``<late_path>/<query's folder>/run=<stream id>/batch=<n>``: every payment
    with a card and a time is in a window or there, and a replayed batch
    rewrites its own folder.

    ``close_dates``: dates that the watermark has passed are closed after each
    batch (:func:`close_alert_dates`).

    ``state_store="rocksdb"`` keeps the (card, window) state in RocksDB
    instead of the executor heap (many cards, long watermarks). It applies
    to new checkpoints only: the provider is recorded in the checkpoint.
    """
    if state_store not in (None, "rocksdb"):
        raise ValueError(f"unknown state store {state_store!r}")
    options = (out_path, checkpoint, cfg, available_now, late_path, close_dates)
    if state_store is None:
        return _start_all(decoded, watermark, cfg, options)
    # A query takes the session's settings when it starts, so the provider is
    # set for these queries only.
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _start_all(decoded, watermark, cfg, options)
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _start_all(decoded: DataFrame, watermark: str, cfg: PipelineConfig, options: tuple) -> list[StreamingQuery]:
    base = rollup_duration(cfg)
    if base is not None:
        return [_start(card_bucket_updates(decoded, cfg, watermark), decoded, base, ROLLUP_FOLDER, *options)]
    return [
        _start(card_window_updates(decoded, group, cfg, watermark), decoded, group[0].duration, f"group={i}", *options)
        for i, group in enumerate(window_rule_groups(cfg))
    ]


def rows_dropped_as_late(query: StreamingQuery) -> int:
    """Rows that the watermark has dropped in the progress reports that the query still holds."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"]
    )


def compact_card_alerts(spark: SparkSession, out_path: str, cfg: PipelineConfig, date: str) -> None:
    """Replace a finished date's batch folders by one with the latest version of each window.

    For a query started with ``close_dates=False``, and dates that the
    watermark has passed: the running query must not write to the date
    meanwhile. The rows are staged in the scratch folder first.
    """
    groups = window_rule_groups(cfg)
    if rollup_duration(cfg) is not None:
        folders = {ROLLUP_FOLDER: list(_named_aggs([r for g in groups for r in g]))}
    else:
        folders = {f"group={i}": [r.flag for r in g] for i, g in enumerate(groups)}
    for folder, columns in folders.items():
        leaf = f"{out_path}/{folder}/window_date={date}"
        if not path_exists(spark, leaf):
            continue
        last = spark.read.parquet(leaf).agg(F.max("batch_id")).first()[0]
        latest = _latest(spark, f"{out_path}/{folder}", columns, date).withColumn("batch_id", F.lit(last))
        staged = write_scratch_table(latest, "alerts")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(leaf)


def with_window_state(payments: DataFrame, alerts: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Decoded payments with their window flags from the alert state, for window scope "stateful".

    ``alerts``: of :func:`read_card_alerts`. One join per duration; the
    verdict is then :func:`ledgerlake.plans.bronze.enrich`'s.
    """
    at = parse_event_time("ts_event", cfg.ts_format)
    out = payments
    for group in window_rule_groups(cfg):
        flags = [r.flag for r in group]
        firing = alerts.filter(" OR ".join(flags)).select(
            F.col("card_hash").alias("_sc"), F.col("window_start").alias("_sw"), *[F.col(f).alias(f"_s_{f}") for f in flags]
        )
        bucket = bucket_start(at, group[0].duration)
        out = out.withColumn("_sb", bucket).join(
            shuffle_side(firing, unless_broadcast=True), (F.col("card_hash") == F.col("_sc")) & (F.col("_sb") == F.col("_sw")), "left"
        )
        out = out.withColumns({f: F.coalesce(f"_s_{f}", F.lit(False)) for f in flags}).drop(
            "_sb", "_sc", "_sw", *[f"_s_{f}" for f in flags]
        )
    return out


def _latest_versions(versions: DataFrame, columns: list[str]) -> DataFrame:
    """The version with the highest batch id of every (card, window)."""
    latest = versions.groupBy(*WINDOW_KEY).agg(F.max_by(F.struct(*columns), F.col("batch_id")).alias("s"))
    return latest.select(*WINDOW_KEY, *[F.col(f"s.{c}").alias(c) for c in columns])


def _latest(spark: SparkSession, folder: str, columns: list[str], date: str | None) -> DataFrame:
    """Every (card, window) as last written: closed dates as they are, of open ones the latest version."""
    finished = partition_values(spark, f"{folder}/{CLOSED_FOLDER}", "window_date", MARKER)
    versioned = [d for d in partition_values(spark, folder, "window_date") if d not in set(finished)]
    if not finished and not versioned:
        raise FileNotFoundError(f"no alerts in {folder}")
    if date is not None:
        finished, versioned = [d for d in finished if d == date], [d for d in versioned if d == date]
        if not finished and not versioned:  # no window that day: the same columns, no rows
            return _latest(spark, folder, columns, None).limit(0)
    parts = []
    if versioned:
        # Open dates are few: the watermark keeps them so.
        leaves = [f"{folder}/window_date={d}" for d in versioned]
        parts.append(_latest_versions(spark.read.option("basePath", folder).parquet(*leaves), columns))
    if finished:
        closed = f"{folder}/{CLOSED_FOLDER}"
        leaves = [f"{closed}/window_date={d}" for d in finished]
        parts.append(spark.read.option("basePath", closed).parquet(*leaves).select(*WINDOW_KEY, *columns))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_window_state(spark: SparkSession, out_path: str, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    """The aggregates of every (card, shortest window), firing or not, of a query that serves all rules."""
    if rollup_duration(cfg) is None:
        raise ValueError("these rules keep their flags only: their durations do not nest")
    columns = list(_named_aggs([r for g in window_rule_groups(cfg) for r in g]))
    return _latest(spark, f"{out_path}/{ROLLUP_FOLDER}", columns, None)


def read_card_alerts(
    spark: SparkSession,
    out_path: str,
    cfg: PipelineConfig = DEFAULT_CONFIG,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
) -> DataFrame:
    """Latest state of every (card, window) that fires at least one rule.

    Columns: card_hash, window_start, window_end, one flag per window rule
    (false where the rule belongs to another duration), alert_reasons.
    With year, month and day, only the windows starting that day are read
    (only that day's folders are listed); every rule duration must then
    divide a day, so that no window spans two dates.
    """
    from ledgerlake.sources.tables import partition_filter

    groups = window_rule_groups(cfg)
    all_rules = [r for g in groups for r in g]
    date = None
    if partition_filter(year, month, day) is not None:
        if any(DAY_MICROS % duration_micros(r.duration) for r in all_rules):
            raise ValueError("day-scoped alert reads need rule durations that divide a day")
        date = f"{int(year):04d}-{int(month):02d}-{int(day):02d}"
    parts = []
    base = rollup_duration(cfg)
    if base is not None:
        buckets = _latest(spark, f"{out_path}/{ROLLUP_FOLDER}", list(_named_aggs(all_rules)), date)
        for group in groups:
            duration = group[0].duration
            if duration_micros(duration) == duration_micros(base):
                rolled = buckets  # the buckets are this group's windows
            else:
                merged = {
                    f"_wa_{r.flag}_{name}": _MERGE[how](f"_wa_{r.flag}_{name}")
                    for r in group
                    for name, how in r.rollup
                }
                rolled = (
                    buckets.groupBy("card_hash", bucket_start("window_start", duration).alias("window_start"))
                    .agg(*[m.alias(n) for n, m in merged.items()])
                    .withColumn("window_end", bucket_end(F.col("window_start"), duration))
                )
            parts.append((group, rolled.select("card_hash", "window_start", "window_end", *[
                c.alias(n) for n, c in _flags(group, F.col).items()
            ])))
    else:
        for i, group in enumerate(groups):
            parts.append((group, _latest(spark, f"{out_path}/group={i}", [r.flag for r in group], date)))
    out = None
    for group, part in parts:
        flags = {r.flag for r in group}
        part = part.select(
            "card_hash",
            "window_start",
            "window_end",
            *[(F.col(r.flag) if r.flag in flags else F.lit(False)).alias(r.flag) for r in all_rules],
        )
        out = part if out is None else out.unionByName(part)
    return out.filter(" OR ".join(r.flag for r in all_rules)).withColumn(
        "alert_reasons", reasons_of([(F.col(r.flag), r.reason) for r in all_rules], REASON_SEPARATOR)
    )
