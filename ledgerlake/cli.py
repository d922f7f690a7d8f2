"""Command-line entry points for the jobs.

    python -m ledgerlake.cli bronze --transport kafka --bootstrap host:9092 \
        --bronze-path s3://.../bronze --checkpoint-path s3://.../checkpoints
    python -m ledgerlake.cli alerts --transport kafka --bootstrap host:9092 \
        --alerts-path s3://.../alerts --late-path s3://.../late --checkpoint-path s3://.../checkpoints
    python -m ledgerlake.cli silver --bronze-path ... --silver-path ... [--year Y --month M --day D]
    python -m ledgerlake.cli gold --silver-path ... --jdbc-url ... --user ... --password ...

Submit with spark-submit; the master and resources come from the submit
command, never from here.
"""

from __future__ import annotations

import argparse
import json
import logging

from ledgerlake.config import DEFAULT_CONFIG
from ledgerlake.plans.gold import DEFAULT_JDBC_CONNECTIONS

log = logging.getLogger("ledgerlake")

def _session(app: str):
    from pyspark.sql import SparkSession

    from ledgerlake.session import ensure_utc

    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_utc(spark)
    return spark


def _raw_stream(spark, args):
    """The message stream that the arguments of a streaming job name."""
    from ledgerlake.sources.transport import read_raw_stream

    options = {}
    if args.transport == "kafka":
        if args.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
        # Split the offset range of a large (hot) topic partition over
        # several tasks instead of reading it in one (default: the cluster's
        # parallelism; Spark divides ranges in proportion to their size).
        min_partitions = args.min_partitions or spark.sparkContext.defaultParallelism
        options["minPartitions"] = str(min_partitions)
    return read_raw_stream(
        spark,
        args.transport,
        path=args.inbox,
        bootstrap=args.bootstrap,
        topic=args.topic,
        max_files_per_trigger=args.max_files_per_trigger,
        fail_on_data_loss=not args.allow_data_loss,
        options=options,
    )


def _bronze(args) -> None:
    from ledgerlake.plans.bronze import BronzeTargets
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    spark = _session("ledgerlake-bronze")
    cfg = DEFAULT_CONFIG.with_(
        null_policy=args.null_policy,
        window_strategy=args.window_strategy,
        window_scope=args.window_scope,
        trigger_interval=args.trigger,
    )
    raw = _raw_stream(spark, args)
    root = args.bronze_path.rstrip("/")
    targets = BronzeTargets(
        bronze_path=root,
        dead_letter_transport=args.transport,
        dead_letter_bootstrap=args.bootstrap,
        dead_letter_path=args.dead_letter_path,
        structural_path=root.rsplit("/", 1)[0] + "/dead_letter",
        replay_safe=args.replay_safe,
        manifest_path=args.manifest_path,
        late_path=root.rsplit("/", 1)[0] + "/late",
    )
    query = start_bronze_stream(
        spark,
        raw,
        targets,
        f"{args.checkpoint_path.rstrip('/')}/bronze",
        cfg,
        available_now=args.available_now,
        watermark=args.watermark,
        on_batch=lambda c: log.info("batch %s", json.dumps(c)),
    )
    query.awaitTermination()


def _alerts(args) -> None:
    from ledgerlake.sources.transport import decode_payload
    from ledgerlake.streaming.alerts import start_card_alerts

    spark = _session("ledgerlake-alerts")
    queries = start_card_alerts(
        spark,
        decode_payload(_raw_stream(spark, args), keep_raw=False),
        args.alerts_path.rstrip("/"),
        f"{args.checkpoint_path.rstrip('/')}/alerts",
        DEFAULT_CONFIG.with_(trigger_interval=args.trigger),
        watermark=args.watermark,
        available_now=args.available_now,
        state_store=args.state_store,
        late_path=args.late_path,
    )
    if args.available_now:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()  # a query that fails ends the job


def _silver(args) -> None:
    from ledgerlake.plans.silver import run_silver

    spark = _session("ledgerlake-silver")
    run_silver(spark, args.bronze_path, args.silver_path, args.year, args.month, args.day, mode=args.mode)


def _gold(args) -> None:
    from ledgerlake.plans.gold import run_gold

    spark = _session("ledgerlake-gold")
    written = run_gold(
        spark,
        args.silver_path,
        args.jdbc_url or args.parquet_path,
        args.year,
        args.month,
        args.day,
        user=args.user,
        password=args.password,
        driver=args.driver,
        dim_mode=args.dim_mode,
        fact_mode=args.fact_mode,
        num_partitions=args.jdbc_partitions,
        tables=args.tables,
    )
    log.info("gold tables written: %s", written)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("bronze", help="stream raw payments to Bronze and the dead letters")
    a = sub.add_parser("alerts", help="keep the window rules' state over the stream and report cards that fire")
    for sp in (b, a):
        sp.add_argument("--transport", choices=["kafka", "file"], default="kafka")
        sp.add_argument("--bootstrap", default=None)
        sp.add_argument("--topic", default="payments.raw")
        sp.add_argument("--inbox", default=None, help="message folder when --transport file")
        sp.add_argument("--checkpoint-path", required=True)
        sp.add_argument("--trigger", default=DEFAULT_CONFIG.trigger_interval)
        sp.add_argument("--available-now", action="store_true")
        sp.add_argument("--max-offsets-per-trigger", type=int, default=None,
                       help="kafka: messages per micro-batch (default: no bound). With window scope micro_batch a "
                            "smaller batch narrows what the window rules see and so changes verdicts")
        sp.add_argument("--min-partitions", type=int, default=None,
                       help="kafka: split topic partitions into at least this many tasks (default: cluster parallelism)")
        sp.add_argument("--max-files-per-trigger", type=int, default=None,
                       help="file: files per micro-batch (default: no bound); narrows the window rules as well")
        sp.add_argument("--allow-data-loss", action="store_true", help="kafka: go on when offsets have expired")
    b.add_argument("--dead-letter-path", default=None, help="message folder when --transport file")
    b.add_argument("--bronze-path", required=True)
    b.add_argument("--window-scope", choices=["micro_batch", "stateful"], default="micro_batch",
                   help="which rows a window rule sees: those of its micro-batch, or all of the stream (rows then "
                        "wait until their windows have closed; late ones go to <bronze>/../late)")
    b.add_argument("--watermark", default="10 minutes", help="window scope stateful: how late rows may come")
    b.add_argument("--manifest-path", default=None,
                   help="commit manifest: every row exactly once for readers that honour it (file sinks)")
    b.add_argument("--replay-safe", action="store_true", help="partition Bronze by batch id, overwrite on replay")
    b.add_argument("--null-policy", choices=["propagate", "quarantine"], default="propagate")
    b.add_argument("--window-strategy", choices=["auto", "broadcast", "join", "window"], default="auto")
    b.set_defaults(run=_bronze)

    a.add_argument("--alerts-path", required=True)
    a.add_argument("--late-path", default=None, help="folder for payments behind the watermark (default: only counted)")
    a.add_argument("--watermark", default="1 hour", help="how late payments may come")
    a.add_argument("--state-store", choices=["rocksdb"], default=None, help="default: Spark's own")
    a.set_defaults(run=_alerts)

    s = sub.add_parser("silver", help="refine Bronze into Silver")
    s.add_argument("--bronze-path", required=True)
    s.add_argument("--silver-path", required=True)
    s.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    g = sub.add_parser("gold", help="build the star schema into a JDBC database or Parquet tables")
    g.add_argument("--silver-path", required=True)
    where = g.add_mutually_exclusive_group(required=True)
    where.add_argument("--jdbc-url", default=None)
    where.add_argument("--parquet-path", default=None, help="root folder of Parquet tables instead of a database")
    g.add_argument("--fact-mode", choices=["append", "replace_day"], default="append",
                   help="replace_day (Parquet): a re-run replaces the days it writes")
    g.add_argument("--tables", nargs="+", default=None, help="only these tables (default: all six)")
    g.add_argument("--user", default=None)
    g.add_argument("--password", default=None)
    g.add_argument("--driver", default=None)
    g.add_argument("--dim-mode", choices=["overwrite", "merge", "append"], default=None,
                   help="default: overwrite for all of Silver, merge (new rows only) for one day")
    g.add_argument("--jdbc-partitions", type=int, default=DEFAULT_JDBC_CONNECTIONS,
                   help="concurrent connections per table")
    for sp in (s, g):
        sp.add_argument("--year", type=int, default=None)
        sp.add_argument("--month", type=int, default=None)
        sp.add_argument("--day", type=int, default=None)
    s.set_defaults(run=_silver)
    g.set_defaults(run=_gold)

    args = p.parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
