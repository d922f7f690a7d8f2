"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)`` and reads the driver's tables (the
payments are a projection of ``events``; dedup uses ``lineitem``), so its
work grows with them. Queries that exercise sinks or streams write under the
session's shared scratch folder and return a DataFrame over what was written.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.config import FIXTURE_CONFIG as FX
from ledgerlake.operators import enrich as E
from ledgerlake.operators import gold as G
from ledgerlake.operators import routing as R
from ledgerlake.operators import rules as RU
from ledgerlake.operators.dedup import keep_first
from ledgerlake.operators.refine import clean_strings, drop_critical_nulls, standardize_types
from ledgerlake.operators.windows import window_groups
from ledgerlake.plans.bronze import BronzeTargets, bronze_rows, enrich, process_batch
from ledgerlake.plans.silver import silver_transform
from ledgerlake.session import ensure_utc, new_run_dir
from ledgerlake.sources.fixtures import messages_from_payments, messages_with_faults, payments_from_events, reuse_ids
from ledgerlake.sources.tables import partition_values, path_exists, read_partitioned, read_table

FLAGS = (
    "is_high_amount",
    "is_blacklisted",
    "is_bank_declined",
    "is_high_velocity",
    "is_cross_border",
    "is_high_decline_rate",
)
WINDOW_FLAGS = ("is_high_velocity", "is_cross_border", "is_high_decline_rate")
BRONZE_COLUMNS = (
    list(C.PAYMENT_COLUMNS)
    + ["event_time", "year", "month", "day", "country"]
    + list(FLAGS)
    + ["fraud_reasons"]
)
SILVER_COLUMNS = list(C.PAYMENT_COLUMNS) + ["event_time", "year", "month", "day", "country"]


# ---------------------------------------------------------------- inputs
def payments(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return payments_from_events(read_table(spark, sf, "events"))


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return E.with_partition_columns(E.with_event_time(payments(spark, sf)))


def routed(spark: SparkSession, sf: str, cfg: C.PipelineConfig = FX) -> DataFrame:
    return enrich(payments(spark, sf), cfg)


def silver_all(spark: SparkSession, sf: str) -> DataFrame:
    """Silver over every parseable payment (not only Bronze's valid rows),
    so that the Gold fraud-signal fact has rows to report."""
    df = E.with_country(E.parseable(E.with_event_time(payments(spark, sf))))
    return silver_transform(df).select(*SILVER_COLUMNS)


# ------------------------------------------------------ step 1: parse, settle
def q_parse_event_time(spark, sf):
    return E.parseable(parsed(spark, sf)).select(
        "transaction_id", "ts_event", "event_time", "year", "month", "day"
    )


def q_settlement_daily(spark, sf):
    return G.fact_settlement_daily(silver_all(spark, sf))


# ---------------------------------------- step 2: decode, country, currency
def q_decode_payload(spark, sf):
    from ledgerlake.sources.transport import decode_payload

    return decode_payload(messages_from_payments(payments(spark, sf)), keep_raw=False)


def q_extract_country(spark, sf):
    return E.with_country(payments(spark, sf)).select("transaction_id", "location", "country")


def q_currency_validity(spark, sf):
    return E.with_currency_check(payments(spark, sf), FX.valid_currencies).select(
        "transaction_id", "currency", "is_invalid"
    )


# ---------------------------------------------------- step 3: row rules
def q_rule_high_amount(spark, sf):
    return RU.high_amount_rule(FX.amount_threshold).apply(payments(spark, sf)).select(
        "transaction_id", "amount", "is_high_amount"
    )


def q_rule_blacklist(spark, sf):
    return RU.blacklisted_merchant_rule(FX.blacklisted_merchants).apply(payments(spark, sf)).select(
        "transaction_id", "merchant_id", "is_blacklisted"
    )


def q_rule_blacklist_table(spark, sf):
    """Blacklist given as a table: a lookup join."""
    table = spark.createDataFrame([(m,) for m in FX.blacklisted_merchants], "merchant_id string")
    return RU.blacklisted_merchant_rule(table).apply(payments(spark, sf)).select(
        "transaction_id", "merchant_id", "is_blacklisted"
    )


def q_rule_declined(spark, sf):
    return RU.bank_declined_rule().apply(payments(spark, sf)).select(
        "transaction_id", "auth_result", "is_bank_declined"
    )


def q_fraud_verdict(spark, sf):
    return routed(spark, sf).select("transaction_id", *FLAGS, "fraud_reasons", "is_fraud")


# ------------------------------------------------- step 4: window rules
def _window_rule_query(rule_factory, flag):
    def q(spark, sf):
        df = E.parseable(E.with_event_time(payments(spark, sf)))
        return rule_factory().apply(df).select("transaction_id", "card_hash", "event_time", flag)

    return q


q_rule_velocity = _window_rule_query(
    lambda: RU.high_velocity_rule(FX.velocity_max_txn, FX.velocity_window), "is_high_velocity"
)
q_rule_cross_border = _window_rule_query(
    lambda: RU.cross_border_rule(FX.cross_border_window), "is_cross_border"
)
q_rule_decline_rate = _window_rule_query(
    lambda: RU.high_decline_rate_rule(FX.decline_rate_limit, FX.decline_rate_window),
    "is_high_decline_rate",
)


def _windows_query(rule_factory):
    def q(spark, sf):
        df = E.with_country(E.parseable(E.with_event_time(payments(spark, sf))))
        return window_groups(df, rule_factory())

    return q


q_velocity_windows = _windows_query(lambda: RU.high_velocity_rule(FX.velocity_max_txn, FX.velocity_window))
q_cross_border_windows = _windows_query(lambda: RU.cross_border_rule(FX.cross_border_window))
q_decline_rate_windows = _windows_query(
    lambda: RU.high_decline_rate_rule(FX.decline_rate_limit, FX.decline_rate_window)
)


def _strategy_query(cfg):
    def q(spark, sf):
        return routed(spark, sf, cfg).select("transaction_id", *WINDOW_FLAGS)

    return q


q_rules_join_form = _strategy_query(FX.with_(window_strategy="join"))
q_rules_window_form = _strategy_query(FX.with_(window_strategy="window"))
# Without a shuffle of the firing groups' own.
q_rules_broadcast_form = _strategy_query(FX.with_(window_strategy="broadcast"))
# The surveyed defaults: 1-minute velocity, 10-minute cross-border/decline rate.
q_rules_reference_windows = _strategy_query(C.DEFAULT_CONFIG.with_(blacklisted_merchants=FX.blacklisted_merchants))
# The same windows as a join: one aggregate by minute, rolled up to ten minutes, one join.
q_rules_join_form_reference = _strategy_query(
    C.DEFAULT_CONFIG.with_(blacklisted_merchants=FX.blacklisted_merchants, window_strategy="join")
)


# ----------------------------------------------------- step 5: routing
def q_route_valid(spark, sf):
    return bronze_rows(routed(spark, sf)).select(*BRONZE_COLUMNS)


def q_route_dead_letter(spark, sf):
    return R.dead_letter_rows(routed(spark, sf)).select(
        "transaction_id", "card_hash", *FLAGS, "fraud_reasons", "is_fraud", "is_invalid"
    )


def q_route_quarantine(spark, sf):
    return R.dead_letter_rows(routed(spark, sf, FX.with_(null_policy="quarantine"))).select(
        "transaction_id", "is_fraud", "is_invalid"
    )


def q_unparseable_rows(spark, sf):
    from ledgerlake.plans.bronze import structural_dead_letter

    return structural_dead_letter(routed(spark, sf), 0)


def q_batch_counts(spark, sf):
    return R.batch_counts(routed(spark, sf))


def q_partition_distribution(spark, sf):
    return R.partition_distribution(R.valid_rows(routed(spark, sf)))


# ------------------------------------------------------- step 6: Silver
def q_dedup_first(spark, sf):
    return keep_first(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_dedup_first_aggregate(spark, sf):
    return keep_first(
        read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], strategy="aggregate"
    )


def q_standardize_types(spark, sf):
    return standardize_types(E.parseable(parsed(spark, sf))).select(
        "transaction_id", "amount", "event_time", "mcc", "currency"
    )


def q_clean_strings(spark, sf):
    return clean_strings(E.with_country(E.parseable(parsed(spark, sf)))).select(
        "transaction_id", "merchant_id", "channel", "auth_result", "location", "country"
    )


def q_drop_critical_nulls(spark, sf):
    return drop_critical_nulls(standardize_types(E.with_event_time(payments(spark, sf)))).select(
        "transaction_id", "card_hash", "amount", "event_time", "currency"
    )


def q_silver(spark, sf):
    """End to end: Bronze's valid rows -> Silver."""
    return silver_transform(bronze_rows(routed(spark, sf))).select(*SILVER_COLUMNS)


# --------------------------------------------------------- step 7: Gold
def _gold(name):
    def q(spark, sf):
        flagged = G.gold_flags(silver_all(spark, sf), FX.amount_threshold, FX.blacklisted_merchants)
        return G.GOLD_TABLES[name](flagged)

    return q


q_dim_date = _gold("dim_date")
q_dim_card = _gold("dim_card")
q_dim_merchant = _gold("dim_merchant")
q_fact_transactions = _gold("fact_transactions")
q_fact_fraud_signals = _gold("fact_fraud_signals")


# ---------------------------------------- step 8/9: streams and checks
def _write_messages(spark, sf, run):
    """Stage the payments as transport messages, spread over several files
    the way a topic is spread over partitions (fixture preparation)."""
    inbox = f"{run}/inbox"
    parts = max(1, spark.sparkContext.defaultParallelism)
    messages_from_payments(payments(spark, sf)).repartition(parts).write.mode("overwrite").json(inbox)
    return inbox


def _targets(run):
    return BronzeTargets(
        bronze_path=f"{run}/bronze",
        dead_letter_transport="file",
        dead_letter_path=f"{run}/dead_letter_topic",
        structural_path=f"{run}/dead_letter",
    )


def _finish(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _run_bronze_stream(spark, sf, on_batch=None):
    from ledgerlake.sources.transport import read_raw_stream
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    run = new_run_dir(spark, "stream")
    inbox = _write_messages(spark, sf, run)
    raw = read_raw_stream(spark, "file", path=inbox)
    _finish(
        start_bronze_stream(
            spark, raw, _targets(run), f"{run}/checkpoints/bronze", FX, available_now=True, on_batch=on_batch
        )
    )
    return run, _targets(run)


def _dead_letter_messages(spark, targets):
    from ledgerlake.sources.transport import read_raw_batch

    return read_raw_batch(spark, "file", path=f"{targets.dead_letter_path}/run=*/batch=*", topic=C.DEAD_LETTER_TOPIC)


def _structural_rows(spark, targets):
    schema = "transaction_id string, ts_event string, raw_value string, batch_id long"
    return spark.read.schema(schema).json(f"{targets.structural_path}/run=*/batch=*")


def q_stream_bronze(spark, sf):
    _, targets = _run_bronze_stream(spark, sf)
    return spark.read.parquet(targets.bronze_path).select(*BRONZE_COLUMNS)


def q_stream_dead_letter(spark, sf):
    from ledgerlake.sources.dead_letter import dead_letter_report

    _, targets = _run_bronze_stream(spark, sf)
    return dead_letter_report(_dead_letter_messages(spark, targets))


def q_stream_unparseable(spark, sf):
    """Structural dead letter; the payload kept there is decoded again and compared field by field."""
    from ledgerlake.sources.transport import decode_payload

    _, targets = _run_bronze_stream(spark, sf)
    rows = _structural_rows(spark, targets)
    return decode_payload(rows.select(F.col("raw_value").alias("value"), "batch_id").select("value"), keep_raw=False)


def q_stream_partition_distribution(spark, sf):
    """Valid rows per day as the batches report them (a few rows a batch, from the aggregate that counts it)."""
    seen = []
    _run_bronze_stream(spark, sf, on_batch=lambda c: seen.extend(c["partitions"]))
    schema = "year int, month int, day int, row_count long"
    rows = spark.createDataFrame([(x["year"], x["month"], x["day"], x["row_count"]) for x in seen], schema)
    return rows.groupBy("year", "month", "day").agg(F.sum("row_count").alias("row_count"))


def q_stream_restart(spark, sf):
    """Every staged message is accounted for over a restart, an empty batch and a new checkpoint.

    Two halves of the messages, staged one after the other, through one
    checkpoint; then a processing-time query on the same checkpoint finds
    nothing new; then all of them again through a new checkpoint onto the
    same targets, which must leave the first run's output alone.
    """
    from ledgerlake.sources.transport import read_raw_stream
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    run = new_run_dir(spark, "restart")
    messages = messages_from_payments(payments(spark, sf))
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    counts = []

    def start(checkpoint, available_now):
        raw = read_raw_stream(spark, "file", path=f"{run}/inbox/*")
        return start_bronze_stream(
            spark, raw, _targets(run), f"{run}/checkpoints/{checkpoint}", FX.with_(trigger_interval="1 second"),
            available_now=available_now, on_batch=counts.append,
        )

    for part in (0, 1):
        messages.filter(half == part).write.json(f"{run}/inbox/{part}")
        _finish(start("first", True))
    query = start("first", False)
    query.processAllAvailable()
    query.stop()
    before = len(counts)
    _finish(start("second", True))
    if before < 2 or len(counts) == before:
        raise RuntimeError("expected batches of both runs")

    targets = _targets(run)
    written = [
        spark.read.parquet(targets.bronze_path).select(F.lit("valid").alias("route")),
        _dead_letter_messages(spark, targets).select(F.lit("dead_letter").alias("route")),
        _structural_rows(spark, targets).select(F.lit("unparseable").alias("route")),
    ]
    rows = written[0].unionByName(written[1]).unionByName(written[2]).groupBy("route").agg(F.count("*").alias("n"))
    reported = {k: sum(c[k] for c in counts) for k in ("received", "valid", "dead_letter", "unparseable", "unrouted")}
    reports = spark.createDataFrame(list(reported.items()), "label string, reported long")
    lost = F.col("label").isin("valid", "dead_letter", "unparseable") & ~F.col("reported").eqNullSafe(F.coalesce("n", F.lit(0)))
    checked = reports.join(rows, F.col("label") == F.col("route"), "left").withColumn("_lost", lost)
    # Which rows go to which route depends on the batches; all of them together do not.
    return checked.agg(
        F.max(F.when(F.col("label") == "received", F.col("reported"))).alias("received"),
        F.sum(F.when(F.col("label") != "received", F.col("reported"))).alias("accounted"),
        F.max(F.when(F.col("label") == "unparseable", F.col("n"))).alias("unparseable"),
        F.count_if("_lost").alias("mismatches"),
    )


def q_dead_letter_report(spark, sf):
    """Batch run of the Bronze stage, then the dead-letter reader over its output."""
    from ledgerlake.sources.dead_letter import dead_letter_report

    targets = _targets(new_run_dir(spark, "batch_bronze"))
    process_batch(payments(spark, sf), 0, targets, FX)
    return dead_letter_report(_dead_letter_messages(spark, targets))


def q_partition_check(spark, sf):
    """Write Silver, then check one day's partition (present + rows)."""
    from ledgerlake.operators.checks import partition_check
    from ledgerlake.sinks.parquet import write_partitioned

    run = new_run_dir(spark, "silver")
    write_partitioned(silver_all(spark, sf), f"{run}/silver", mode="overwrite")
    return partition_check(spark, f"{run}/silver", 2024, 1, 15)


def q_silver_job_idempotent(spark, sf):
    """Silver job run twice over Bronze (dynamic overwrite): read back once."""
    from ledgerlake.plans.silver import run_silver

    run = new_run_dir(spark, "medallion")
    targets = _targets(run)
    process_batch(payments(spark, sf), 0, targets, FX)
    for _ in range(2):
        run_silver(spark, targets.bronze_path, f"{run}/silver")
    return read_partitioned(spark, f"{run}/silver").select(*SILVER_COLUMNS)


# The day used by the day-scoped queries (partition-scoped reads).
CHECK_DAY = (2024, 1, 15)
EMPTIED_DAY = (2024, 1, 16)


def q_silver_day(spark, sf):
    """Bronze written from every payment, then the Silver job for one day:
    only that day's Bronze folder is listed and read (SRC3), and only that
    day's Silver partition is written. Another day is run, emptied and run
    again: nothing of it stays."""
    from ledgerlake.plans.silver import run_silver
    from ledgerlake.sinks.parquet import write_day

    run = new_run_dir(spark, "silver_day")
    targets = _targets(run)
    process_batch(payments(spark, sf), 0, targets, FX)
    run_silver(spark, targets.bronze_path, f"{run}/silver", *CHECK_DAY)
    run_silver(spark, targets.bronze_path, f"{run}/silver", *EMPTIED_DAY)
    # The day's Bronze is replaced by no rows; its Silver must be empty after the next run.
    bronze = spark.read.parquet(targets.bronze_path)
    write_day(bronze.limit(0), targets.bronze_path, *EMPTIED_DAY)
    run_silver(spark, targets.bronze_path, f"{run}/silver", *EMPTIED_DAY)
    return read_partitioned(spark, f"{run}/silver").select(*SILVER_COLUMNS)


def q_settlement_day(spark, sf):
    """Silver written for every day; the settlement fact of one day read
    through a partition-scoped Silver read (SRC4)."""
    from ledgerlake.sinks.parquet import write_partitioned

    run = new_run_dir(spark, "settlement_day")
    write_partitioned(silver_all(spark, sf), f"{run}/silver", mode="overwrite")
    day = read_partitioned(spark, f"{run}/silver", *CHECK_DAY)
    return G.fact_settlement_daily(day)


def _gold_job_query(name):
    def q(spark, sf):
        """The Gold job scoped to one table: Silver on disk -> Parquet table,
        all of Silver, then one day again (its facts replaced, its dimensions merged)."""
        from ledgerlake.plans.gold import run_gold
        from ledgerlake.sinks.parquet import write_partitioned

        run = new_run_dir(spark, "gold")
        write_partitioned(silver_all(spark, sf), f"{run}/silver", mode="overwrite")
        options = {"threshold": FX.amount_threshold, "blacklist": FX.blacklisted_merchants, "fact_mode": "replace_day"}
        options["tables"] = (name,)
        run_gold(spark, f"{run}/silver", f"{run}/gold", **options)
        run_gold(spark, f"{run}/silver", f"{run}/gold", *CHECK_DAY, **options)
        return spark.read.parquet(f"{run}/gold/{name}")

    return q


def _alert_stream(spark, sf):
    """Card alerts over at least four micro-batches, with a watermark that covers the data."""
    from ledgerlake.sources.transport import decode_payload, read_raw_stream
    from ledgerlake.streaming.alerts import start_card_alerts

    run = new_run_dir(spark, "alerts")
    messages_from_payments(payments(spark, sf)).repartition(8).write.json(f"{run}/inbox")
    raw = read_raw_stream(spark, "file", path=f"{run}/inbox", max_files_per_trigger=2)
    for q in start_card_alerts(
        spark, decode_payload(raw, keep_raw=False), f"{run}/alerts", f"{run}/checkpoints", FX,
        watermark="1000 days", available_now=True,
    ):
        _finish(q)
    return f"{run}/alerts"


def _alerts_of_inbox(spark, run):
    """Card alerts to the end of the inbox, an hour's watermark; dates are closed on the way, late rows kept."""
    from ledgerlake.sources.transport import decode_payload, read_raw_stream
    from ledgerlake.streaming.alerts import start_card_alerts

    raw = read_raw_stream(spark, "file", path=f"{run}/inbox", max_files_per_trigger=SLICE_FILES)
    for q in start_card_alerts(
        spark, decode_payload(raw, keep_raw=False), f"{run}/alerts", f"{run}/checkpoints", FX,
        watermark="1 hour", available_now=True, late_path=f"{run}/late",
    ):
        _finish(q)


def q_stream_alerts_closed_dates(spark, sf):
    """Alerts of a month that came in order: dates the watermark passed are closed by the query, the last stay open."""
    from ledgerlake.streaming.alerts import CLOSED_FOLDER, MARKER, ROLLUP_FOLDER, read_card_alerts

    run = new_run_dir(spark, "closed")
    _staged_month(spark, sf, run)
    _alerts_of_inbox(spark, run)
    folder = f"{run}/alerts/{ROLLUP_FOLDER}"
    closed = partition_values(spark, f"{folder}/{CLOSED_FOLDER}", "window_date", MARKER)
    still_open = partition_values(spark, folder, "window_date")
    if not closed or not still_open or set(closed) & set(still_open):
        raise RuntimeError("expected closed dates and open dates")
    return read_card_alerts(spark, f"{run}/alerts", FX)


def q_stream_alerts_late_rows(spark, sf):
    """Early days staged after late ones: payments that the card windows count, and those kept as late."""
    from ledgerlake.streaming.alerts import ROLLUP_FOLDER, read_window_state

    run = new_run_dir(spark, "alerts-late")
    rows, columns = parsed(spark, sf), payments(spark, sf).columns
    early = F.coalesce(F.col("day"), F.lit(1)) < LATE_BEFORE
    _stage_slice(spark, rows.filter(~early).select(*columns), f"{run}/inbox")
    _alerts_of_inbox(spark, run)
    _stage_slice(spark, rows.filter(early).select(*columns), f"{run}/inbox")
    _alerts_of_inbox(spark, run)
    fields = "card_hash string, ts_event string, window_end timestamp"
    late = spark.read.schema(fields).json(f"{run}/late/{ROLLUP_FOLDER}/run=*/batch=*")
    late = late.groupBy("card_hash", "window_end").agg(F.count(F.lit(1)).alias("n_late"))
    counted = read_window_state(spark, f"{run}/alerts", FX).select(
        "card_hash", "window_end", F.col("_wa_is_high_velocity_velocity_count").alias("n_counted")
    )
    return counted.join(late, ["card_hash", "window_end"], "full").fillna(0, ["n_counted", "n_late"])


def q_stream_card_alerts(spark, sf):
    from ledgerlake.streaming.alerts import read_card_alerts

    return read_card_alerts(spark, _alert_stream(spark, sf), FX)


def q_rules_across_batches(spark, sf):
    """Window scope "stateful": flags from state over several micro-batches equal those of the whole table."""
    from ledgerlake.sources.transport import decode_payload
    from ledgerlake.streaming.alerts import read_card_alerts, with_window_state

    cfg = FX.with_(window_scope="stateful")
    alerts = read_card_alerts(spark, _alert_stream(spark, sf), cfg)
    rows = decode_payload(messages_from_payments(payments(spark, sf)), keep_raw=False)
    return enrich(with_window_state(rows, alerts, cfg), cfg).select(
        "transaction_id", *WINDOW_FLAGS, "fraud_reasons", "is_fraud", "route"
    )


# ------------------------------------- verdicts, late rows and faults in streams
#: First day of each staged slice of the month (the last one is open).
SLICES = (1, 9, 17, 25)
LATE_BEFORE = 10  # in the query of late rows, days before it come after the others
#: Files of a slice, and files a trigger takes: a slice is a batch. Fixed, so that batches do not depend on the cluster.
SLICE_FILES = 8
SLICE_RECORDS = 200_000  # most rows of a file of the folder that the slices are taken from


def _stage_slice(spark, payments_, inbox, parts=SLICE_FILES):
    """Add messages to an inbox, in a few files."""
    messages_from_payments(payments_).repartition(parts).write.mode("append").json(inbox)


def _stage_end(spark, inbox):
    """A payment far ahead of all others: windows before it can close. It stays in the stream's state itself."""
    value = F.to_json(F.struct(F.lit("2030-01-01 00:00:00").alias("ts_event"), F.lit("end").alias("card_hash")))
    end = spark.range(1).select(F.lit("end").alias("key"), value.alias("value"))
    end.coalesce(1).write.mode("append").json(inbox)


def _stateful_stream(spark, run, cfg, watermark, on_batch=None, files=SLICE_FILES):
    """The Bronze stream with window verdicts in its state, to the end of the inbox."""
    from dataclasses import replace

    from ledgerlake.sources.transport import read_raw_stream
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    targets = replace(_targets(run), late_path=f"{run}/late")
    raw = read_raw_stream(spark, "file", path=f"{run}/inbox", max_files_per_trigger=files)
    _finish(
        start_bronze_stream(
            spark, raw, targets, f"{run}/checkpoint", cfg, available_now=True, watermark=watermark, on_batch=on_batch
        )
    )
    return targets


def _staged_month(spark, sf, run, every=SLICES):
    """Stage the payments slice by slice in order of days (those without a time first); files are read in this order.

    The times of all payments are parsed once, into a folder a slice.
    """
    rows = parsed(spark, sf)
    columns = payments(spark, sf).columns
    at = F.coalesce(F.col("day"), F.lit(1))
    number = F.lit(-1)
    for first in every:
        number = number + (at >= first).cast("int")
    sliced = rows.select(*columns, number.alias("slice"))
    # Payments in order of time: a slice would else lie in the one or two files of the tasks that read it.
    sliced.write.option("maxRecordsPerFile", SLICE_RECORDS).partitionBy("slice").parquet(f"{run}/slices")
    sliced = spark.read.schema(sliced.schema).parquet(f"{run}/slices")
    for i in range(len(every)):
        _stage_slice(spark, sliced.filter(F.col("slice") == i).select(*columns), f"{run}/inbox")
    _stage_end(spark, f"{run}/inbox")


def _stateful_month(spark, sf, cfg):
    """Four slices and the end through the stateful Bronze stream; at least four batches must have had rows."""
    run = new_run_dir(spark, "stateful")
    _staged_month(spark, sf, run)
    seen = []
    targets = _stateful_stream(spark, run, cfg.with_(window_scope="stateful"), "1 hour", on_batch=seen.append)
    if sum(c["received"] > 0 for c in seen) < 4:
        raise RuntimeError("expected at least four batches with rows")
    return targets


def q_stream_stateful_bronze(spark, sf):
    """Bronze of a stream whose window rules see all of it: equal to the table's, over several batches."""
    return spark.read.parquet(_stateful_month(spark, sf, FX).bronze_path).select(*BRONZE_COLUMNS)


def q_stream_stateful_dead_letter(spark, sf):
    from ledgerlake.sources.dead_letter import dead_letter_report

    return dead_letter_report(_dead_letter_messages(spark, _stateful_month(spark, sf, FX)))


def q_stream_stateful_reference(spark, sf):
    """The surveyed windows (1 and 10 minutes) inside the stream."""
    cfg = C.DEFAULT_CONFIG.with_(blacklisted_merchants=FX.blacklisted_merchants)
    return spark.read.parquet(_stateful_month(spark, sf, cfg).bronze_path).select(*BRONZE_COLUMNS)


def q_stream_late_rows(spark, sf):
    """Early days staged after late ones: every staged payment is either routed or kept as late.

    Null verdicts go to the dead letter, so that no other row is missing.
    """
    run = new_run_dir(spark, "late")
    rows, columns = parsed(spark, sf), payments(spark, sf).columns
    early = F.coalesce(F.col("day"), F.lit(1)) < LATE_BEFORE
    cfg = FX.with_(window_scope="stateful", null_policy="quarantine")
    _stage_slice(spark, rows.filter(~early).select(*columns), f"{run}/inbox")
    _stateful_stream(spark, run, cfg, "1 hour")
    _stage_slice(spark, rows.filter(early).select(*columns), f"{run}/inbox")
    _stage_end(spark, f"{run}/inbox")
    targets = _stateful_stream(spark, run, cfg, "1 hour")
    fields = "transaction_id string, ts_event string"
    routed_ = [
        spark.read.parquet(targets.bronze_path).select("transaction_id", "ts_event"),
        _dead_letter_messages(spark, targets).select(F.from_json("value", fields).alias("v")).select("v.*"),
        _structural_rows(spark, targets).select("transaction_id", "ts_event"),
    ]
    late = spark.read.schema(fields).json(f"{targets.late_path}/run=*/batch=*").withColumn("late", F.lit(True))
    for rows in routed_:
        late = late.unionByName(rows.withColumn("late", F.lit(False)))
    return late


def q_stream_empty_batch(spark, sf):
    """Batches without rows reach the sinks (the watermark moves, nothing has closed) and write nothing."""
    run = new_run_dir(spark, "empty")
    _stage_slice(spark, parsed(spark, sf).filter("day = 15 AND card_hash IS NOT NULL AND NOT endswith(transaction_id, '777')").select(*payments(spark, sf).columns), f"{run}/inbox", parts=2)
    seen = []
    # The watermark never leaves the day behind, so its windows stay open and the batches are empty.
    targets = _stateful_stream(spark, run, FX.with_(window_scope="stateful"), "2 days", seen.append, files=1)
    paths = (targets.bronze_path, targets.dead_letter_path, targets.structural_path, targets.late_path)
    row = (sum(c["received"] == 0 for c in seen) >= 2, sum(c["received"] for c in seen), sum(path_exists(spark, p) for p in paths))
    return spark.createDataFrame([row], "empty_batches_seen boolean, received long, sinks_written long")


def q_stream_exactly_once(spark, sf):
    """A batch that fails after its Bronze write and is replayed: committed readers see each row once.

    The first run's dead letter is on a file system that does not exist.
    """
    from dataclasses import replace

    from ledgerlake.sinks.manifest import read_committed
    from ledgerlake.sources.transport import read_raw_stream
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    run = new_run_dir(spark, "once")
    inbox = _write_messages(spark, sf, run)
    good = replace(_targets(run), manifest_path=f"{run}/manifest")
    for targets in (replace(good, dead_letter_path="nowhere://dead_letter"), good):
        raw = read_raw_stream(spark, "file", path=inbox)
        query = start_bronze_stream(spark, raw, targets, f"{run}/checkpoint", FX, available_now=True)
        if targets is good:
            _finish(query)
            continue
        try:
            query.awaitTermination()
        except StreamingQueryException:
            continue
        raise RuntimeError("the first attempt should have failed")
    committed = read_committed(spark, good.bronze_path, good.manifest_path).select(*BRONZE_COLUMNS)
    if spark.read.parquet(good.bronze_path).count() <= committed.count():
        raise RuntimeError("the failed attempt should have left rows")
    return committed


def q_decode_faults(spark, sf):
    """Messages with text and objects for amounts, cut-off messages and bad times: each fault by field, and its route."""
    from ledgerlake.sources.transport import decode_payload

    decoded = decode_payload(messages_with_faults(payments(spark, sf)), faults=True)
    # Taken apart first: a filter on the faults would be pushed down and parse every message again.
    rows = enrich(decoded, FX).select("transaction_id", F.explode_outer("decode_faults").alias("f"), "route")
    return rows.filter(F.col("f").isNotNull()).select(
        "transaction_id", F.col("f.field").alias("field"), F.col("f.value").alias("value"), "route"
    )


def q_stream_faults(spark, sf):
    """The same faults as the stream stores them, with the payload: its id is read out of the payload."""
    from ledgerlake.sources.transport import FAULTS_TYPE, read_raw_stream
    from ledgerlake.streaming.bronze_stream import start_bronze_stream

    run = new_run_dir(spark, "faults")
    parts = max(4, spark.sparkContext.defaultParallelism)
    messages_with_faults(payments(spark, sf)).repartition(parts).write.json(f"{run}/inbox")
    targets = _targets(run)
    raw = read_raw_stream(spark, "file", path=f"{run}/inbox")
    _finish(start_bronze_stream(spark, raw, targets, f"{run}/checkpoint", FX, available_now=True))
    schema = f"raw_value string, decode_faults {FAULTS_TYPE}"
    rows = spark.read.schema(schema).json(f"{targets.structural_path}/run=*/batch=*")
    return rows.select(
        F.get_json_object("raw_value", "$.transaction_id").alias("transaction_id"), F.explode("decode_faults").alias("f")
    ).select("transaction_id", F.col("f.field").alias("field"), F.col("f.value").alias("value"))


#: Days refined one after the other by the query of ids over runs; the middle one is refined again at the end.
REUSE_DAYS = ((2024, 1, 15), (2024, 1, 16), (2024, 1, 17))


def q_silver_dedup_across_days(spark, sf):
    """Ids that come again on other days, one Silver run a day with a table of taken ids: each id once."""
    from ledgerlake.plans.silver import run_silver

    run = new_run_dir(spark, "reuse")
    targets = _targets(run)
    process_batch(reuse_ids(payments(spark, sf)), 0, targets, FX)
    for day in (*REUSE_DAYS, REUSE_DAYS[1]):
        run_silver(spark, targets.bronze_path, f"{run}/silver", *day, keys_path=f"{run}/taken")
    return read_partitioned(spark, f"{run}/silver").select(*SILVER_COLUMNS)


def q_settlement_incremental(spark, sf):
    """Settlement from partials: all days, then late rows of one day; only that day is read again.

    Silver is refined from every parseable payment; every third row of the day comes late.
    """
    from ledgerlake.plans.settlement import settlement, update_settlement
    from ledgerlake.plans.silver import run_silver
    from ledgerlake.sinks.parquet import write_partitioned

    run = new_run_dir(spark, "settlement")
    rows = E.with_country(E.parseable(parsed(spark, sf)))
    is_late = (F.col("day") == CHECK_DAY[2]) & (F.col("month") == CHECK_DAY[1]) & (F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0)
    paths = {"changes_path": f"{run}/changes"}
    write_partitioned(rows.filter(~is_late), f"{run}/bronze", mode="append")
    run_silver(spark, f"{run}/bronze", f"{run}/silver", **paths)
    first = update_settlement(spark, f"{run}/silver", f"{run}/changes", f"{run}/partials")
    write_partitioned(rows.filter(is_late), f"{run}/bronze", mode="append")
    run_silver(spark, f"{run}/bronze", f"{run}/silver", *CHECK_DAY, **paths)
    second = update_settlement(spark, f"{run}/silver", f"{run}/changes", f"{run}/partials")
    if len(first) < 2 or second != [CHECK_DAY[0] * 10000 + CHECK_DAY[1] * 100 + CHECK_DAY[2]]:
        raise RuntimeError(f"expected all days, then one: {first}, {second}")
    return settlement(spark, f"{run}/partials")


QUERIES = {
    "parse_event_time": q_parse_event_time,
    "settlement_daily": q_settlement_daily,
    "decode_payload": q_decode_payload,
    "extract_country": q_extract_country,
    "currency_validity": q_currency_validity,
    "rule_high_amount": q_rule_high_amount,
    "rule_blacklist": q_rule_blacklist,
    "rule_blacklist_table": q_rule_blacklist_table,
    "rule_declined": q_rule_declined,
    "fraud_verdict": q_fraud_verdict,
    "rule_velocity": q_rule_velocity,
    "rule_cross_border": q_rule_cross_border,
    "rule_decline_rate": q_rule_decline_rate,
    "velocity_windows": q_velocity_windows,
    "cross_border_windows": q_cross_border_windows,
    "decline_rate_windows": q_decline_rate_windows,
    "rules_join_form": q_rules_join_form,
    "rules_window_form": q_rules_window_form,
    "rules_broadcast_form": q_rules_broadcast_form,
    "rules_reference_windows": q_rules_reference_windows,
    "rules_join_form_reference": q_rules_join_form_reference,
    "rules_across_batches": q_rules_across_batches,
    "route_valid": q_route_valid,
    "route_dead_letter": q_route_dead_letter,
    "route_quarantine": q_route_quarantine,
    "unparseable_rows": q_unparseable_rows,
    "batch_counts": q_batch_counts,
    "partition_distribution": q_partition_distribution,
    "dedup_first": q_dedup_first,
    "dedup_first_aggregate": q_dedup_first_aggregate,
    "standardize_types": q_standardize_types,
    "clean_strings": q_clean_strings,
    "drop_critical_nulls": q_drop_critical_nulls,
    "silver": q_silver,
    "silver_job_idempotent": q_silver_job_idempotent,
    "silver_day": q_silver_day,
    "dim_date": q_dim_date,
    "dim_card": q_dim_card,
    "dim_merchant": q_dim_merchant,
    "fact_transactions": q_fact_transactions,
    "fact_fraud_signals": q_fact_fraud_signals,
    **{f"gold_job_{name}": _gold_job_query(name) for name in G.GOLD_TABLES},
    "settlement_day": q_settlement_day,
    "stream_bronze": q_stream_bronze,
    "stream_dead_letter": q_stream_dead_letter,
    "stream_unparseable": q_stream_unparseable,
    "stream_restart": q_stream_restart,
    "stream_partition_distribution": q_stream_partition_distribution,
    "dead_letter_report": q_dead_letter_report,
    "partition_check": q_partition_check,
    "stream_card_alerts": q_stream_card_alerts,
    "stream_alerts_closed_dates": q_stream_alerts_closed_dates,
    "stream_alerts_late_rows": q_stream_alerts_late_rows,
    "stream_stateful_bronze": q_stream_stateful_bronze,
    "stream_stateful_dead_letter": q_stream_stateful_dead_letter,
    "stream_stateful_reference": q_stream_stateful_reference,
    "stream_late_rows": q_stream_late_rows,
    "stream_empty_batch": q_stream_empty_batch,
    "stream_exactly_once": q_stream_exactly_once,
    "decode_faults": q_decode_faults,
    "stream_faults": q_stream_faults,
    "silver_dedup_across_days": q_silver_dedup_across_days,
    "settlement_incremental": q_settlement_incremental,
}
