"""Routing, the batch Bronze stage, Silver and Gold jobs, options of the connectors."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG, FIXTURE_CONFIG
from ledgerlake.operators.routing import batch_counts
from ledgerlake.plans.bronze import BronzeTargets, enrich, process_batch
from ledgerlake.plans.silver import run_silver, silver_transform
from ledgerlake.sources.tables import partition_filter, read_partitioned

SF = "/root/testdata/sf0.001"


def routes(df):
    return {r.transaction_id: r.route for r in df.select("transaction_id", "route").collect()}


def test_null_verdict_policies(payments_df):
    rows = [payment(tid="nullamt", amount=None),
            payment(tid="nullcur", currency=None),
            payment(tid="nullcur_fraud", currency=None, auth="DECLINED"),
            payment(tid="usd_lower", currency="usd"),
            payment(tid="declined_lower", auth="declined"),
            payment(tid="badts", ts="nope"),
            payment(tid="ok")]
    rows = [r[:2] + (f"card-{r[0]}",) + r[3:] for r in rows]  # one card each: no window rule fires
    df = payments_df(rows)
    prop = routes(enrich(df, DEFAULT_CONFIG))
    assert prop == {"nullamt": "unrouted", "nullcur": "unrouted", "nullcur_fraud": "dead_letter",
                    "usd_lower": "dead_letter", "declined_lower": "valid", "badts": "unparseable", "ok": "valid"}
    quar = routes(enrich(df, DEFAULT_CONFIG.with_(null_policy="quarantine")))
    assert quar["nullamt"] == "dead_letter" and quar["nullcur"] == "dead_letter"


def test_quarantine_loses_no_row(spark):
    from ledgerlake.plans.catalog import payments

    p = payments(spark, SF)
    c = batch_counts(enrich(p, FIXTURE_CONFIG.with_(null_policy="quarantine"))).first()
    assert c.unrouted == 0 and c.received == c.unparseable + c.valid + c.dead_letter == p.count()


def test_process_batch_sinks(spark, tmp_dir):
    from ledgerlake.plans.catalog import payments

    targets = BronzeTargets(bronze_path=f"{tmp_dir}/bronze", dead_letter_transport="file",
                            dead_letter_path=f"{tmp_dir}/dl", structural_path=f"{tmp_dir}/dead_letter")
    counts = process_batch(payments(spark, SF), 7, targets, FIXTURE_CONFIG, run_id="r")
    bronze = spark.read.parquet(targets.bronze_path)
    assert bronze.count() == counts["valid"] > 0
    assert {"country", "is_high_velocity", "fraud_reasons", "year"} <= set(bronze.columns)
    assert "is_fraud" not in bronze.columns and "route" not in bronze.columns
    dl = spark.read.json(f"{tmp_dir}/dl/run=r/batch=7")
    assert dl.count() == counts["dead_letter"]
    v = json.loads(dl.first().value)
    assert "is_fraud" in v or "is_invalid" in v
    assert sum(p["row_count"] for p in counts["partitions"]) == counts["valid"]
    st = spark.read.json(f"{tmp_dir}/dead_letter/run=r/batch=7")
    assert st.count() == counts["unparseable"] and set(st.select("batch_id").distinct().toPandas().batch_id) == {7}


def test_empty_batch_writes_nothing(spark, payments_df, tmp_dir):
    targets = BronzeTargets(f"{tmp_dir}/bronze", f"{tmp_dir}/dead_letter", "file", dead_letter_path=f"{tmp_dir}/dl")
    counts = process_batch(payments_df([]), 0, targets)
    assert counts["received"] == 0
    import os
    assert not os.path.exists(f"{tmp_dir}/bronze") and not os.path.exists(f"{tmp_dir}/dl")


def test_partition_arguments():
    assert partition_filter(None, None, None) is None
    with pytest.raises(ValueError):
        partition_filter(2024, None, None)
    with pytest.raises(ValueError):
        partition_filter(2024, 1, None)


def test_dedup_keeps_earliest_and_loses_null_first(payments_df):
    from ledgerlake.operators.enrich import with_country, with_event_time

    rows = [payment(tid="d", ts="2026-05-29 06:39:20", amount=2.0),
            payment(tid="d", ts="2026-05-29 06:39:10", amount=1.0),
            payment(tid="n", ts="2026-05-29 06:39:10", amount=None),
            payment(tid="n", ts="2026-05-29 06:39:20", amount=5.0)]
    for strategy in ["window", "aggregate"]:
        df = silver_transform(with_country(with_event_time(payments_df(rows))), strategy)
        out = {r.transaction_id: r.amount for r in df.collect()}
        assert out == {"d": 1}  # "n": earliest copy has a null amount -> transaction lost


def test_dedup_strategies_equal_on_lineitem(spark):
    from ledgerlake.operators.dedup import keep_first

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    a = keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], "window")
    b = keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], "aggregate")
    assert a.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silver_job_idempotent_and_day_scoped(spark, tmp_dir):
    from ledgerlake.plans.catalog import payments

    targets = BronzeTargets(f"{tmp_dir}/bronze", f"{tmp_dir}/dead_letter", "file", dead_letter_path=f"{tmp_dir}/dl")
    process_batch(payments(spark, SF), 0, targets, FIXTURE_CONFIG)
    silver = f"{tmp_dir}/silver"
    run_silver(spark, targets.bronze_path, silver)
    first = read_partitioned(spark, silver).count()
    run_silver(spark, targets.bronze_path, silver)
    run_silver(spark, targets.bronze_path, silver, 2024, 1, 2)
    assert read_partitioned(spark, silver).count() == first
    day = read_partitioned(spark, silver, 2024, 1, 2)
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert all(c in filters for c in ("year", "month", "day"))
    assert set(day.select("day").distinct().toPandas().day) <= {2}
    with pytest.raises(ValueError):
        run_silver(spark, silver, silver)


def gold(spark, root, name):
    return spark.read.parquet(f"{root}/{name}")


def test_gold_tables_in_parquet(spark, tmp_dir):
    from ledgerlake.operators.gold import dim_merchant
    from ledgerlake.plans.catalog import silver_all
    from ledgerlake.plans.gold import run_gold
    from ledgerlake.sinks.parquet import write_partitioned

    write_partitioned(silver_all(spark, SF), f"{tmp_dir}/silver", mode="overwrite")
    root = f"{tmp_dir}/gold"
    written = run_gold(spark, f"{tmp_dir}/silver", root, blacklist=("M11", "M22"))
    assert written["dim_card"] == "overwrite" and written["fact_transactions"] == "append"
    n = gold(spark, root, "fact_transactions").count()
    run_gold(spark, f"{tmp_dir}/silver", root, blacklist=("M11", "M22"))
    assert gold(spark, root, "fact_transactions").count() == 2 * n  # facts append
    assert gold(spark, root, "dim_card").count() == silver_all(spark, SF).select("card_hash").distinct().count()
    assert gold(spark, root, "fact_fraud_signals").count() > 0
    for _ in range(2):  # replaced, not appended
        run_gold(spark, f"{tmp_dir}/silver", f"{root}2", 2024, 1, 2, fact_mode="replace_day")
    day = read_partitioned(spark, f"{tmp_dir}/silver", 2024, 1, 2)
    assert gold(spark, f"{root}2", "fact_transactions").count() == day.count() > 0
    # merchant_id alone is not unique in dim_merchant
    dm = dim_merchant(silver_all(spark, SF))
    assert dm.count() > dm.select("merchant_id").distinct().count()
    with pytest.raises(ValueError):
        run_gold(spark, f"{tmp_dir}/silver", "jdbc:none:x", fact_mode="replace_day")
    with pytest.raises(FileNotFoundError):
        run_gold(spark, f"{tmp_dir}/silver", root, 1999, 1, 1)


def test_an_unreachable_database_is_an_error_not_an_empty_table(spark):
    from ledgerlake.plans.gold import existing_table

    with pytest.raises(Exception, match="[Nn]o suitable driver"):
        existing_table(spark, "dim_card", "jdbc:nowhere://host/db", {})


class Writer:
    """Records the calls of a DataFrame writer or reader."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args):
            self.calls[args[0] if name == "option" else name] = args[-1] if args else None
            return self

        return call


def test_jdbc_options():
    from types import SimpleNamespace

    from ledgerlake.sinks.jdbc import read_jdbc, write_jdbc

    writer = Writer()
    df = SimpleNamespace(write=writer, repartition=lambda n: SimpleNamespace(write=writer, n=n))
    write_jdbc(df, "t", "jdbc:x", user="u", mode="overwrite", num_partitions=4)
    assert {"url": "jdbc:x", "dbtable": "t", "mode": "overwrite", "truncate": "true", "numPartitions": 4, "user": "u"}.items() <= writer.calls.items()
    assert "save" in writer.calls and "password" not in writer.calls
    reader = Writer()
    spark = SimpleNamespace(read=reader)
    read_jdbc(spark, "t", "jdbc:x", partition_column="date_key", lower_bound=1, upper_bound=9, num_partitions=4)
    assert {"partitionColumn": "date_key", "lowerBound": "1", "upperBound": "9", "numPartitions": 4}.items() <= reader.calls.items()
    with pytest.raises(ValueError):
        read_jdbc(spark, "t", "jdbc:x", partition_column="date_key")


def test_kafka_options():
    from types import SimpleNamespace

    from ledgerlake.sinks.messages import write_messages
    from ledgerlake.sources.transport import kafka_options

    assert kafka_options("h:1", "raw") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "raw", "startingOffsets": "earliest", "failOnDataLoss": "true"
    }
    assert kafka_options("h:1", "raw", "latest", False)["failOnDataLoss"] == "false"
    writer = Writer()
    write_messages(SimpleNamespace(write=writer), "kafka", topic="dead", bootstrap="h:1")
    assert writer.calls["format"] == "kafka" and writer.calls["topic"] == "dead"
    assert writer.calls["kafka.bootstrap.servers"] == "h:1"


def test_structural_path_is_required():
    with pytest.raises((TypeError, ValueError)):
        BronzeTargets("b")
    with pytest.raises(ValueError):
        BronzeTargets("b", "")


def test_another_run_with_the_same_batch_ids_loses_nothing(spark, tmp_dir):
    from ledgerlake.plans.catalog import payments

    p = payments(spark, SF)
    parts = [p.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == i) for i in range(3)]
    targets = BronzeTargets(f"{tmp_dir}/bronze", f"{tmp_dir}/dead_letter", "file", dead_letter_path=f"{tmp_dir}/dl", replay_safe=True)
    counts = [process_batch(x, b, targets, FIXTURE_CONFIG, run_id=r) for x, b, r in zip(parts, (0, 1, 0), ("a", "a", "b"))]
    assert spark.read.parquet(targets.bronze_path).count() == sum(c["valid"] for c in counts)
    assert spark.read.json(f"{tmp_dir}/dl/run=*/batch=*").count() == sum(c["dead_letter"] for c in counts)
    assert spark.read.json(f"{tmp_dir}/dead_letter/run=*/batch=*").count() == sum(c["unparseable"] for c in counts)


def test_a_silver_day_that_becomes_empty(spark, tmp_dir, payments_df):
    from ledgerlake.plans.bronze import bronze_rows
    from ledgerlake.sinks.parquet import write_day, write_partitioned

    rows = [payment(tid="a", ts="2026-05-29 06:39:15"), payment(tid="b", ts="2026-05-30 06:39:15")]
    bronze = bronze_rows(enrich(payments_df(rows)))
    write_partitioned(bronze, f"{tmp_dir}/bronze")
    run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver")
    write_day(bronze.limit(0), f"{tmp_dir}/bronze", 2026, 5, 29)
    run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", 2026, 5, 29)
    assert [r.transaction_id for r in read_partitioned(spark, f"{tmp_dir}/silver").collect()] == ["b"]
    with pytest.raises(FileNotFoundError):
        run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", 2026, 6, 1)
    assert read_partitioned(spark, f"{tmp_dir}/silver", 2026, 6, 1).count() == 0


def test_cli_file_transport_end_to_end(spark, tmp_dir):
    from ledgerlake.cli import main
    from ledgerlake.plans.catalog import payments
    from ledgerlake.sources.fixtures import messages_from_payments

    messages_from_payments(payments(spark, SF)).write.json(f"{tmp_dir}/inbox")
    main(["bronze", "--transport", "file", "--inbox", f"{tmp_dir}/inbox", "--dead-letter-path", f"{tmp_dir}/dl",
          "--bronze-path", f"{tmp_dir}/lake/bronze", "--checkpoint-path", f"{tmp_dir}/ckpt", "--available-now"])
    main(["silver", "--bronze-path", f"{tmp_dir}/lake/bronze", "--silver-path", f"{tmp_dir}/lake/silver"])
    main(["gold", "--silver-path", f"{tmp_dir}/lake/silver", "--parquet-path", f"{tmp_dir}/lake/gold"])
    assert spark.read.parquet(f"{tmp_dir}/lake/bronze").count() > 0
    assert spark.read.json(f"{tmp_dir}/lake/dead_letter/run=*/batch=*").count() > 0  # unparseable timestamps
    assert gold(spark, f"{tmp_dir}/lake/gold", "fact_settlement_daily").count() > 0


def test_replay_safe_bronze(spark, tmp_dir):
    from ledgerlake.plans.catalog import payments

    targets = BronzeTargets(f"{tmp_dir}/bronze", f"{tmp_dir}/dead_letter", "file",
                            dead_letter_path=f"{tmp_dir}/dl", replay_safe=True)
    p = payments(spark, SF)
    c = process_batch(p, 3, targets, FIXTURE_CONFIG, run_id="r")
    process_batch(p, 3, targets, FIXTURE_CONFIG, run_id="r")  # replay of batch 3
    bronze = spark.read.parquet(targets.bronze_path)
    assert bronze.count() == c["valid"] and "bronze_batch" in bronze.columns
    assert "bronze_batch" not in silver_transform(bronze).columns
    process_batch(p, 4, targets, FIXTURE_CONFIG, run_id="r")  # a new batch appends
    assert spark.read.parquet(targets.bronze_path).count() == 2 * c["valid"]


def test_full_silver_rebuild_file_count(spark, tmp_dir):
    import glob

    from ledgerlake.plans.catalog import payments

    targets = BronzeTargets(f"{tmp_dir}/bronze", f"{tmp_dir}/dead_letter", "file", dead_letter_path=f"{tmp_dir}/dl")
    process_batch(payments(spark, "/root/testdata/sf0.01"), 0, targets, FIXTURE_CONFIG)
    run_silver(spark, targets.bronze_path, f"{tmp_dir}/silver")
    days = spark.read.parquet(f"{tmp_dir}/silver").select("year", "month", "day").distinct().count()
    files = glob.glob(f"{tmp_dir}/silver/year=*/month=*/day=*/*.parquet")
    # range-partitioned by date: about one file per day, not one per day per task
    assert len(files) <= days + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_day_scoped_gold_merges_dimensions(spark, tmp_dir):
    """Day-scoped Gold runs add their dimension rows without replacing other
    days' rows, and a re-run inserts nothing twice."""
    from pyspark.sql import functions as F

    from ledgerlake.plans.catalog import silver_all
    from ledgerlake.plans.gold import run_gold
    from ledgerlake.sinks.parquet import write_partitioned

    write_partitioned(silver_all(spark, SF), f"{tmp_dir}/silver", mode="overwrite")
    url = f"{tmp_dir}/gold"
    for y, m, d in [(2024, 1, 2), (2024, 1, 3), (2024, 1, 2)]:
        written = run_gold(spark, f"{tmp_dir}/silver", url, y, m, d, blacklist=("M11", "M22"))
        assert written["dim_card"] == "merge"
    both = read_partitioned(spark, f"{tmp_dir}/silver").filter(F.col("day").isin(2, 3) & (F.col("month") == 1))
    for name, cols in [("dim_card", ["card_hash"]), ("dim_merchant", ["merchant_id", "mcc", "country"])]:
        got = gold(spark, url, name)
        assert got.count() == got.distinct().count() == both.select(*cols).distinct().count()
    assert gold(spark, url, "dim_date").count() == 2


def test_gold_job_scoped_to_tables(spark, tmp_dir):
    from ledgerlake.plans.catalog import silver_all
    from ledgerlake.plans.gold import run_gold
    from ledgerlake.sinks.parquet import write_partitioned
    from ledgerlake.sources.tables import path_exists

    write_partitioned(silver_all(spark, SF), f"{tmp_dir}/silver", mode="overwrite")
    assert run_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold", tables=["dim_card"]) == {"dim_card": "overwrite"}
    assert path_exists(spark, f"{tmp_dir}/gold/dim_card") and not path_exists(spark, f"{tmp_dir}/gold/dim_date")
    with pytest.raises(ValueError):
        run_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold", tables=["dim_card", "dim_cards"])


def test_bronze_writers_share_all_rows_of_the_batch(spark, tmp_dir):
    """A writer reads every cached row of its part, also where few rows are valid."""
    rows = spark.range(0, 40, 1, 4).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
        F.lit("2026-05-29 06:39:15").alias("ts_event"),
        F.lit("C1").alias("card_hash"), F.lit("M1").alias("merchant_id"), F.lit(100.0).alias("amount"),
        F.lit("USD").alias("currency"), F.lit("5411").alias("mcc"), F.lit("POS").alias("channel"),
        F.when(F.col("id") % 10 == 0, "APPROVED").otherwise("DECLINED").alias("auth_result"),
        F.lit("Tokyo, Japan").alias("location"),
    )
    targets = BronzeTargets(
        f"{tmp_dir}/bronze", f"{tmp_dir}/structural", dead_letter_transport="file",
        dead_letter_path=f"{tmp_dir}/dead", rows_per_task=10,
    )
    cfg = DEFAULT_CONFIG.with_(rule_names=("high_amount", "blacklisted", "bank_declined"))
    assert process_batch(rows, 0, targets, cfg)["valid"] == 4
    bronze = spark.read.parquet(targets.bronze_path)
    assert bronze.count() == 4 and len(bronze.inputFiles()) == 4
