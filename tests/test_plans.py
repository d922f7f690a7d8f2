"""Physical-plan shape: the properties the design relies on at scale."""

from contextlib import contextmanager

from ledgerlake.config import FIXTURE_CONFIG
from ledgerlake.operators.dedup import keep_first
from ledgerlake.plans.bronze import enrich
from ledgerlake.plans.catalog import payments, silver_all
from ledgerlake.operators.gold import fact_settlement_daily

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df) -> str:
    """Final adaptive plan: run this DataFrame's own physical plan (rows are
    counted on the executors, nothing is collected), then print it."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    text = qe.executedPlan().toString()
    assert "isFinalPlan=true" in text or "AdaptiveSparkPlan" not in text
    return text


def test_window_rules_partial_hash_aggregate_and_broadcast(spark):
    df = enrich(payments(spark, SF), FIXTURE_CONFIG.with_(window_strategy="broadcast"))
    p = optimized_plan(df)
    assert "SortAggregate" not in p
    assert "partial_count" in p  # map-side combine before the shuffle
    final = p.split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert final.count("Exchange hashpartitioning") == 1  # the aggregate's; rows not shuffled


def test_two_durations_are_one_aggregate_and_one_join(spark):
    from ledgerlake.config import DEFAULT_CONFIG

    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(enrich(payments(spark, SF), DEFAULT_CONFIG))
    assert p.count("FileScan") == 2 and p.count("SortMergeJoin") == 1
    assert "SortAggregate" not in p and "rebalance" in p.lower()


def test_window_rules_join_form_is_equi_join(spark):
    df = enrich(payments(spark, SF), FIXTURE_CONFIG.with_(window_strategy="join"))
    p = plan(df)
    assert "LeftOuter" in p and "SortAggregate" not in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_dedup_has_partial_group_limit(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_settlement_partial_aggregation(spark):
    p = plan(fact_settlement_daily(silver_all(spark, SF)))
    assert "partial_sum" in p and "partial_avg" in p and "partial_max" in p


def test_scan_prunes_columns(spark):
    df = payments(spark, SF).select("transaction_id")
    p = plan(df)
    assert "ReadSchema: struct<event_id:bigint>" in p


def test_no_python_udf_in_pipeline(spark):
    df = enrich(payments(spark, SF), FIXTURE_CONFIG)
    p = plan(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_auto_is_the_join_at_every_size(spark):
    import re

    p = payments(spark, SF)
    bare = lambda strategy: re.sub(
        r"#\d+L?|plan_id=\d+|\(\d+\)", "", plan(enrich(p, FIXTURE_CONFIG.with_(window_strategy=strategy)))
    )
    assert bare("auto") == bare("join")


def _hot_card_payments(spark, sf):
    """A third of the payments moved to one card and one day (one hot
    (card, bucket) group), spread over several input tasks like a
    multi-file table (AQE splits a hot partition by ranges of map tasks)."""
    from pyspark.sql import functions as F

    p = payments(spark, sf)
    hot = F.abs(F.hash("transaction_id")) % 3 == 0
    return p.withColumns(
        {
            "card_hash": F.when(hot, F.lit("CHOT")).otherwise(F.col("card_hash")),
            "ts_event": F.when(hot & (F.col("ts_event") != "bad-ts"), F.lit("2024-01-15 12:00:00")).otherwise(
                F.col("ts_event")
            ),
        }
    ).repartition(8)


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextmanager
def session_conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_group_is_split_by_adaptive_skew_join(spark):
    """Shuffle-join form, broadcast off: AQE splits the hot group's partition
    on the row side; the flags equal the window form."""
    with session_conf(spark, SKEW_SETTINGS):
        p = _hot_card_payments(spark, "/root/testdata/sf0.01")
        joined = enrich(p, FIXTURE_CONFIG.with_(window_strategy="join"))
        final = optimized_plan(joined)
        assert "SortMergeJoin" in final and "skew=true" in final
        cols = ["transaction_id", "is_high_velocity", "is_cross_border", "is_high_decline_rate"]
        windowed = enrich(p, FIXTURE_CONFIG.with_(window_strategy="window")).select(cols)
        assert joined.select(cols).exceptAll(windowed).count() == 0
        assert windowed.exceptAll(joined.select(cols)).count() == 0


def test_hot_blacklisted_merchant_is_split_by_adaptive_skew_join(spark):
    """Blacklist table too large to broadcast (threshold off) and a merchant
    with a third of the payments: the lookup join splits its partition."""
    from pyspark.sql import functions as F

    from ledgerlake.operators.rules import blacklisted_merchant_rule

    with session_conf(spark, SKEW_SETTINGS):
        p = payments(spark, "/root/testdata/sf0.01")
        p = p.withColumn(
            "merchant_id",
            F.when(F.abs(F.hash("transaction_id")) % 3 == 0, F.lit("M11")).otherwise(F.col("merchant_id")),
        ).repartition(8)
        table = spark.createDataFrame([("M11",), ("M22",)], "merchant_id string")
        flagged = blacklisted_merchant_rule(table).apply(p)
        final = optimized_plan(flagged)
        assert "SortMergeJoin" in final and "skew=true" in final
        listed = blacklisted_merchant_rule(("M11", "M22")).apply(p)
        cols = ["transaction_id", "is_blacklisted"]
        assert flagged.select(cols).exceptAll(listed.select(cols)).count() == 0
        assert listed.select(cols).exceptAll(flagged.select(cols)).count() == 0
