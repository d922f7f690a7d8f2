"""Fraud rules, composition and window strategies (edge rows of FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG, FIXTURE_CONFIG
from ledgerlake.operators.enrich import with_event_time
from ledgerlake.plans.bronze import enrich
from ledgerlake.operators.rules import (
    FraudDetector,
    bank_declined_rule,
    blacklisted_merchant_rule,
    cross_border_rule,
    high_amount_rule,
    high_decline_rate_rule,
    high_velocity_rule,
    rules_from_config,
)

STRATEGIES = ["auto", "join", "window", "broadcast"]


def flags(df, flag):
    return {r.transaction_id: r[flag] for r in df.select("transaction_id", flag).collect()}


def test_high_amount_strict(payments_df):
    rows = [payment(tid="a", amount=10000.00), payment(tid="b", amount=10000.01), payment(tid="c", amount=None)]
    out = flags(high_amount_rule().apply(payments_df(rows)), "is_high_amount")
    assert out == {"a": False, "b": True, "c": None}


def test_blacklist_and_declined(payments_df):
    rows = [payment(tid="a", merchant="M11111", auth="DECLINED"), payment(tid="b", merchant=None, auth="declined")]
    df = payments_df(rows)
    assert flags(blacklisted_merchant_rule().apply(df), "is_blacklisted") == {"a": True, "b": None}
    assert flags(bank_declined_rule().apply(df), "is_bank_declined") == {"a": True, "b": False}


def _minute_rows(n, base="2026-05-29 06:39:", card="C1", start=0, **kw):
    return [payment(tid=f"{card}-{start + i}", ts=f"{base}{start + i:02d}", card=card, **kw) for i in range(n)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_velocity_threshold(payments_df, strategy):
    rule = high_velocity_rule()
    five = with_event_time(payments_df(_minute_rows(5, card="C5")))
    six = with_event_time(payments_df(_minute_rows(6, card="C6")))
    det = FraudDetector([rule], strategy=strategy, composites=False)
    assert not any(flags(det.apply(five), "is_high_velocity").values())
    assert all(flags(det.apply(six), "is_high_velocity").values())


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_velocity_tumbling_and_half_open(payments_df, strategy):
    # 3 in 06:39, 3 in 06:40: never 6 in one bucket
    rows = _minute_rows(3, base="2026-05-29 06:39:", start=50) + _minute_rows(3, base="2026-05-29 06:40:", start=0)
    det = FraudDetector([high_velocity_rule()], strategy=strategy, composites=False)
    assert not any(flags(det.apply(with_event_time(payments_df(rows))), "is_high_velocity").values())
    # exactly at bucket end belongs to the next bucket
    rows = _minute_rows(5, base="2026-05-29 06:39:", start=10) + [payment(tid="edge", ts="2026-05-29 06:40:00")]
    assert not any(flags(det.apply(with_event_time(payments_df(rows))), "is_high_velocity").values())


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_card_never_flagged(payments_df, strategy):
    rows = [payment(tid=str(i), ts=f"2026-05-29 06:39:{i:02d}", card=None, location=loc)
            for i, loc in enumerate(["New York, USA", "London, UK"] * 3)]
    det = FraudDetector([high_velocity_rule(), cross_border_rule()], strategy=strategy, composites=False)
    out = det.apply(with_event_time(payments_df(rows))).collect()
    assert not any(r.is_high_velocity or r.is_cross_border for r in out)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_cross_border(payments_df, strategy):
    same = [payment(tid="a", ts="2026-05-29 06:01:00", location="New York, USA"),
            payment(tid="b", ts="2026-05-29 06:05:00", location="London, UK")]
    adjacent = [payment(tid="c", ts="2026-05-29 06:09:59", card="C2", location="New York, USA"),
                payment(tid="d", ts="2026-05-29 06:10:00", card="C2", location="London, UK")]
    unknown = [payment(tid="e", ts="2026-05-29 07:01:00", card="C3", location="Paris"),
               payment(tid="f", ts="2026-05-29 07:02:00", card="C3", location="New York, USA")]
    det = FraudDetector([cross_border_rule()], strategy=strategy, composites=False)
    out = flags(det.apply(with_event_time(payments_df(same + adjacent + unknown))), "is_cross_border")
    assert out == {"a": True, "b": True, "c": False, "d": False, "e": True, "f": True}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_decline_rate(payments_df, strategy):
    half = [payment(tid="a1", ts="2026-05-29 06:01:00", card="A", auth="DECLINED"),
            payment(tid="a2", ts="2026-05-29 06:02:00", card="A")]
    two_of_three = [payment(tid=f"b{i}", ts=f"2026-05-29 06:0{i}:00", card="B", auth=a)
                    for i, a in enumerate(["DECLINED", "DECLINED", "APPROVED"])]
    det = FraudDetector([high_decline_rate_rule()], strategy=strategy, composites=False)
    out = flags(det.apply(with_event_time(payments_df(half + two_of_three))), "is_high_decline_rate")
    assert out == {"a1": False, "a2": False, "b0": True, "b1": True, "b2": True}


def test_reasons_and_three_valued_or(payments_df):
    rows = [payment(tid="two", amount=20000.0, merchant="M11111"),
            payment(tid="none"),
            payment(tid="nullamt", amount=None),
            payment(tid="nulldecl", amount=None, auth="DECLINED")]
    det = FraudDetector(rules_from_config(DEFAULT_CONFIG))
    out = {r.transaction_id: r for r in det.apply(with_event_time(payments_df(rows))).collect()}
    assert out["two"].fraud_reasons == "HIGH_AMOUNT, BLACKLISTED_MERCHANT" and out["two"].is_fraud is True
    assert out["none"].fraud_reasons == "" and out["none"].is_fraud is False
    assert out["nullamt"].is_fraud is None
    assert out["nulldecl"].is_fraud is True


def test_rules_never_change_row_count(spark):
    from ledgerlake.plans.catalog import payments

    p = payments(spark, "/root/testdata/sf0.001")
    n = p.count()
    for strategy in STRATEGIES:
        assert enrich(p, FIXTURE_CONFIG.with_(window_strategy=strategy)).count() == n


def test_strategies_agree_on_fixture(spark):
    from ledgerlake.plans.catalog import payments

    p = payments(spark, "/root/testdata/sf0.001")
    cols = ["transaction_id", "is_high_velocity", "is_cross_border", "is_high_decline_rate", "fraud_reasons"]
    base = enrich(p, FIXTURE_CONFIG.with_(window_strategy="window")).select(cols)
    for strategy in ["auto", "join", "broadcast"]:
        other = enrich(p, FIXTURE_CONFIG.with_(window_strategy=strategy)).select(cols)
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


def test_broadcast_fallback_when_threshold_disabled(spark):
    from ledgerlake.plans.catalog import payments

    p = payments(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cfg = FIXTURE_CONFIG.with_(window_strategy="broadcast")
    try:
        df = enrich(p, cfg)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        n = df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert n == p.count()
    plan = enrich(p, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_duplicate_flags_rejected():
    with pytest.raises(ValueError):
        FraudDetector([high_amount_rule(), high_amount_rule()])


def test_blacklist_table_equals_list(spark, payments_df):
    rows = [payment(tid="a", merchant="M11"), payment(tid="b", merchant=None), payment(tid="c", merchant="M3")]
    df = payments_df(rows)
    table = spark.createDataFrame([("M11",), ("M22",), ("M11",), (None,)], "merchant_id string")
    by_table = flags(blacklisted_merchant_rule(table).apply(df), "is_blacklisted")
    by_list = flags(blacklisted_merchant_rule(["M11", "M22"]).apply(df), "is_blacklisted")
    assert by_table == by_list == {"a": True, "b": None, "c": False}
    assert blacklisted_merchant_rule(table).apply(df).count() == 3  # no fan-out from duplicate keys


def test_enrich_runs_no_job_and_writes_nothing(spark, payments_df):
    import os

    from ledgerlake.session import scratch_root

    root = f"{scratch_root(spark)}/ledgerlake"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    rows = [payment(tid=f"T{i}", ts=f"2026-05-29 06:39:{10 + i:02d}") for i in range(6)]
    df = with_event_time(payments_df(rows))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = {s: FraudDetector([high_velocity_rule()], strategy=s, composites=False).apply(df) for s in STRATEGIES}
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
    assert all(all(flags(x, "is_high_velocity").values()) for x in out.values())


def test_window_scope(spark, payments_df):
    from ledgerlake.config import DEFAULT_CONFIG

    with pytest.raises(ValueError):
        DEFAULT_CONFIG.with_(window_scope="week")
    rows = [payment(tid=f"T{i}", ts=f"2026-05-29 06:39:{10 + i:02d}") for i in range(6)]
    df = payments_df(rows)
    for scope in ("micro_batch", "table"):
        got = enrich(df, DEFAULT_CONFIG.with_(window_scope=scope))
        assert set(flags(got, "is_high_velocity").values()) == {True}
    # Nothing may pass as unflagged because its flags were never decided.
    with pytest.raises(ValueError, match="is_high_velocity"):
        enrich(df, DEFAULT_CONFIG.with_(window_scope="stateful"))


def test_jobs_want_utc(spark, payments_df, tmp_dir):
    from ledgerlake.plans.gold import run_gold
    from ledgerlake.plans.silver import run_silver

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for job in (
            lambda: enrich(payments_df([payment()])),
            lambda: run_silver(spark, f"{tmp_dir}/b", f"{tmp_dir}/s"),
            lambda: run_gold(spark, f"{tmp_dir}/s", f"{tmp_dir}/g"),
        ):
            with pytest.raises(ValueError, match="UTC"):
                job()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
