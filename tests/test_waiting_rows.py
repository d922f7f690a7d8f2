"""Payments of a stateful stream wait in files; the stream's state holds the buckets of the open windows only."""

import glob
import os

import pytest

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG, PAYMENT_SCHEMA
from ledgerlake.operators.windows import firing_buckets, flag_by_buckets, flag_windows
from ledgerlake.sources.transport import read_raw_stream
from ledgerlake.streaming.bronze_stream import WAITING_FOLDER, start_bronze_stream
from ledgerlake.streaming.window_verdicts import BUCKET, SETTLED, WINDOW_END, hold, ready_rows, settled_payments
from test_window_verdicts import STATEFUL, everything, run, stage, targets

BURST = [payment(tid=f"T{i}", ts=f"2026-05-29 06:39:{10 + i:02d}") for i in range(6)]
LATER = payment(tid="later", card="C2", ts="2026-05-29 07:30:00")


def held(d):
    return sorted(os.path.basename(x) for x in glob.glob(f"{d}/ckpt/{WAITING_FOLDER}/batch=*"))


def test_payments_do_not_go_through_the_state(spark, tmp_dir):
    stage(spark, BURST, f"{tmp_dir}/inbox")
    q = start_bronze_stream(spark, read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), targets(tmp_dir),
                            f"{tmp_dir}/ckpt", STATEFUL, available_now=True)
    q.awaitTermination()
    operators = [o for p in q.recentProgress for o in p["stateOperators"]]
    assert {o["operatorName"] for o in operators} == {"stateStoreSave"}
    assert max(len(p["stateOperators"]) for p in q.recentProgress) == 1
    assert max(o["numRowsTotal"] for o in operators) == 1  # six payments of one card and minute


def test_a_batch_that_fails_while_it_settles_is_replayed(spark, tmp_dir):
    for part in (BURST[:3], BURST[3:]):
        stage(spark, part, f"{tmp_dir}/inbox")
        run(spark, tmp_dir)
    with open(f"{tmp_dir}/dl", "w"):
        pass  # the dead letter cannot be written
    stage(spark, [LATER], f"{tmp_dir}/inbox")
    with pytest.raises(Exception):
        run(spark, tmp_dir)
    os.unlink(f"{tmp_dir}/dl")
    run(spark, tmp_dir)
    assert sorted(everything(spark, tmp_dir)) == [(f"T{i}", "dead_letter", (True, False, False)) for i in range(6)]


def test_folders_are_deleted_once_nothing_in_them_waits(spark, tmp_dir):
    stage(spark, BURST, f"{tmp_dir}/inbox")
    run(spark, tmp_dir)
    stage(spark, [LATER], f"{tmp_dir}/inbox")
    run(spark, tmp_dir)  # the batch without rows at its end settles the burst
    first = held(tmp_dir)
    assert "batch=0" in first
    stage(spark, [payment(tid="last", card="C3", ts="2026-05-29 07:31:00")], f"{tmp_dir}/inbox")
    run(spark, tmp_dir)
    now = held(tmp_dir)
    assert "batch=0" not in now and len(now) < len(first) + 1
    stage(spark, [payment(tid="end", card="C4", ts="2026-05-29 12:00:00")], f"{tmp_dir}/inbox")
    run(spark, tmp_dir)
    assert {x[0] for x in everything(spark, tmp_dir)} == {f"T{i}" for i in range(6)} | {"later", "last"}


def test_each_window_end_belongs_to_one_batch(spark, tmp_dir):
    """Ends on the watermarks themselves: up to that of the batch before late, up to that of the batch settled, then waiting."""
    cfg = DEFAULT_CONFIG.with_(rule_names=("high_velocity",), velocity_window="1 minute")
    rows = [payment(tid=str(i), ts=f"2026-01-01 00:{i:02d}:00") for i in range(5)] + [payment(tid="none", card=None)]
    df = spark.createDataFrame(rows, PAYMENT_SCHEMA)
    batch = df.selectExpr("*", f"if(card_hash is null, null, to_timestamp(ts_event) + interval 1 minute) AS {WINDOW_END}")
    bucket = "struct<_wk_card string, _wk_bkt timestamp, _wa_is_high_velocity_velocity_count bigint>"
    batch = batch.selectExpr("*", f"{WINDOW_END} IS NULL AS {SETTLED}", f"CAST(NULL AS {bucket}) AS {BUCKET}")
    root, minute, start = f"{tmp_dir}/w", 60_000, 1767225600000  # 2026-01-01

    def ids(frame):
        return sorted(r.transaction_id for r in frame.collect())

    hold(batch, root, 0, start + minute)
    hold(batch, root, 0, start + minute)  # a replay
    late = ready_rows(spark, batch.schema, root, 0, start + minute)
    assert ids(late) == ["0", "none"]
    assert ids(settled_payments(spark, batch.schema, root, 0, (start + minute, start + 3 * minute), cfg)) == ["1", "2", "none"]
    hold(batch.limit(0), root, 1, start + 3 * minute)
    assert ids(settled_payments(spark, batch.schema, root, 1, (start + 3 * minute, start + 9 * minute), cfg)) == ["3", "4"]
    hold(batch.limit(0), root, 2, start + 9 * minute)
    assert not os.path.exists(f"{root}/batch=0")


def test_flags_from_kept_buckets_equal_those_of_the_rows(spark):
    from pyspark.sql import functions as F

    from ledgerlake.functions import bucket_start, country_of, parse_event_time
    from ledgerlake.operators.windows import _named_aggs, rolled_up
    from ledgerlake.streaming.window_verdicts import window_rules

    rows = BURST + [payment(tid=f"B{i}", card="B", ts=f"2026-05-29 06:{41 + i}:00", location=x, auth="DECLINED")
                    for i, x in enumerate(("Paris, France", "Oslo, Norway"))] + [payment(tid="null", card=None)]
    df = spark.createDataFrame(rows, PAYMENT_SCHEMA)
    df = df.withColumns({"event_time": parse_event_time("ts_event", DEFAULT_CONFIG.ts_format), "country": country_of("location")})
    rules = window_rules(DEFAULT_CONFIG)
    base = rolled_up(rules)
    groups = (
        df.filter("card_hash IS NOT NULL")
        .groupBy(F.col("card_hash").alias("_wk_card"), bucket_start("event_time", base).alias("_wk_bkt"))
        .agg(*[a.alias(n) for n, a in _named_aggs(rules).items()])
    )
    assert firing_buckets(df, rules, base).count() == 3
    got, want = flag_by_buckets(df, groups, rules), flag_windows(df, rules)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
