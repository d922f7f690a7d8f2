"""Streaming: file transport + availableNow, restart, batch-local windows, alerts."""

import json
import os

from pyspark.sql import functions as F

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG, PAYMENT_COLUMNS
from ledgerlake.plans.bronze import BronzeTargets
from ledgerlake.sources.transport import decode_payload, read_raw_stream
from ledgerlake.streaming.alerts import read_card_alerts, start_card_alerts
from ledgerlake.streaming.bronze_stream import start_bronze_stream


def _write_messages(spark, rows, path):
    msgs = [(r[2], json.dumps(dict(zip(PAYMENT_COLUMNS, r)))) for r in rows]
    spark.createDataFrame(msgs, "key string, value string").coalesce(1).write.mode("append").json(path)


def _targets(d):
    return BronzeTargets(bronze_path=f"{d}/bronze", dead_letter_transport="file",
                         dead_letter_path=f"{d}/dl", structural_path=f"{d}/dead_letter")


def _run(spark, d, cfg=DEFAULT_CONFIG, max_files=None):
    counts = []
    q = start_bronze_stream(spark, read_raw_stream(spark, "file", path=f"{d}/inbox", max_files_per_trigger=max_files),
                            _targets(d), f"{d}/ckpt", cfg, available_now=True, on_batch=counts.append)
    q.awaitTermination()
    assert q.exception() is None
    return counts


def six_in_a_minute(card="C1"):
    return [payment(tid=f"{card}-{i}", card=card, ts=f"2026-05-29 06:39:{10 + i:02d}") for i in range(6)]


def test_one_batch_flags_velocity(spark, tmp_dir):
    _write_messages(spark, six_in_a_minute(), f"{tmp_dir}/inbox")
    counts = _run(spark, tmp_dir)
    assert sum(c["received"] for c in counts) == 6
    dl = spark.read.json(f"{tmp_dir}/dl/run=*/batch=*")
    assert dl.count() == 6 and "VELOCITY" in json.loads(dl.first().value)["fraud_reasons"]


def test_windows_are_batch_local_and_restart_resumes(spark, tmp_dir):
    rows = six_in_a_minute()
    _write_messages(spark, rows[:3], f"{tmp_dir}/inbox")
    c1 = _run(spark, tmp_dir)
    _write_messages(spark, rows[3:] + [payment(tid="bad", ts="nope", card="C9")], f"{tmp_dir}/inbox")
    c2 = _run(spark, tmp_dir)  # restart from the checkpoint: only the new file
    assert sum(c["received"] for c in c1) == 3 and sum(c["received"] for c in c2) == 4
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    assert bronze.count() == 6  # split over two batches: never 6 in one window
    st = spark.read.json(f"{tmp_dir}/dead_letter/run=*/batch=*")
    assert st.count() == 1 and st.first().raw_value is not None


def test_malformed_message_goes_to_structural_dead_letter(spark, tmp_dir):
    spark.createDataFrame([("k", "{oops")], "key string, value string").write.json(f"{tmp_dir}/inbox")
    _run(spark, tmp_dir)
    st = spark.read.json(f"{tmp_dir}/dead_letter/run=*/batch=*")
    assert st.first().raw_value == "{oops"
    assert not os.path.exists(f"{tmp_dir}/bronze")


def test_card_alerts_accumulate_across_batches(spark, tmp_dir):
    rows = six_in_a_minute()
    _write_messages(spark, rows[:3], f"{tmp_dir}/inbox")
    decoded = lambda: decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    for q in start_card_alerts(spark, decoded(), f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG, available_now=True):
        q.awaitTermination()
    _write_messages(spark, rows[3:], f"{tmp_dir}/inbox")
    for q in start_card_alerts(spark, decoded(), f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG, available_now=True):
        q.awaitTermination()
    alerts = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    assert len(alerts) == 1 and alerts[0].is_high_velocity and alerts[0].alert_reasons == "VELOCITY"


def test_card_alerts_with_rocksdb_state(spark, tmp_dir):
    _write_messages(spark, six_in_a_minute("C7"), f"{tmp_dir}/inbox")
    decoded = decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for q in start_card_alerts(spark, decoded, f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG,
                               available_now=True, state_store="rocksdb"):
        q.awaitTermination()
        assert q.exception() is None
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == old
    alerts = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    assert [a.card_hash for a in alerts] == ["C7"]


def test_card_alerts_roll_up_minutes_into_ten_minute_windows(spark, tmp_dir):
    """Original windows (1 and 10 minutes): one stateful query keeps per-minute
    state; the 10-minute rules are rolled up from it, across two batches, and
    equal the batch evaluation of every rule over the same rows."""
    from ledgerlake.operators.enrich import with_country, with_event_time
    from ledgerlake.operators.rules import rules_from_config
    from ledgerlake.operators.windows import window_groups
    from ledgerlake.streaming.alerts import rollup_duration

    assert rollup_duration(DEFAULT_CONFIG) == "1 minute"
    rows = (
        six_in_a_minute("V1")  # velocity in 06:39
        # cross-border: two countries in different minutes of [06:40, 06:50)
        + [payment(tid="X1", card="X", ts="2026-05-29 06:41:00", location="London, UK"),
           payment(tid="X2", card="X", ts="2026-05-29 06:48:59", location="Paris, France")]
        # not cross-border: the same two countries either side of 06:50
        + [payment(tid="Y1", card="Y", ts="2026-05-29 06:49:59", location="London, UK"),
           payment(tid="Y2", card="Y", ts="2026-05-29 06:50:00", location="Paris, France")]
        # decline rate: 2 of 3 declined, spread over three minutes of [07:00, 07:10)
        + [payment(tid=f"D{i}", card="D", ts=f"2026-05-29 07:0{2 * i}:00", auth=a)
           for i, a in enumerate(["DECLINED", "APPROVED", "DECLINED"])]
    )
    first, second = rows[::2], rows[1::2]  # every window is split over the two batches
    decoded = lambda: decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    for part in (first, second):
        _write_messages(spark, part, f"{tmp_dir}/inbox")
        queries = start_card_alerts(spark, decoded(), f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG,
                                    available_now=True)
        assert len(queries) == 1  # one source read, one state store
        for q in queries:
            q.awaitTermination()
            assert q.exception() is None
    alerts = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG)
    flags = [r.flag for r in rules_from_config(DEFAULT_CONFIG) if r.windowed]
    got = {(a.card_hash, a.window_start, f) for a in alerts.collect() for f in flags if a[f]}

    from ledgerlake.config import PAYMENT_SCHEMA

    static = with_country(with_event_time(spark.createDataFrame(rows, PAYMENT_SCHEMA)))
    want = set()
    for rule in (r for r in rules_from_config(DEFAULT_CONFIG) if r.windowed):
        want |= {(g.card_hash, g.window_start, rule.flag) for g in window_groups(static, rule).collect()}
    assert got == want
    assert {(c, f) for c, _, f in got} == {
        ("V1", "is_high_velocity"), ("X", "is_cross_border"), ("D", "is_high_decline_rate")
    }


def test_card_alerts_day_scoped_read(spark, tmp_dir):
    """Alert output is laid out by window date then batch: one day's read
    lists only that day and equals the full read restricted to the day."""
    import pytest

    rows = six_in_a_minute("A") + [
        payment(tid=f"B{i}", card="B", ts=f"2026-05-30 08:15:{10 + i:02d}") for i in range(6)
    ]
    _write_messages(spark, rows, f"{tmp_dir}/inbox")
    decoded = decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    for q in start_card_alerts(spark, decoded, f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG,
                               available_now=True):
        q.awaitTermination()
        assert q.exception() is None
    assert any(d.startswith("window_date=2026-05-30") for d in os.listdir(f"{tmp_dir}/alerts/buckets"))
    full = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG)
    day = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, 2026, 5, 30)
    assert [r.card_hash for r in day.collect()] == ["B"]
    assert sorted(full.filter(F.to_date("window_start") == "2026-05-30").collect()) == sorted(day.collect())
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, 2026, 6, 1).count() == 0
    with pytest.raises(ValueError):
        read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, 2026, 5, None)


def test_compaction_keeps_the_latest_versions(spark, tmp_dir):
    from ledgerlake.streaming.alerts import compact_card_alerts

    rows = six_in_a_minute("A")
    decoded = lambda: decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    for part in (rows[:3], rows[3:]):
        _write_messages(spark, part, f"{tmp_dir}/inbox")
        for q in start_card_alerts(spark, decoded(), f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG, available_now=True):
            q.awaitTermination()
    day = f"{tmp_dir}/alerts/buckets/window_date=2026-05-29"
    before = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    assert len([d for d in os.listdir(day) if d.startswith("batch_id=")]) == 2
    compact_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, "2026-05-29")
    spark.catalog.clearCache()
    assert len([d for d in os.listdir(day) if d.startswith("batch_id=")]) == 1
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect() == before
    compact_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, "2020-01-01")  # no such day: nothing to do


def test_late_rows_are_counted(spark, tmp_dir):
    from ledgerlake.streaming.alerts import rows_dropped_as_late

    decoded = lambda: decode_payload(read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox"), keep_raw=False)
    dropped = 0
    for ts in ("2026-05-29 12:00:00", "2026-05-29 12:00:01", "2026-05-29 01:00:00"):
        _write_messages(spark, [payment(ts=ts)], f"{tmp_dir}/inbox")
        for q in start_card_alerts(spark, decoded(), f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt", DEFAULT_CONFIG, available_now=True):
            q.awaitTermination()
            dropped += rows_dropped_as_late(q)
    assert dropped == 1


def test_table_scope_is_no_scope_for_a_stream(spark, tmp_dir):
    import pytest

    _write_messages(spark, [payment()], f"{tmp_dir}/inbox")
    with pytest.raises(ValueError):
        _run(spark, tmp_dir, DEFAULT_CONFIG.with_(window_scope="table"))


def _alerts(spark, d, **options):
    decoded = decode_payload(read_raw_stream(spark, "file", path=f"{d}/inbox"), keep_raw=False)
    for q in start_card_alerts(spark, decoded, f"{d}/alerts", f"{d}/ckpt", DEFAULT_CONFIG, available_now=True, **options):
        q.awaitTermination()
        assert q.exception() is None


def _days(folder):
    return sorted(x for x in os.listdir(folder) if x.startswith("window_date="))


def test_dates_behind_the_watermark_are_closed(spark, tmp_dir):
    from ledgerlake.streaming.alerts import compact_card_alerts

    rows = six_in_a_minute("A")
    buckets = f"{tmp_dir}/alerts/buckets"
    for part in (rows[:3], rows[3:], [payment(tid="n", card="N", ts="2026-05-31 12:00:00")]):
        _write_messages(spark, part, f"{tmp_dir}/inbox")
        _alerts(spark, tmp_dir)
    # The watermark is that of the batch before, so the next run closes the first day.
    assert _days(buckets) == ["window_date=2026-05-29", "window_date=2026-05-31"]
    before = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    _write_messages(spark, [payment(tid="m", card="N", ts="2026-05-31 12:00:01")], f"{tmp_dir}/inbox")
    _alerts(spark, tmp_dir)
    assert _days(buckets) == ["window_date=2026-05-31"] and _days(f"{buckets}/closed") == ["window_date=2026-05-29"]
    after = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    assert after == before and [r.card_hash for r in after] == ["A"]
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, 2026, 5, 29).collect() == after
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, 2026, 5, 30).count() == 0
    compact_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG, "2026-05-29")  # closed already: nothing to do
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect() == after


def test_a_close_that_failed_is_taken_up_again(spark, tmp_dir):
    from ledgerlake.streaming import alerts as A

    _write_messages(spark, six_in_a_minute("A"), f"{tmp_dir}/inbox")
    _alerts(spark, tmp_dir, close_dates=False)
    buckets, day = f"{tmp_dir}/alerts/buckets", "window_date=2026-05-29"
    before = read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    end = 1780099200000  # 2026-05-30 00:00:00 UTC
    assert A.close_alert_dates(spark, buckets, "1 minute", end - 1) == []
    # Left behind by a write that was cut off: no marker, so it does not count.
    spark.range(3).write.parquet(f"{buckets}/closed/{day}")
    os.remove(f"{buckets}/closed/{day}/_SUCCESS")
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect() == before
    # Cut off after the write, before the versions went: both are there, the date is read once.
    kept = A.delete_folder
    A.delete_folder = lambda *_: None
    try:
        assert A.close_alert_dates(spark, buckets, "1 minute", end) == ["2026-05-29"]
    finally:
        A.delete_folder = kept
    assert _days(buckets) == _days(f"{buckets}/closed") == [day]
    assert read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect() == before
    assert A.close_alert_dates(spark, buckets, "1 minute", end) == ["2026-05-29"]
    assert _days(buckets) == [] and read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect() == before
    assert A.close_alert_dates(spark, buckets, "1 minute", end) == []


def test_late_payments_are_kept(spark, tmp_dir):
    from ledgerlake.streaming.alerts import read_window_state

    late = [payment(tid=f"late{i}", ts="2026-05-29 01:00:00", card=c) for i, c in enumerate(["C1", "C1", "C2", None])]
    for rows in ([payment(ts="2026-05-29 12:00:00")], [payment(ts="2026-05-29 12:00:01")], late):
        _write_messages(spark, rows + [payment(tid="bad", ts="nope")], f"{tmp_dir}/inbox")
        _alerts(spark, tmp_dir, late_path=f"{tmp_dir}/late")
    kept = spark.read.json(f"{tmp_dir}/late/buckets/run=*/batch=*")
    assert sorted(r.transaction_id for r in kept.collect()) == ["late0", "late1", "late2"]
    assert {r.window_end for r in kept.collect()} == {"2026-05-29T01:01:00.000Z"} and "location" in kept.columns
    state = read_window_state(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()
    assert sum(r._wa_is_high_velocity_velocity_count for r in state) == 2


def test_last_window_end():
    from ledgerlake.streaming.alerts import DAY_MICROS, _last_window_end

    assert _last_window_end("1970-01-01", "1 minute") == _last_window_end("1970-01-01", "1 day") == DAY_MICROS
    assert _last_window_end("1970-01-01", "7 hours") == 28 * DAY_MICROS // 24


def test_cli_alerts(spark, tmp_dir):
    from ledgerlake.cli import main

    _write_messages(spark, six_in_a_minute("A"), f"{tmp_dir}/inbox")
    main(["alerts", "--transport", "file", "--inbox", f"{tmp_dir}/inbox", "--alerts-path", f"{tmp_dir}/alerts",
          "--late-path", f"{tmp_dir}/late", "--checkpoint-path", f"{tmp_dir}/ckpt", "--available-now"])
    assert [r.card_hash for r in read_card_alerts(spark, f"{tmp_dir}/alerts", DEFAULT_CONFIG).collect()] == ["A"]
    assert not os.path.exists(f"{tmp_dir}/late")
