"""Window rules decided inside the stream: rows wait for their windows, late ones are kept apart."""

import json
import os
import random

import pytest

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG, PAYMENT_COLUMNS, PAYMENT_SCHEMA
from ledgerlake.plans.bronze import BronzeTargets, enrich
from ledgerlake.sinks.manifest import read_committed, read_manifest
from ledgerlake.sources.transport import read_raw_stream
from ledgerlake.streaming.bronze_stream import start_bronze_stream
from ledgerlake.streaming.window_verdicts import (
    late_watermark,
    longest_window,
    settled_or_late,
    settled_rows,
    window_rules,
)

STATEFUL = DEFAULT_CONFIG.with_(window_scope="stateful")
FLAGS = ("is_high_velocity", "is_cross_border", "is_high_decline_rate")


def stage(spark, rows, path):
    msgs = [(r[2], json.dumps(dict(zip(PAYMENT_COLUMNS, r)))) for r in rows]
    spark.createDataFrame(msgs, "key string, value string").coalesce(1).write.mode("append").json(path)


def targets(d, **kw):
    return BronzeTargets(bronze_path=f"{d}/bronze", dead_letter_transport="file", dead_letter_path=f"{d}/dl",
                         structural_path=f"{d}/structural", late_path=f"{d}/late", **kw)


def run(spark, d, cfg=STATEFUL, watermark="10 minutes", **kw):
    counts = []
    q = start_bronze_stream(spark, read_raw_stream(spark, "file", path=f"{d}/inbox"), targets(d, **kw), f"{d}/ckpt", cfg,
                            available_now=True, watermark=watermark, on_batch=counts.append)
    q.awaitTermination()
    assert q.exception() is None
    return counts


def read_json(spark, path, schema):
    parts = [x for x in (os.listdir(path) if os.path.exists(path) else [])]
    return spark.read.schema(schema).json(f"{path}/run=*/batch=*").collect() if parts else []


def everything(spark, d):
    """id -> (route, window flags) of every row written."""
    out = []
    if os.path.exists(f"{d}/bronze"):
        out += [(r.transaction_id, "valid", tuple(r[f] for f in FLAGS)) for r in spark.read.parquet(f"{d}/bronze").collect()]
    for r in read_json(spark, f"{d}/dl", "value string"):
        v = json.loads(r.value)
        out.append((v["transaction_id"], "dead_letter", tuple(v[f] for f in FLAGS)))
    for name in ("structural", "late"):
        out += [(r.transaction_id, name, None) for r in read_json(spark, f"{d}/{name}", "transaction_id string")]
    return out


def test_rows_wait_for_their_windows(spark, tmp_dir):
    rows = [payment(tid=f"T{i}", ts=f"2026-05-29 06:39:{10 + i:02d}") for i in range(6)]
    for part in (rows[:2], rows[2:4], rows[4:]):  # no batch has six of a minute
        stage(spark, part, f"{tmp_dir}/inbox")
        run(spark, tmp_dir)
    assert everything(spark, tmp_dir) == []  # the window is open
    stage(spark, [payment(tid="later", card="C2", ts="2026-05-29 07:30:00")], f"{tmp_dir}/inbox")
    run(spark, tmp_dir)
    assert sorted(everything(spark, tmp_dir)) == [(f"T{i}", "dead_letter", (True, False, False)) for i in range(6)]


def test_random_batches_equal_the_table(spark, tmp_dir):
    """Reference windows (1 and 10 minutes), rows out of order over batches with restarts, null cards, bad times, late rows."""
    rng = random.Random(5)
    rows = []
    for i in range(240):
        t = rng.randrange(0, 7200)
        ts = f"2026-05-29 {6 + t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}"
        rows.append(payment(tid=f"T{i}", card=rng.choice(["A", "A", "B", "C", None]), ts="bad" if i % 40 == 7 else ts,
                            auth=rng.choice(["DECLINED", "APPROVED", "APPROVED"]),
                            location=rng.choice(["Paris, France", "Oslo, Norway", "Nice, France", "x"])))
    burst = [payment(tid=f"V{i}", card="V", ts=f"2026-05-29 06:50:{i * 7:02d}") for i in range(7)]
    rows += burst
    rows.sort(key=lambda r: (r[1] if r[1] != "bad" else "2026-05-29 07:00:00"))
    jittered = sorted(rows, key=lambda r: rows.index(r) + rng.randrange(0, 15))  # a few minutes out of order
    step = -(-len(jittered) // 6)
    parts = [jittered[i : i + step] for i in range(0, len(jittered), step)]
    parts[-1] = parts[-1] + [payment(tid=f"L{i}", card="A", ts="2026-05-29 06:00:30") for i in range(3)]  # long closed
    parts.append([payment(tid="end", card="end", ts="2026-05-29 12:00:00")])
    staged = []
    for part in parts:
        stage(spark, part, f"{tmp_dir}/inbox")
        staged += part
        run(spark, tmp_dir)
    got = everything(spark, tmp_dir)
    assert sorted(x[0] for x in got) == sorted(r[0] for r in staged if r[0] != "end")  # each once
    late = {x[0] for x in got if x[1] == "late"}
    assert {"L0", "L1", "L2"} <= late
    timely = [r for r in staged if r[0] not in late and r[0] != "end"]
    want = enrich(spark.createDataFrame(timely, PAYMENT_SCHEMA), DEFAULT_CONFIG.with_(window_scope="table")).collect()
    want = {r.transaction_id: (r.route, tuple(r[f] for f in FLAGS)) for r in want}
    for tid, route, flags in got:
        if route == "structural":
            assert want[tid][0] == "unparseable"
        elif route != "late":
            assert (route, flags) == want[tid], tid
    assert any(f[0] for _, _, f in got if f) and any(f[1] for _, _, f in got if f) and any(f[2] for _, _, f in got if f)


def test_an_empty_batch_reaches_the_sinks_and_writes_nothing(spark, tmp_dir):
    stage(spark, [payment(tid="a", ts="2026-05-29 06:39:10")], f"{tmp_dir}/inbox")
    counts = run(spark, tmp_dir, watermark="1 hour")
    # the first batch holds the row back; the watermark it moves starts a batch without rows
    assert [c["received"] for c in counts] == [0, 0]
    assert everything(spark, tmp_dir) == [] and not os.path.exists(f"{tmp_dir}/bronze")


def test_stateful_needs_a_place_for_late_rows_and_nested_windows(spark, tmp_dir):
    stage(spark, [payment()], f"{tmp_dir}/inbox")
    raw = read_raw_stream(spark, "file", path=f"{tmp_dir}/inbox")
    plain = BronzeTargets(bronze_path=f"{tmp_dir}/b", structural_path=f"{tmp_dir}/s")
    with pytest.raises(ValueError, match="late_path"):
        start_bronze_stream(spark, raw, plain, f"{tmp_dir}/c", STATEFUL)
    with pytest.raises(ValueError, match="nest"):
        longest_window(window_rules(STATEFUL.with_(cross_border_window="90 seconds")))
    assert longest_window(window_rules(STATEFUL)) == "10 minutes"
    assert late_watermark(spark, f"{tmp_dir}/none", 3) == 0 == late_watermark(spark, f"{tmp_dir}/none", 0)


def test_manifest_gives_each_row_once_after_a_failed_batch(spark, tmp_dir):
    rows = [payment(tid=f"T{i}", amount=20000.0 if i == 3 else 5.0) for i in range(5)]
    stage(spark, rows, f"{tmp_dir}/inbox")
    kw = {"manifest_path": f"{tmp_dir}/manifest"}
    with open(f"{tmp_dir}/dl", "w"):
        pass  # the dead letter cannot be written: the batch fails after its Bronze write
    with pytest.raises(Exception):
        run(spark, tmp_dir, DEFAULT_CONFIG, **kw)
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 4
    assert read_committed(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/manifest").count() == 0
    os.unlink(f"{tmp_dir}/dl")
    run(spark, tmp_dir, DEFAULT_CONFIG, **kw)
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 8  # both attempts
    kept = read_committed(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/manifest")
    assert sorted(r.transaction_id for r in kept.collect()) == ["T0", "T1", "T2", "T4"]
    assert read_manifest(spark, f"{tmp_dir}/manifest").count() == 1
    assert read_committed(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/manifest", 2026, 5, 29).count() == 4


def test_a_committed_batch_is_not_written_again(spark, tmp_dir):
    from ledgerlake.plans.bronze import process_batch

    df = spark.createDataFrame([payment(tid="T0")], PAYMENT_SCHEMA)
    t = targets(tmp_dir, manifest_path=f"{tmp_dir}/manifest")
    first = process_batch(df, 0, t, DEFAULT_CONFIG, run_id="r")
    again = process_batch(df, 0, t, DEFAULT_CONFIG, run_id="r")
    assert again == first | {"replayed": True}
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 1
    for kw in ({"replay_safe": True}, {"dead_letter_transport": "kafka"}):
        with pytest.raises(ValueError):
            BronzeTargets(**({"bronze_path": "b", "structural_path": "s", "dead_letter_transport": "file", "manifest_path": "m"} | kw))


def test_waiting_rows_are_left_out_of_a_batch(spark):
    """Only rows whose verdict is final or that are late are kept for the sinks."""
    rows = spark.sql(
        "SELECT * FROM VALUES ('settled', true, TIMESTAMP '2026-01-02 00:00:00'), ('no window', true, NULL),"
        " ('late', false, TIMESTAMP '2026-01-01 00:00:00'), ('waiting', false, TIMESTAMP '2026-01-03 00:00:00')"
        " AS t(id, _settled, _window_end)"
    )
    behind = 1767225600000  # 2026-01-01
    kept = settled_or_late(rows, behind)
    assert {r.id for r in kept.collect()} == {"settled", "no window", "late"}
    assert {r.id for r in settled_rows(kept).collect()} == {"settled", "no window"}
