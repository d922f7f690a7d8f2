"""Ids over runs: the table of taken ids, its horizon, and faults of typed fields."""

from pyspark.sql import functions as F

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG
from ledgerlake.plans.bronze import BronzeTargets, enrich, process_batch
from ledgerlake.plans.silver import run_silver, taken_ids
from ledgerlake.sources.transport import decode_payload


def _bronze(df, d, batch=0, **kw):
    targets = BronzeTargets(bronze_path=f"{d}/bronze", dead_letter_transport="file", dead_letter_path=f"{d}/dl",
                            structural_path=f"{d}/structural", **kw)
    process_batch(df, batch, targets, DEFAULT_CONFIG)
    return targets


def _silver(spark, d):
    return sorted((r.transaction_id, r.day) for r in spark.read.parquet(f"{d}/silver").collect())


def test_an_id_enters_silver_once_over_days(spark, payments_df, tmp_dir):
    day = "2026-05-{:02d} 06:00:00"
    rows = [
        payment(tid="A", ts=day.format(10)), payment(tid="B", ts=day.format(10)),
        payment(tid="A", ts=day.format(11)), payment(tid="C", ts=day.format(11)),
        payment(tid="C", ts=day.format(12)), payment(tid="B", ts=day.format(12)), payment(tid="D", ts=day.format(12)),
        # the first copy has no card: it takes the id and is dropped, as within one run
        payment(tid="E", ts=day.format(11), card=None), payment(tid="E", ts=day.format(12)),
    ]
    _bronze(payments_df(rows), tmp_dir)

    def run(d, **kw):
        run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", 2026, 5, d, keys_path=f"{tmp_dir}/taken", **kw)

    for d in (10, 11, 12):
        run(d)
    want = [("A", 10), ("B", 10), ("C", 11), ("D", 12)]
    assert _silver(spark, tmp_dir) == want
    for d in (12, 10, 11):  # again, in another order: every day keeps its own
        run(d)
        assert _silver(spark, tmp_dir) == want
    assert {r[0] for r in taken_ids(spark, f"{tmp_dir}/taken", 2026, 5, 12).collect()} == {"A", "B", "C", "E"}
    assert {r[0] for r in taken_ids(spark, f"{tmp_dir}/taken", 2026, 5, 12, 1).collect()} == {"C", "E"}
    run(12, keys_days=1)  # B was taken two days before: out of reach now
    assert _silver(spark, tmp_dir) == [("A", 10), ("B", 10), ("B", 12), ("C", 11), ("D", 12)]


def test_all_days_at_once_fill_the_table(spark, payments_df, tmp_dir):
    rows = [payment(tid="A", ts="2026-05-10 06:00:00"), payment(tid="A", ts="2026-05-11 06:00:00")]
    _bronze(payments_df(rows), tmp_dir)
    run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", keys_path=f"{tmp_dir}/taken")
    assert _silver(spark, tmp_dir) == [("A", 10)]
    run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", 2026, 5, 11, keys_path=f"{tmp_dir}/taken")
    assert _silver(spark, tmp_dir) == [("A", 10)]


def test_the_near_days_are_all_that_is_read(spark, payments_df, tmp_dir):
    rows = [payment(tid=f"T{d}", ts=f"2026-05-{d} 06:00:00") for d in range(10, 20)]
    _bronze(payments_df(rows), tmp_dir)
    run_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", keys_path=f"{tmp_dir}/taken")
    files = taken_ids(spark, f"{tmp_dir}/taken", 2026, 5, 15, 2).inputFiles()
    assert {f.split("/day=")[1].split("/")[0] for f in files} == {"13", "14", "16", "17"}


def test_silver_reads_committed_batches_only(spark, payments_df, tmp_dir):
    kw = {"manifest_path": f"{tmp_dir}/manifest"}
    _bronze(payments_df([payment(tid="A")]), tmp_dir, **kw)
    # rows of an attempt that no manifest names
    left = payments_df([payment(tid="B")])
    targets = _bronze(left, tmp_dir, manifest_path=f"{tmp_dir}/another")
    run_silver(spark, targets.bronze_path, f"{tmp_dir}/silver", 2026, 5, 29, manifest_path=f"{tmp_dir}/manifest")
    assert _silver(spark, tmp_dir) == [("A", 29)]


def test_faults_name_field_and_value(spark):
    cases = {
        '{"transaction_id":"ok","ts_event":"2026-05-29 06:39:15","amount":1.5,"card_hash":"C"}': [],
        '{"transaction_id":"none","ts_event":"2026-05-29 06:39:15","amount":null}': [],
        '{"transaction_id":"absent","ts_event":"2026-05-29 06:39:15"}': [],
        '{"transaction_id":"text","ts_event":"2026-05-29 06:39:15","amount":"12,50"}': [("amount", "12,50")],
        '{"transaction_id":"list","ts_event":"2026-05-29 06:39:15","amount":[1]}': [("amount", "[1]")],
        '{"transaction_id":"both","ts_event":"yesterday","amount":"x"}': [("amount", "x"), ("ts_event", "yesterday")],
        '{"transaction_id":"cu': [("message", '{"transaction_id":"cu')],
        "": [("message", "")],
        "17": [("message", "17")],
    }
    raw = spark.createDataFrame([("k", v) for v in cases] + [("k", None)], "key string, value string")
    out = enrich(decode_payload(raw, faults=True), DEFAULT_CONFIG).collect()
    got = {r.raw_value: sorted((f.field, f.value) for f in r.decode_faults) for r in out}
    assert got == {**{k: sorted(v) for k, v in cases.items()}, None: [("message", None)]}
    for r in out:
        assert (r.route == "unparseable") == bool(r.decode_faults)
    intact = next(r for r in out if r.transaction_id == "text")
    assert intact.amount is None and intact.ts_event == "2026-05-29 06:39:15"  # other fields are read


def test_faulty_rows_reach_the_structural_dead_letter_with_their_payload(spark, tmp_dir):
    value = '{"transaction_id":"text","ts_event":"2026-05-29 06:39:15","amount":"12,50","auth_result":"DECLINED"}'
    raw = spark.createDataFrame([("k", value)], "key string, value string")
    targets = _bronze(decode_payload(raw, faults=True), tmp_dir)
    row = spark.read.json(f"{targets.structural_path}/run=*/batch=*").first()
    assert row.raw_value == value and [(f.field, f.value) for f in row.decode_faults] == [("amount", "12,50")]
    assert spark.read.json(f"{targets.structural_path}/run=*/batch=*").filter(F.col("decode_faults").isNull()).count() == 0
