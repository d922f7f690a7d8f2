"""Settlement from partials of changed days."""

import pytest

from conftest import payment
from ledgerlake.operators.enrich import parseable, with_country, with_event_time, with_partition_columns
from ledgerlake.operators.gold import fact_settlement_daily
from ledgerlake.plans import settlement as st
from ledgerlake.plans.silver import run_silver
from ledgerlake.sinks.parquet import write_day, write_partitioned


def _bronze(payments_df, rows, d, mode="append"):
    df = with_partition_columns(with_country(parseable(with_event_time(payments_df(rows)))))
    write_partitioned(df, f"{d}/bronze", mode=mode)


def _update(spark, d):
    return st.update_settlement(spark, f"{d}/silver", f"{d}/changes", f"{d}/partials")


def _silver(spark, d, *day):
    run_silver(spark, f"{d}/bronze", f"{d}/silver", *day, changes_path=f"{d}/changes")


def _same_as_rebuilt(spark, d):
    want = fact_settlement_daily(spark.read.parquet(f"{d}/silver"))
    got = st.settlement(spark, f"{d}/partials")
    assert got.select(*want.columns).schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def _rows(d, n, start=0):
    return [payment(tid=f"T{d}-{start + i}", ts=f"2026-05-{d} 06:00:00", merchant=f"M{i % 3}", amount=10.01 * (i + 1) / 3) for i in range(n)]


def test_only_changed_days_are_updated(spark, payments_df, tmp_dir):
    _bronze(payments_df, _rows(10, 7) + _rows(11, 5) + _rows(12, 1), tmp_dir)
    assert _update_or_none(spark, tmp_dir) == []
    _silver(spark, tmp_dir)
    assert _update(spark, tmp_dir) == [20260510, 20260511, 20260512]
    _same_as_rebuilt(spark, tmp_dir)
    assert _update(spark, tmp_dir) == []  # nothing changed
    _bronze(payments_df, _rows(11, 4, start=100), tmp_dir)  # late rows
    _silver(spark, tmp_dir, 2026, 5, 11)
    assert _update(spark, tmp_dir) == [20260511]
    _same_as_rebuilt(spark, tmp_dir)
    month = st.settlement(spark, f"{tmp_dir}/partials", "month").collect()
    assert {r.date_key for r in month} == {202605} and sum(r.txn_count for r in month) == 17
    with pytest.raises(ValueError):
        st.settlement(spark, f"{tmp_dir}/partials", "week")


def _update_or_none(spark, d):
    return st.update_settlement(spark, f"{d}/none", f"{d}/none", f"{d}/partials")


def test_an_emptied_day_loses_its_partials(spark, payments_df, tmp_dir):
    _bronze(payments_df, _rows(10, 2) + _rows(11, 2), tmp_dir)
    _silver(spark, tmp_dir)
    _update(spark, tmp_dir)
    write_day(spark.read.parquet(f"{tmp_dir}/bronze").limit(0), f"{tmp_dir}/bronze", 2026, 5, 11)
    _silver(spark, tmp_dir, 2026, 5, 11)
    assert _update(spark, tmp_dir) == [20260511]
    assert {r.date_key for r in st.settlement(spark, f"{tmp_dir}/partials").collect()} == {20260510}
    assert _update(spark, tmp_dir) == []


def test_one_day_is_read(spark, payments_df, tmp_dir):
    _bronze(payments_df, _rows(10, 2) + _rows(11, 2), tmp_dir)
    _silver(spark, tmp_dir)
    files = st.silver_days(spark, f"{tmp_dir}/silver", [20260511, 20260513]).inputFiles()
    assert files and all("/day=11/" in f for f in files)
