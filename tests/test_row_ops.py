"""Row-level operators: parsing, country, currency, decoding, cleaning."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import payment
from ledgerlake.config import PAYMENT_COLUMNS
from ledgerlake.operators.enrich import with_country, with_currency_check, with_event_time, with_partition_columns
from ledgerlake.operators.refine import clean_strings, drop_critical_nulls, standardize_types
from ledgerlake.sources.transport import decode_payload


def test_parse_event_time_strict(payments_df):
    rows = [payment(tid=str(i), ts=ts) for i, ts in enumerate(
        ["2026-05-29 06:39:15", "2026-05-29T06:39:15", "2026-5-9 06:39:15", "2026-02-30 00:00:00", None, "junk"])]
    out = {r.transaction_id: r.event_time for r in with_event_time(payments_df(rows)).collect()}
    assert out["0"] is not None and str(out["0"]) == "2026-05-29 06:39:15"
    assert all(out[str(i)] is None for i in range(1, 6))


def test_partition_columns(payments_df):
    df = with_partition_columns(with_event_time(payments_df([payment(ts="2024-02-29 23:59:59")])))
    r = df.first()
    assert (r.year, r.month, r.day) == (2024, 2, 29)


def test_country_rules(payments_df):
    locs = {"a": "New York, USA", "b": "Paris", "c": None, "d": "", "e": "Paris,", "f": "a, b ,  Nepal  "}
    rows = [payment(tid=k, location=v) for k, v in locs.items()]
    out = {r.transaction_id: r.country for r in with_country(payments_df(rows)).collect()}
    assert out == {"a": "USA", "b": "UNKNOWN", "c": "UNKNOWN", "d": "UNKNOWN", "e": "", "f": "Nepal"}


def test_currency_check_is_case_sensitive_and_null_propagating(payments_df):
    rows = [payment(tid=c or "null", currency=c) for c in ["USD", "usd", "JPY", None, "NPR"]]
    out = {r.transaction_id: r.is_invalid for r in with_currency_check(payments_df(rows)).collect()}
    assert out == {"USD": False, "usd": True, "JPY": True, "null": None, "NPR": False}


def test_decode_payload_permissive(spark):
    raw = spark.createDataFrame(
        [
            ("k1", '{"transaction_id":"T1","amount":12.5,"currency":"USD","extra":1}'),
            ("k2", '{"transaction_id":"T2","amount":"x"}'),
            ("k3", "{not json"),
        ],
        "key string, value string",
    )
    out = {r.raw_value: r for r in decode_payload(raw).collect()}
    r1 = out['{"transaction_id":"T1","amount":12.5,"currency":"USD","extra":1}']
    assert (r1.transaction_id, r1.amount, r1.currency) == ("T1", 12.5, "USD")
    r2 = out['{"transaction_id":"T2","amount":"x"}']
    assert r2.amount is None  # wrong type: only that field is null
    r3 = out["{not json"]
    assert all(getattr(r3, c) is None for c in PAYMENT_COLUMNS)
    assert r3.raw_value == "{not json"


def test_standardize_types(payments_df):
    rows = [payment(tid="a", amount=10.005, mcc="n/a", currency=" usd "),
            payment(tid="b", amount=1e17, mcc="5411", currency="EUR")]
    df = standardize_types(with_event_time(payments_df(rows)))
    out = {r.transaction_id: r for r in df.collect()}
    assert out["a"].amount == Decimal("10.01") and out["a"].mcc is None and out["a"].currency == "USD"
    assert out["b"].amount is None and out["b"].mcc == 5411
    assert dict(df.dtypes)["amount"] == "decimal(18,2)"


def test_clean_strings(payments_df):
    rows = [payment(tid="a", channel=" ATM ", auth="declined", location="  "),
            payment(tid="b", channel="", merchant=" M9 ")]
    df = clean_strings(with_country(payments_df(rows)))
    out = {r.transaction_id: r for r in df.collect()}
    assert out["a"].channel == "ATM" and out["a"].auth_result == "DECLINED" and out["a"].location is None
    assert out["b"].channel is None and out["b"].merchant_id == "M9"


def test_clean_strings_skips_absent_columns(payments_df):
    df = payments_df([payment()]).drop("location")
    assert "location" not in clean_strings(df).columns


def test_drop_critical_nulls(payments_df):
    rows = [payment(tid="ok"), payment(tid="na", amount=None), payment(tid="nc", card=None),
            payment(tid="nt", ts="bad"), payment(tid="ncur", currency=None)]
    df = drop_critical_nulls(with_event_time(payments_df(rows)))
    assert [r.transaction_id for r in df.collect()] == ["ok"]
