"""Payments derived from the driver's ``events`` table.

The surveyed project has no test inputs; this mapping turns every event into
one payment message with a known share of malformed timestamps, repeated
transaction ids, null cards, merchants, amounts and currencies, lower-case or
unknown currencies, non-numeric mcc, blank channels, locations without a
country, and (as messages) malformed JSON. It is a pure projection, so it
partitions exactly like ``events`` and grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (shared with the DuckDB oracle view).
BAD_TS_EVERY = 53
NULL_MERCHANT_EVERY = 41
NULL_AMOUNT_EVERY = 97
NULL_CARD_EVERY = 89
NULL_CURRENCY_EVERY = 71
REPEATED_ID_EVERY = 23  # the event after every 23rd repeats its id
MALFORMED_ID_END = "777"  # messages of these ids are cut off
TEXT_AMOUNT_ID_END = "55"  # messages of these ids carry the amount as text
OBJECT_AMOUNT_ID_END = "33"  # and of these as an object
REUSED_IDS = 331  # ids of the payments whose ids come again on other days
MERCHANT_COUNT = 50
AMOUNT_FACTOR = 50
CURRENCY_BY_MOD10 = {0: "JPY", 1: "EUR", 2: "GBP", 3: "NPR", 4: "usd"}  # else USD
MCC_BY_MOD5 = {0: "5411", 1: "5812", 2: "4814", 3: "5912"}  # else "n/a"
CHANNEL_BY_MOD4 = {0: "POS", 1: "ONLINE", 2: " ATM "}  # else ""
LOCATION_BY_MOD6 = {
    0: "New York, USA",
    1: "London, UK",
    2: "Kathmandu, Nepal",
    3: "Tokyo, Japan",
    4: "Paris",
}  # else null


def _pick(key: Column, table: dict[int, str], default: str | None) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default).cast("string"))


def payments_from_events(events: DataFrame) -> DataFrame:
    """One raw payment (all string/double fields, like the JSON payload) per event."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    return events.select(
        F.concat(
            F.lit("TXN"),
            F.lpad((eid - F.when(eid % REPEATED_ID_EVERY == 1, 1).otherwise(0)).cast("string"), 12, "0"),
        ).alias("transaction_id"),
        F.when(eid % BAD_TS_EVERY == 0, F.lit("bad-ts"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("ts_event"),
        F.when(eid % NULL_CARD_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), F.col("user_id").cast("string")))
        .alias("card_hash"),
        F.when(eid % NULL_MERCHANT_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("M"), (eid % MERCHANT_COUNT).cast("string")))
        .alias("merchant_id"),
        F.when(eid % NULL_AMOUNT_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") * AMOUNT_FACTOR)
        .alias("amount"),
        F.when(eid % NULL_CURRENCY_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(_pick(eid % 10, CURRENCY_BY_MOD10, "USD"))
        .alias("currency"),
        _pick(eid % 5, MCC_BY_MOD5, "n/a").alias("mcc"),
        _pick(eid % 4, CHANNEL_BY_MOD4, "").alias("channel"),
        F.when(etype == "error", F.lit("DECLINED"))
        .when(etype == "view", F.lit("approved"))
        .otherwise(F.lit("APPROVED"))
        .alias("auth_result"),
        _pick(eid % 6, LOCATION_BY_MOD6, None).alias("location"),
    )


def messages_from_payments(payments: DataFrame) -> DataFrame:
    """Encode payments as transport messages: key = card, value = JSON payload (some of them cut off)."""
    whole = F.to_json(F.struct(*payments.columns))
    cut = F.col("transaction_id").endswith(MALFORMED_ID_END)
    return payments.select(
        F.col("card_hash").alias("key"), F.when(cut, F.substring(whole, 1, 20)).otherwise(whole).alias("value")
    )


def reuse_ids(payments: DataFrame) -> DataFrame:
    """The payments with transaction ids that come round again, also on other days."""
    number = F.substring("transaction_id", 4, 12).cast("long") % REUSED_IDS
    return payments.withColumn("transaction_id", F.concat(F.lit("TXN"), F.lpad(number.cast("string"), 12, "0")))


def messages_with_faults(payments: DataFrame) -> DataFrame:
    """As :func:`messages_from_payments`, some amounts being text or an object."""

    def value(amount: Column) -> Column:
        return F.to_json(F.struct(*[amount.alias(c) if c == "amount" else F.col(c) for c in payments.columns]))

    tid = F.col("transaction_id")
    whole = value(F.col("amount"))
    return payments.select(
        F.col("card_hash").alias("key"),
        F.when(tid.endswith(MALFORMED_ID_END), F.substring(whole, 1, 20))
        .when(tid.endswith(TEXT_AMOUNT_ID_END), value(F.lit("n/a")))
        .when(tid.endswith(OBJECT_AMOUNT_ID_END), value(F.struct(F.lit("12.5").alias("value"))))
        .otherwise(whole)
        .alias("value"),
    )
