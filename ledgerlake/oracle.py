"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics, not from the Spark plans: window rules are SQL
window aggregates over ``time_bucket`` groups, dedup is ``row_number``,
routing is a CASE. Integer and decimal types are cast to Spark's result
types so schemas compare equal. Parameters are those of
``ledgerlake.config.FIXTURE_CONFIG``.
"""

from __future__ import annotations

PAYMENTS = """
payments AS (
  SELECT concat('TXN', lpad(CAST(CASE WHEN event_id % 23 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR), 12, '0'))
           AS transaction_id,
         CASE WHEN event_id % 53 = 0 THEN 'bad-ts' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_event,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('C', CAST(user_id AS VARCHAR)) END AS card_hash,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE concat('M', CAST(event_id % 50 AS VARCHAR)) END AS merchant_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value * 50 END AS amount,
         CASE WHEN event_id % 71 = 0 THEN NULL ELSE CASE event_id % 10 WHEN 0 THEN 'JPY' WHEN 1 THEN 'EUR'
              WHEN 2 THEN 'GBP' WHEN 3 THEN 'NPR' WHEN 4 THEN 'usd' ELSE 'USD' END END AS currency,
         CASE event_id % 5 WHEN 0 THEN '5411' WHEN 1 THEN '5812' WHEN 2 THEN '4814'
              WHEN 3 THEN '5912' ELSE 'n/a' END AS mcc,
         CASE event_id % 4 WHEN 0 THEN 'POS' WHEN 1 THEN 'ONLINE' WHEN 2 THEN ' ATM ' ELSE '' END AS channel,
         CASE WHEN event_type = 'error' THEN 'DECLINED' WHEN event_type = 'view' THEN 'approved'
              ELSE 'APPROVED' END AS auth_result,
         CASE event_id % 6 WHEN 0 THEN 'New York, USA' WHEN 1 THEN 'London, UK'
              WHEN 2 THEN 'Kathmandu, Nepal' WHEN 3 THEN 'Tokyo, Japan' WHEN 4 THEN 'Paris'
              ELSE NULL END AS location
  FROM events
)"""

PARSED = """
parsed AS (
  SELECT *, CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
         CAST(day(event_time) AS INTEGER) AS day
  FROM (SELECT *, try_strptime(ts_event, '%Y-%m-%d %H:%M:%S') AS event_time FROM payments)
)"""

COUNTRY = "CASE WHEN len(string_split(location, ',')) > 1 THEN trim(string_split(location, ',')[-1]) ELSE 'UNKNOWN' END"

# Table-scope flags with the fixture parameters (1-day buckets).
def _flagged(velocity="1 day", cross="1 day", decline="1 day") -> str:
    def w(d):
        return f"(PARTITION BY card_hash, time_bucket(INTERVAL '{d}', event_time))"

    keyed = "card_hash IS NOT NULL AND event_time IS NOT NULL"
    return f"""
flagged AS (
  SELECT *,
    coalesce({keyed} AND count(*) OVER {w(velocity)} > 5, false) AS is_high_velocity,
    coalesce({keyed} AND min(country) OVER {w(cross)} <> max(country) OVER {w(cross)}, false) AS is_cross_border,
    coalesce({keyed} AND sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END) OVER {w(decline)}
                         / count(*) OVER {w(decline)} > 0.5, false) AS is_high_decline_rate
  FROM (
    SELECT *, NOT (currency IN ('USD', 'EUR', 'GBP', 'NPR')) AS is_invalid,
           {COUNTRY} AS country,
           amount > 10000.0 AS is_high_amount,
           merchant_id IN ('M11', 'M22') AS is_blacklisted,
           auth_result = 'DECLINED' AS is_bank_declined
    FROM parsed
  )
)"""


VERDICT = """
verdict AS (
  SELECT *,
    concat_ws(', ', CASE WHEN is_high_amount THEN 'HIGH_AMOUNT' END,
                    CASE WHEN is_blacklisted THEN 'BLACKLISTED_MERCHANT' END,
                    CASE WHEN is_bank_declined THEN 'BANK_DECLINED' END,
                    CASE WHEN is_high_velocity THEN 'VELOCITY' END,
                    CASE WHEN is_cross_border THEN 'CROSS_BORDER' END,
                    CASE WHEN is_high_decline_rate THEN 'HIGH_DECLINE_RATE' END) AS fraud_reasons,
    (is_high_amount OR is_blacklisted OR is_bank_declined OR is_high_velocity
       OR is_cross_border OR is_high_decline_rate) AS is_fraud
  FROM flagged
),
routed AS (
  SELECT *, CASE WHEN event_time IS NULL THEN 'unparseable'
                 WHEN NOT is_fraud AND NOT is_invalid THEN 'valid'
                 WHEN is_fraud OR is_invalid THEN 'dead_letter'
                 ELSE 'unrouted' END AS route
  FROM verdict
)"""

PAYMENT_COLS = "transaction_id, ts_event, card_hash, merchant_id, amount, currency, mcc, channel, auth_result, location"
# As decoded from messages: a message that is cut off is a payment of nulls.
DECODED = (
    PAYMENTS.replace("payments AS", "sent AS")
    + ",\npayments AS (SELECT "
    + ", ".join(f"CASE WHEN transaction_id LIKE '%777' THEN NULL ELSE {c} END AS {c}" for c in PAYMENT_COLS.split(", "))
    + " FROM sent)"
)
ROUTED = "WITH " + ",".join([PAYMENTS, PARSED, _flagged(), VERDICT])
ROUTED_STREAM = "WITH " + ",".join([DECODED, PARSED, _flagged(), VERDICT])
ROUTED_REFERENCE_WINDOWS = "WITH " + ",".join(
    [PAYMENTS, PARSED, _flagged("1 minute", "10 minutes", "10 minutes"), VERDICT]
)

FLAGS = "is_high_amount, is_blacklisted, is_bank_declined, is_high_velocity, is_cross_border, is_high_decline_rate"
BRONZE_COLS = (
    "transaction_id, ts_event, card_hash, merchant_id, amount, currency, mcc, channel, auth_result, "
    "location, event_time, year, month, day, country, " + FLAGS + ", fraud_reasons"
)
SILVER_COLS = PAYMENT_COLS + ", event_time, year, month, day, country"

# Silver over a relation `src` with Bronze-like columns (incl. country).
def _silver(src: str) -> str:
    return f"""
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY event_time ASC NULLS FIRST,
      ts_event ASC NULLS FIRST, card_hash ASC NULLS FIRST, merchant_id ASC NULLS FIRST, amount ASC NULLS FIRST,
      currency ASC NULLS FIRST, mcc ASC NULLS FIRST, channel ASC NULLS FIRST, auth_result ASC NULLS FIRST,
      location ASC NULLS FIRST) AS rn
    FROM {src}
  ) WHERE rn = 1
),
typed AS (
  SELECT transaction_id, ts_event, card_hash, merchant_id, TRY_CAST(amount AS DECIMAL(18,2)) AS amount,
         upper(trim(currency)) AS currency, TRY_CAST(mcc AS INTEGER) AS mcc, channel, auth_result, location,
         event_time, year, month, day, country
  FROM deduped
),
silver AS (
  SELECT transaction_id, ts_event, card_hash, nullif(trim(merchant_id), '') AS merchant_id, amount, currency, mcc,
         nullif(trim(channel), '') AS channel, upper(nullif(trim(auth_result), '')) AS auth_result,
         nullif(trim(location), '') AS location, event_time, year, month, day, nullif(trim(country), '') AS country
  FROM typed
  WHERE transaction_id IS NOT NULL AND card_hash IS NOT NULL AND amount IS NOT NULL
    AND event_time IS NOT NULL AND currency IS NOT NULL
)"""


SILVER_ALL = "WITH " + ",".join(
    [
        PAYMENTS,
        PARSED,
        f"""
src AS (SELECT {PAYMENT_COLS}, event_time, year, month, day, {COUNTRY} AS country
        FROM parsed WHERE event_time IS NOT NULL)""",
        _silver("src"),
    ]
)
SILVER_FROM_BRONZE = ROUTED + "," + f"""
bronze AS (SELECT {SILVER_COLS} FROM routed WHERE route = 'valid')""" + "," + _silver("bronze")

DATE_KEY = "CAST(strftime(event_time, '%Y%m%d') AS INTEGER)"


def _gold(where: str = "") -> str:
    return SILVER_ALL + f""",
gold AS (
  SELECT *, amount > 10000.0 AS is_high_amount, merchant_id IN ('M11', 'M22') AS is_blacklisted,
         false AS is_high_velocity, false AS is_cross_border, {DATE_KEY} AS date_key
  FROM silver {where}
)"""


GOLD = _gold()

# avg(decimal(18,2)) as Spark computes it: decimal(22,6), rounded half up.
EXACT_AVG = (
    "CAST(CAST((CAST(sum(amount) * 100 AS HUGEINT) * 20000 + count(*)) // (2 * count(*)) AS DECIMAL(22,0))"
    " * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(22,6))"
)
SETTLEMENT = f"""
SELECT date_key, merchant_id, CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount, count(*) AS txn_count,
       {EXACT_AVG} AS avg_amount, max(amount) AS max_amount
FROM gold GROUP BY date_key, merchant_id"""

_PARSEABLE = f"""
, parseable AS (SELECT *, {COUNTRY} AS country FROM parsed WHERE event_time IS NOT NULL)"""
PARSEABLE = "WITH " + ",".join([PAYMENTS, PARSED]) + _PARSEABLE
PARSEABLE_STREAM = "WITH " + ",".join([DECODED, PARSED]) + _PARSEABLE


def _windows(select_aggs: str, having: str) -> str:
    return PARSEABLE + f"""
SELECT card_hash, time_bucket(INTERVAL '1 day', event_time) AS window_start,
       time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end, {select_aggs}
FROM parseable WHERE card_hash IS NOT NULL
GROUP BY card_hash, time_bucket(INTERVAL '1 day', event_time)
HAVING {having}"""


_DEAD_LETTER_REPORT = """
SELECT '[DEAD-LETTER]' AS label, card_hash, transaction_id, amount, currency, merchant_id, auth_result, fraud_reasons
FROM routed WHERE route = 'dead_letter'"""

ALERTS = PARSEABLE_STREAM + """
, agg AS (
  SELECT card_hash, time_bucket(INTERVAL '1 day', event_time) AS window_start,
         time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
         count(*) > 5 AS is_high_velocity,
         min(country) <> max(country) AS is_cross_border,
         sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END) / count(*) > 0.5 AS is_high_decline_rate
  FROM parseable WHERE card_hash IS NOT NULL
  GROUP BY card_hash, time_bucket(INTERVAL '1 day', event_time)
)
SELECT *, concat_ws(', ', CASE WHEN is_high_velocity THEN 'VELOCITY' END,
                          CASE WHEN is_cross_border THEN 'CROSS_BORDER' END,
                          CASE WHEN is_high_decline_rate THEN 'HIGH_DECLINE_RATE' END) AS alert_reasons
FROM agg WHERE is_high_velocity OR is_cross_border OR is_high_decline_rate"""

LINEITEM_DEDUP = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_shipdate ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST,
    l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST, l_discount ASC NULLS FIRST,
    l_tax ASC NULLS FIRST, l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) AS rn
  FROM lineitem
) WHERE rn = 1"""

# The day of the day-scoped queries (catalog.CHECK_DAY).
CHECK_DAY = "year = 2024 AND month = 1 AND day = 15"

ORACLE_SQL = {
    "parse_event_time": "WITH " + ",".join([PAYMENTS, PARSED])
    + "\nSELECT transaction_id, ts_event, event_time, year, month, day FROM parsed WHERE event_time IS NOT NULL",
    "settlement_daily": GOLD + SETTLEMENT,
    "decode_payload": f"WITH {DECODED}\nSELECT * FROM payments",
    "extract_country": f"WITH {PAYMENTS}\nSELECT transaction_id, location, {COUNTRY} AS country FROM payments",
    "currency_validity": f"WITH {PAYMENTS}\nSELECT transaction_id, currency,"
    " NOT (currency IN ('USD', 'EUR', 'GBP', 'NPR')) AS is_invalid FROM payments",
    "rule_high_amount": f"WITH {PAYMENTS}\nSELECT transaction_id, amount, amount > 10000.0 AS is_high_amount FROM payments",
    "rule_blacklist": f"WITH {PAYMENTS}\nSELECT transaction_id, merchant_id,"
    " merchant_id IN ('M11', 'M22') AS is_blacklisted FROM payments",
    "rule_blacklist_table": f"WITH {PAYMENTS}\nSELECT transaction_id, merchant_id,"
    " merchant_id IN ('M11', 'M22') AS is_blacklisted FROM payments",
    "rule_declined": f"WITH {PAYMENTS}\nSELECT transaction_id, auth_result,"
    " auth_result = 'DECLINED' AS is_bank_declined FROM payments",
    "fraud_verdict": ROUTED + f"\nSELECT transaction_id, {FLAGS}, fraud_reasons, is_fraud FROM routed",
    "rule_velocity": ROUTED + "\nSELECT transaction_id, card_hash, event_time, is_high_velocity FROM routed"
    " WHERE event_time IS NOT NULL",
    "rule_cross_border": ROUTED + "\nSELECT transaction_id, card_hash, event_time, is_cross_border FROM routed"
    " WHERE event_time IS NOT NULL",
    "rule_decline_rate": ROUTED + "\nSELECT transaction_id, card_hash, event_time, is_high_decline_rate FROM routed"
    " WHERE event_time IS NOT NULL",
    "velocity_windows": _windows("count(*) AS velocity_count", "count(*) > 5"),
    "cross_border_windows": _windows("count(DISTINCT country) AS country_count", "count(DISTINCT country) > 1"),
    "decline_rate_windows": _windows(
        "count(*) AS total_txn, CAST(sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END) AS BIGINT)"
        " AS declined_txn",
        "sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END) / count(*) > 0.5",
    ),
    "rules_join_form": ROUTED + "\nSELECT transaction_id, is_high_velocity, is_cross_border, is_high_decline_rate FROM routed",
    "rules_window_form": ROUTED + "\nSELECT transaction_id, is_high_velocity, is_cross_border, is_high_decline_rate FROM routed",
    "rules_broadcast_form": ROUTED
    + "\nSELECT transaction_id, is_high_velocity, is_cross_border, is_high_decline_rate FROM routed",
    "rules_reference_windows": ROUTED_REFERENCE_WINDOWS
    + "\nSELECT transaction_id, is_high_velocity, is_cross_border, is_high_decline_rate FROM routed",
    "route_valid": ROUTED + f"\nSELECT {BRONZE_COLS} FROM routed WHERE route = 'valid'",
    "route_dead_letter": ROUTED + f"\nSELECT transaction_id, card_hash, {FLAGS}, fraud_reasons, is_fraud, is_invalid"
    " FROM routed WHERE route = 'dead_letter'",
    "route_quarantine": ROUTED + "\nSELECT transaction_id, is_fraud, is_invalid FROM routed"
    " WHERE route IN ('dead_letter', 'unrouted')",
    "unparseable_rows": ROUTED + f"\nSELECT {PAYMENT_COLS}, event_time, CAST(0 AS BIGINT) AS batch_id"
    " FROM routed WHERE route = 'unparseable'",
    "batch_counts": ROUTED + """
SELECT count(*) AS received, CAST(count_if(route = 'unparseable') AS BIGINT) AS unparseable,
       CAST(count_if(route = 'valid') AS BIGINT) AS valid, CAST(count_if(route = 'dead_letter') AS BIGINT) AS dead_letter,
       CAST(count_if(route = 'unrouted') AS BIGINT) AS unrouted FROM routed""",
    "partition_distribution": ROUTED + "\nSELECT year, month, day, count(*) AS row_count FROM routed"
    " WHERE route = 'valid' GROUP BY year, month, day",
    "dedup_first": LINEITEM_DEDUP,
    "dedup_first_aggregate": LINEITEM_DEDUP,
    "standardize_types": "WITH " + ",".join([PAYMENTS, PARSED]) + """
SELECT transaction_id, TRY_CAST(amount AS DECIMAL(18,2)) AS amount, event_time, TRY_CAST(mcc AS INTEGER) AS mcc,
       upper(trim(currency)) AS currency FROM parsed WHERE event_time IS NOT NULL""",
    "clean_strings": "WITH " + ",".join([PAYMENTS, PARSED]) + f"""
SELECT transaction_id, nullif(trim(merchant_id), '') AS merchant_id, nullif(trim(channel), '') AS channel,
       upper(nullif(trim(auth_result), '')) AS auth_result, nullif(trim(location), '') AS location,
       nullif(trim({COUNTRY}), '') AS country FROM parsed WHERE event_time IS NOT NULL""",
    "drop_critical_nulls": "WITH " + ",".join([PAYMENTS, PARSED]) + """
SELECT * FROM (SELECT transaction_id, card_hash, TRY_CAST(amount AS DECIMAL(18,2)) AS amount, event_time,
                      upper(trim(currency)) AS currency FROM parsed)
WHERE transaction_id IS NOT NULL AND card_hash IS NOT NULL AND amount IS NOT NULL
  AND event_time IS NOT NULL AND currency IS NOT NULL""",
    "silver": SILVER_FROM_BRONZE + f"\nSELECT {SILVER_COLS} FROM silver",
    "silver_job_idempotent": SILVER_FROM_BRONZE + f"\nSELECT {SILVER_COLS} FROM silver",
    "dim_date": GOLD + """
SELECT DISTINCT CAST(strftime(CAST(event_time AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
       CAST(event_time AS DATE) AS full_date, CAST(year(event_time) AS INTEGER) AS year,
       CAST(month(event_time) AS INTEGER) AS month, CAST(day(event_time) AS INTEGER) AS day FROM gold""",
    "dim_card": GOLD + "\nSELECT DISTINCT card_hash FROM gold",
    "dim_merchant": GOLD + "\nSELECT DISTINCT merchant_id, mcc, country FROM gold",
    "fact_transactions": GOLD + """
SELECT transaction_id, date_key, card_hash, merchant_id, amount, currency, channel, auth_result, event_time FROM gold""",
    "fact_fraud_signals": GOLD + """
SELECT transaction_id, date_key, merchant_id, is_high_amount, is_blacklisted, is_high_velocity, is_cross_border
FROM gold WHERE is_high_amount OR is_blacklisted""",
    "stream_bronze": ROUTED_STREAM + f"\nSELECT {BRONZE_COLS} FROM routed WHERE route = 'valid'",
    "stream_dead_letter": ROUTED_STREAM + _DEAD_LETTER_REPORT,
    "stream_unparseable": ROUTED_STREAM + f"\nSELECT {PAYMENT_COLS} FROM routed WHERE route = 'unparseable'",
    "dead_letter_report": ROUTED + _DEAD_LETTER_REPORT,
    "partition_check": GOLD + """
SELECT CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(15 AS INTEGER) AS day,
       count(*) > 0 AS present, count(*) AS row_count
FROM gold WHERE year = 2024 AND month = 1 AND day = 15""",
    "stream_card_alerts": ALERTS,
    "silver_day": SILVER_FROM_BRONZE + f"\nSELECT {SILVER_COLS} FROM silver WHERE {CHECK_DAY}",
    "settlement_day": _gold(f"WHERE {CHECK_DAY}") + SETTLEMENT,
}
ORACLE_SQL |= {
    f"gold_job_{name}": ORACLE_SQL[name]
    for name in ("dim_date", "dim_card", "dim_merchant", "fact_transactions", "fact_fraud_signals")
}
ORACLE_SQL |= {
    "gold_job_fact_settlement_daily": ORACLE_SQL["settlement_daily"],
    "rules_join_form_reference": ORACLE_SQL["rules_reference_windows"],
    "rules_across_batches": ROUTED_STREAM
    + "\nSELECT transaction_id, is_high_velocity, is_cross_border, is_high_decline_rate, fraud_reasons, is_fraud, route"
    " FROM routed",
    "stream_partition_distribution": ROUTED_STREAM + "\nSELECT year, month, day, count(*) AS row_count FROM routed"
    " WHERE route = 'valid' GROUP BY year, month, day",
    "stream_restart": ROUTED_STREAM + """
SELECT 2 * count(*) AS received, 2 * count(*) AS accounted,
       CAST(2 * count_if(route = 'unparseable') AS BIGINT) AS unparseable, CAST(0 AS BIGINT) AS mismatches FROM routed""",
}

ROUTED_STREAM_REFERENCE = "WITH " + ",".join([DECODED, PARSED, _flagged("1 minute", "10 minutes", "10 minutes"), VERDICT])
REUSED_IDS = PAYMENTS.replace("CASE WHEN event_id % 23 = 1 THEN event_id - 1 ELSE event_id END", "(CASE WHEN event_id % 23 = 1 THEN event_id - 1 ELSE event_id END) % 331")
REUSED_DAYS = "WITH " + ",".join([REUSED_IDS, PARSED, _flagged(), VERDICT]) + f""",
bronze AS (SELECT {SILVER_COLS} FROM routed WHERE route = 'valid' AND year = 2024 AND month = 1 AND day IN (15, 16, 17)),""" + _silver("bronze")


def _faults(from_payload: str) -> str:
    """Faults of the messages; ``from_payload``: the id where the whole message is cut off."""
    return f"""WITH {PAYMENTS}
SELECT CASE WHEN transaction_id LIKE '%777' THEN {from_payload} ELSE transaction_id END AS transaction_id,
       'message' AS field, substr('{{"transaction_id":"' || transaction_id, 1, 20) AS value FROM payments WHERE transaction_id LIKE '%777'
UNION ALL
SELECT transaction_id, 'ts_event', ts_event FROM payments WHERE ts_event = 'bad-ts' AND transaction_id NOT LIKE '%777'
UNION ALL
SELECT transaction_id, 'amount', CASE WHEN transaction_id LIKE '%55' THEN 'n/a' ELSE '{{"value":"12.5"}}' END
FROM payments WHERE transaction_id LIKE '%55' OR transaction_id LIKE '%33'"""


ORACLE_SQL |= {
    "stream_stateful_bronze": ORACLE_SQL["stream_bronze"],
    "stream_stateful_dead_letter": ORACLE_SQL["stream_dead_letter"],
    "stream_stateful_reference": ROUTED_STREAM_REFERENCE + f"\nSELECT {BRONZE_COLS} FROM routed WHERE route = 'valid'",
    "stream_exactly_once": ORACLE_SQL["stream_bronze"],
    "stream_late_rows": "WITH " + ",".join([DECODED, PARSED])
    + "\nSELECT transaction_id, ts_event, coalesce(card_hash IS NOT NULL AND day < 10, false) AS late FROM parsed",
    "stream_alerts_closed_dates": ALERTS,
    "stream_alerts_late_rows": PARSEABLE_STREAM + """
SELECT card_hash, time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
       CAST(count_if(day >= 10) AS BIGINT) AS n_counted, CAST(count_if(day < 10) AS BIGINT) AS n_late
FROM parseable WHERE card_hash IS NOT NULL GROUP BY ALL""",
    "stream_empty_batch": "SELECT true AS empty_batches_seen, CAST(0 AS BIGINT) AS received, CAST(0 AS BIGINT) AS sinks_written",
    "decode_faults": f"SELECT *, 'unparseable' AS route FROM ({_faults('NULL')})",
    "stream_faults": _faults("NULL"),
    "settlement_incremental": ORACLE_SQL["settlement_daily"],
    "silver_dedup_across_days": REUSED_DAYS + f"\nSELECT {SILVER_COLS} FROM silver",
}
