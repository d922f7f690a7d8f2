"""Row-local enrichment of decoded payments (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.config import TIMESTAMP_FORMAT, VALID_CURRENCIES
from ledgerlake.functions import country_of, parse_event_time


def with_event_time(df: DataFrame, fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """``event_time`` parsed strictly from ``ts_event``; failures are null."""
    return df.withColumn("event_time", parse_event_time("ts_event", fmt))


def parseable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_time").isNotNull())


def unparseable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_time").isNull())


def with_partition_columns(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """year / month / day (UTC) of the event time, the Hive partition keys."""
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    )


def with_country(df: DataFrame) -> DataFrame:
    return df.withColumn("country", country_of("location"))


def with_currency_check(df: DataFrame, valid: tuple[str, ...] = VALID_CURRENCIES) -> DataFrame:
    """``is_invalid``: currency not in the list (case-sensitive); null stays null."""
    return df.withColumn("is_invalid", ~F.col("currency").isin(list(valid)))
