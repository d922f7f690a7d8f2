"""Routing of enriched payments to Bronze, the dead letter, or quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C


def route_label(policy: str = "propagate", faulty: Column | None = None):
    """One label per row.

    ``valid`` needs both ``is_fraud`` and ``is_invalid`` to be false;
    ``dead_letter`` needs either to be true. Under ``propagate`` a null
    verdict matches neither and the row is ``unrouted`` (the surveyed
    pipeline loses it); under ``quarantine`` it goes to the dead letter.
    Rows without an event time, or ``faulty`` in some field, are ``unparseable``.
    """
    if policy not in ("propagate", "quarantine"):
        raise ValueError(f"unknown null policy {policy!r}")
    fraud, invalid = F.col("is_fraud"), F.col("is_invalid")
    unparseable = F.col("event_time").isNull()
    label = (
        F.when(unparseable if faulty is None else unparseable | faulty, F.lit(C.ROUTE_UNPARSEABLE))
        .when(~fraud & ~invalid, F.lit(C.ROUTE_VALID))
        .when(fraud | invalid, F.lit(C.ROUTE_DEAD_LETTER))
    )
    if policy == "quarantine":
        return label.otherwise(F.lit(C.ROUTE_DEAD_LETTER))
    return label.otherwise(F.lit(C.ROUTE_UNROUTED))


def with_route(df: DataFrame, policy: str = "propagate") -> DataFrame:
    faulty = F.size("decode_faults") > 0 if "decode_faults" in df.columns else None
    return df.withColumn("route", route_label(policy, faulty))


def valid_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == C.ROUTE_VALID)


def dead_letter_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == C.ROUTE_DEAD_LETTER)


def unparseable_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == C.ROUTE_UNPARSEABLE)


def batch_counts(routed: DataFrame) -> DataFrame:
    """Received / unparseable / valid / dead-letter / unrouted counts in one pass."""
    r = F.col("route")

    def n(label: str):
        return F.count_if(r == F.lit(label))

    return routed.agg(
        F.count(F.lit(1)).alias("received"),
        n(C.ROUTE_UNPARSEABLE).alias("unparseable"),
        n(C.ROUTE_VALID).alias("valid"),
        n(C.ROUTE_DEAD_LETTER).alias("dead_letter"),
        n(C.ROUTE_UNROUTED).alias("unrouted"),
    )


def partition_distribution(rows: DataFrame) -> DataFrame:
    """Rows per Hive partition (year, month, day)."""
    return rows.groupBy(*C.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
