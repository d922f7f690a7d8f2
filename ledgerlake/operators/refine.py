"""Silver refinement: types, critical-null drop and string cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.config import CRITICAL_COLUMNS, STRING_COLUMNS
from ledgerlake.functions import blank_to_null, to_amount


def standardize_types(df: DataFrame) -> DataFrame:
    """amount -> decimal(18,2), event_time -> timestamp, mcc -> int,
    currency -> upper(trim). Unconvertible values become null (ANSI-safe)."""
    return df.withColumns(
        {
            "amount": to_amount(F.col("amount")),
            "event_time": F.col("event_time").cast("timestamp"),
            "mcc": F.col("mcc").try_cast("int"),
            "currency": F.upper(F.trim(F.col("currency"))),
        }
    )


def drop_critical_nulls(df: DataFrame, columns=CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=[c for c in columns])


def clean_strings(df: DataFrame, columns=STRING_COLUMNS) -> DataFrame:
    """Trim each present string column and turn ``''`` into null; upper-case
    ``auth_result``."""
    present = [c for c in columns if c in df.columns]
    changes = {c: blank_to_null(F.col(c)) for c in present}
    if "auth_result" in df.columns:
        changes["auth_result"] = F.upper(changes.get("auth_result", F.col("auth_result")))
    return df.withColumns(changes)
