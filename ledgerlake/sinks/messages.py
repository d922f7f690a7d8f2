"""Message sinks: rows -> (key, JSON value) -> Kafka topic or file folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.config import DEAD_LETTER_TOPIC


def to_messages(df: DataFrame, key_col: str = "card_hash", exclude=("route",)) -> DataFrame:
    """key = card, value = JSON of every remaining column (nulls omitted)."""
    cols = [c for c in df.columns if c not in exclude]
    return df.select(
        F.col(key_col).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value")
    )


def write_messages(
    messages: DataFrame,
    transport: str = "kafka",
    *,
    topic: str = DEAD_LETTER_TOPIC,
    bootstrap: str | None = None,
    path: str | None = None,
    mode: str = "append",
) -> None:
    if transport == "kafka":
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .save()
        )
    elif transport == "file":
        messages.write.mode(mode).json(path)
    else:
        raise ValueError(f"unknown transport {transport!r}")
