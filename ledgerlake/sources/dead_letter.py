"""Dead-letter reader: decode flagged messages into a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.config import DEAD_LETTER_TOPIC

# The fields of the dead-letter payload that the report projects, and the labels.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("auth_result", T.StringType()),
        T.StructField("fraud_reasons", T.StringType()),
    ]
)

LABEL_DEAD_LETTER = "[DEAD-LETTER]"
LABEL_RAW = "[RAW]"


def dead_letter_report(messages: DataFrame) -> DataFrame:
    """Label by topic and project the payment fields of each message.

    ``messages`` has ``topic, key, value`` (see ``read_raw_batch``).
    """
    body = F.from_json(F.col("value"), REPORT_SCHEMA)
    return messages.select(
        F.when(F.col("topic") == DEAD_LETTER_TOPIC, F.lit(LABEL_DEAD_LETTER))
        .otherwise(F.lit(LABEL_RAW))
        .alias("label"),
        F.col("key").alias("card_hash"),
        *[body.getField(f.name).alias(f.name) for f in REPORT_SCHEMA.fields],
    )
