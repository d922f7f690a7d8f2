"""Membership of a column in a lookup table (large blacklists).

A literal ``isin`` ships the whole list inside every task's code; a table of
values is joined instead, by a lazy plan that runs no job. Spark broadcasts
the distinct keys if they fit under the session's threshold; else the keys
have a shuffle of their own, so that adaptive execution can split a hot
value's partition on the row side. Distinct keys mean the left join never
fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.windows import shuffle_side


def flag_membership(df: DataFrame, column: str, values: DataFrame, flag: str) -> DataFrame:
    """``flag`` = ``column`` is in ``values`` (first column); null stays null."""
    keys = (
        values.select(F.col(values.columns[0]).cast("string").alias("_lk_key"))
        .where(F.col("_lk_key").isNotNull())
        .distinct()
    )
    hits = shuffle_side(keys.withColumn("_lk_hit", F.lit(True)), unless_broadcast=True)
    joined = df.join(hits, F.col(column) == F.col("_lk_key"), "left")
    return joined.withColumn(
        flag,
        F.when(F.col(column).isNull(), F.lit(None).cast("boolean")).otherwise(
            F.coalesce(F.col("_lk_hit"), F.lit(False))
        ),
    ).drop("_lk_key", "_lk_hit")
