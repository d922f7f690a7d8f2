"""Keep-first deduplication.

Keeps, per key, the first row in ``order_by`` order (ascending, nulls
first), breaking ties by ``ties`` (default: the remaining columns) so the
result is deterministic. Columns that are functions of those in ``ties`` need
not be sorted by, and a plan that reads few columns then prunes the rest.
:func:`not_seen_elsewhere` adds the keys that other runs have taken. Two plans:

``window`` (default)
    ``row_number() over (partition by key order by ...) = 1``. Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so each map task sends
    at most one row per key: copies of a hot key never reach one task.
``aggregate``
    ``min(struct(order..., rest...))`` per key: a (sort-based) aggregate
    with the same map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def not_seen_elsewhere(df: DataFrame, taken: DataFrame, keys: list[str] | str) -> DataFrame:
    """The rows whose key is not in ``taken`` (null keys are kept): a shuffle or broadcast anti join, as sizes go."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    taken = taken.select(*[F.col(k).alias(f"_taken_{k}") for k in keys])
    return df.join(taken, [F.col(k) == F.col(f"_taken_{k}") for k in keys], "left_anti")


def _order(df: DataFrame, keys: list[str], order_by: list[str], ties: list[str] | None) -> list[str]:
    rest = [c for c in (df.columns if ties is None else ties) if c not in keys and c not in order_by]
    return list(order_by) + rest


def keep_first(
    df: DataFrame,
    keys: list[str] | str,
    order_by: list[str] | str,
    strategy: str = "window",
    ties: list[str] | None = None,
) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    cols = df.columns
    order = _order(df, keys, order_by, ties)
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return (
            df.withColumn("_dedup_rn", F.row_number().over(w))
            .filter(F.col("_dedup_rn") == 1)
            .drop("_dedup_rn")
        )
    if strategy != "aggregate":
        raise ValueError(f"unknown dedup strategy {strategy!r}")
    # Struct comparison is field by field, ascending with nulls first.
    order += [c for c in cols if c not in order and c not in keys]
    first = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]))
    out = df.groupBy(*keys).agg(first.alias("_first"))
    return out.select(*[F.col(f"_first._o{order.index(c)}").alias(c) if c in order else F.col(c) for c in cols])
