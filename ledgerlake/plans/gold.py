"""Gold job: Silver -> flags -> 3 dimensions + 3 facts -> Parquet or JDBC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.config import BLACKLISTED_MERCHANTS, HIGH_AMOUNT_THRESHOLD
from ledgerlake.operators.gold import DIMENSIONS, GOLD_TABLES, gold_flags
from ledgerlake.session import require_utc
from ledgerlake.sinks.jdbc import read_jdbc, table_exists, write_jdbc
from ledgerlake.sinks.parquet import write_partitioned
from ledgerlake.sources.tables import path_exists, read_partitioned

# Concurrent JDBC connections per Gold table by default.
DEFAULT_JDBC_CONNECTIONS = 16


def gold_tables(
    silver: DataFrame,
    threshold: float = HIGH_AMOUNT_THRESHOLD,
    blacklist=BLACKLISTED_MERCHANTS,
) -> dict[str, DataFrame]:
    flagged = gold_flags(silver, threshold, blacklist)
    return {name: build(flagged) for name, build in GOLD_TABLES.items()}


def run_gold(
    spark: SparkSession,
    silver_path: str,
    target: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    dim_mode: str | None = None,
    fact_mode: str = "append",
    num_partitions: int | None = DEFAULT_JDBC_CONNECTIONS,
    threshold: float = HIGH_AMOUNT_THRESHOLD,
    blacklist=BLACKLISTED_MERCHANTS,
    tables: Iterable[str] | None = None,
) -> dict[str, str]:
    """Build and write the six tables (or only ``tables``) to ``target``: a ``jdbc:`` url or a Parquet root.

    Each table is its own plan over the Silver scan, so every write reads
    only the columns it needs (pruned, partition-filtered Parquet) instead
    of caching the whole input.

    Facts (``fact_mode``): ``"append"`` as surveyed, where a re-run adds its
    rows again, or ``"replace_day"`` (Parquet; facts are partitioned by
    ``date_key`` and the days written are replaced). Dimensions
    (``dim_mode``): ``"overwrite"`` (default for a run over all of Silver),
    ``"merge"`` (insert only rows not yet in the table; the default for a
    day-scoped run, whose dimensions must not replace those of other days)
    or ``"append"``. ``num_partitions``: concurrent JDBC connections per
    table. A day without a Silver folder is an error.
    """
    require_utc(spark)
    jdbc = target.startswith("jdbc:")
    silver = read_partitioned(spark, silver_path, year, month, day, missing="error")
    if dim_mode is None:
        dim_mode = "overwrite" if year is None else "merge"
    if dim_mode not in ("overwrite", "merge", "append"):
        raise ValueError(f"unknown dimension mode {dim_mode!r}")
    if fact_mode not in ("append", "overwrite", "replace_day"):
        raise ValueError(f"unknown fact mode {fact_mode!r}")
    if jdbc and fact_mode == "replace_day":
        raise ValueError("replace_day needs a Parquet target")
    conn = {"user": user, "password": password, "driver": driver}
    built = gold_tables(silver, threshold, blacklist)
    chosen = list(built) if tables is None else list(tables)
    if unknown := [t for t in chosen if t not in built]:
        raise ValueError(f"unknown tables {unknown}")
    written = {}
    for name in chosen:
        table = built[name]
        mode = dim_mode if name in DIMENSIONS else fact_mode
        if mode == "merge":
            table = new_dimension_rows(table, existing_table(spark, name, target, conn))
        if jdbc:
            write_jdbc(table, name, target, mode="append" if mode == "merge" else mode, num_partitions=num_partitions, **conn)
        elif name in DIMENSIONS:
            table.write.mode("append" if mode == "merge" else mode).parquet(f"{target}/{name}")
        else:
            # A day's rows are spread over tasks only as far as their size asks for.
            rows = table.hint("rebalance", "date_key")
            write_partitioned(
                rows, f"{target}/{name}", mode="overwrite" if mode == "replace_day" else mode,
                partition_by=("date_key",), dynamic=mode == "replace_day",
            )
        written[name] = mode
    return written


def existing_table(spark: SparkSession, name: str, target: str, conn: dict) -> DataFrame | None:
    """The table as it is now, or None if there is none; any other failure is raised."""
    if target.startswith("jdbc:"):
        return read_jdbc(spark, name, target, **conn) if table_exists(spark, name, target, **conn) else None
    path = f"{target}/{name}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def new_dimension_rows(rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    """``rows`` not already in ``existing`` (null-safe on every column): a left anti join."""
    if existing is None:
        return rows
    existing = existing.select(*rows.columns)
    cond = None
    for c in rows.columns:
        eq = rows[c].eqNullSafe(existing[c])
        cond = eq if cond is None else cond & eq
    return rows.join(existing, cond, "left_anti")
