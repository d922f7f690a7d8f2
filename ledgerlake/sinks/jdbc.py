"""JDBC sink and reader for the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    mode: str = "append",
    truncate: bool = True,
    num_partitions: int | None = None,
    batch_size: int = 10000,
) -> None:
    """Write ``df`` to ``table``.

    ``num_partitions`` is the number of concurrent connections: the rows are
    shuffled to it, so that the scan below keeps its own parallelism (with
    the writer's option alone Spark would coalesce the scan). ``mode="overwrite"`` truncates instead of dropping when
    ``truncate`` so grants and indexes survive.
    """
    if num_partitions:
        df = df.repartition(num_partitions)
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .mode(mode)
    )
    if mode == "overwrite" and truncate:
        writer = writer.option("truncate", "true")
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            writer = writer.option(k, v)
    writer.save()


def read_jdbc(
    spark: SparkSession,
    table: str,
    url: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read ``table``.

    Without ``partition_column`` the table is read through one connection
    (one task). With it, Spark splits ``[lower_bound, upper_bound)`` of that
    numeric, date or timestamp column into ``num_partitions`` strides and
    reads them in parallel (rows outside the bounds land in the first and
    last stride; nothing is dropped). Aggregates such as ``count`` are pushed
    down to the database where Spark's dialect for it supports that (e.g.
    Postgres); otherwise only the referenced columns are transferred.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("pushDownAggregate", "true")
    )
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", int(num_partitions))
        )
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            reader = reader.option(k, v)
    return reader.load()


def table_exists(spark: SparkSession, table: str, url: str, *, user=None, password=None, driver=None) -> bool:
    """Whether the database lists ``table`` (any case). Connection errors are raised, not taken for "no"."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in (("user", user), ("password", password)):
        if v is not None:
            properties.setProperty(k, v)
    if driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        found = connection.getMetaData().getTables(None, None, "%", None)
        name = table.split(".")[-1].lower()
        while found.next():
            if found.getString("TABLE_NAME").lower() == name:
                return True
        return False
    finally:
        connection.close()
