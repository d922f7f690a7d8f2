"""Sharding by a two-pass external shuffle.

Pass one scatters the records: a seeded hash of the id names the shard
(highest-random-weight, so a further shard takes records only into itself)
and a hash of id and text, within the shard, one of as many buckets as its
bytes need to fit in memory (half of ``bucket_bytes`` on average). Pass two reads one bucket at a time, Fisher-Yates shuffles it with a
seed of its own and writes it. Slots run through a shard's buckets.

The scatter is Spark's shuffle (files on disk, recomputed from lineage if an
executor is lost). Within a bucket the rows arrive sorted by a second hash,
so a rerun of a task sees the same order and draws the same permutation. Rows
of one id spread by their texts, so every bucket is shuffled as a whole. Only
rows that are equal in id and text must share a bucket; one that they make
four times as large as planned is shuffled in runs, which bounds memory.

Cases: null text counts as empty (1 byte, CRC 0); null ids share one shard;
equal rows are kept, each with its own slot; an empty table gives no rows;
columns other than id and text are carried through, whatever their names, but
those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import put_back, set_aside, shuffle_partitions
from ledgerlake.session import new_run_dir

BUCKET_BYTES = 16 << 20
#: Text that a task of the second pass reads, bucket by bucket.
TASK_BYTES = 64 << 20
SHARDING_COLUMNS = ("shard", "grown_shard", "slot")


def shard_of(key: Column, n_shards: int, seed: int = 0) -> Column:
    """The shard whose hash with ``key`` is highest: growing to n+1 shards moves keys to shard n only."""
    weights = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("w"), F.lit(s).alias("s")) for s in range(n_shards)]
    return F.array_max(F.array(*weights))["s"]


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0..n-1: swap each place, from the last, with one at or before it."""
    order = np.arange(n)
    draws = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle_buckets(batches: Iterator[pa.RecordBatch], seed: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in, each bucket shuffled out (in runs of ``limit`` bytes), ``_pos`` filled in."""
    bucket, held, size, done = None, [], 0, 0

    def flush():
        nonlocal held, size, done
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        rng = np.random.default_rng([seed & 0x7FFFFFFF, bucket, done])
        table = table.take(pa.array(fisher_yates(table.num_rows, rng)))
        at = table.schema.get_field_index("_pos")
        pos = pa.array(np.arange(done, done + table.num_rows), type=pa.int64())
        yield from table.set_column(at, table.schema.field(at), pos).to_batches(max_chunksize=2048)
        done += table.num_rows
        held, size = [], 0

    for batch in batches:
        ids = batch.column("_bucket").to_numpy()
        cuts = np.flatnonzero(np.diff(ids)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
            if lo == hi:
                continue
            if ids[lo] != bucket:
                yield from flush()
                bucket, done = int(ids[lo]), 0
            elif size > limit:
                yield from flush()
            held.append(batch.slice(lo, hi - lo))
            size += int(batch.column("_size").slice(lo, hi - lo).to_numpy().sum())
    yield from flush()


def shuffle_into_shards(
    docs: DataFrame,
    n_shards: int = 8,
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs`` plus shard, grown_shard and slot (0.. without gaps in each shard).

    Columns of ``docs`` that have one of these names are dropped. Runs one
    aggregate over the sizes to find the number of buckets.
    """
    columns = [c for c in docs.columns if c not in SHARDING_COLUMNS]
    docs, names = set_aside(docs.select(*[f"`{c}`" for c in columns]), id_col, text_col)
    own = [F.col(id_col), F.col(text_col)]
    placed = docs.withColumns(
        {
            "shard": shard_of(F.col(id_col), n_shards, seed),
            "grown_shard": shard_of(F.col(id_col), n_shards + 1, seed),
            "_size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1,
            "_order": F.xxhash64(F.lit(seed + 2), *own),
        }
    )
    most = placed.groupBy("shard").agg(F.sum("_size").alias("n")).agg(F.max("n")).first()[0] or 0
    per_shard = max(1, -(-2 * int(most) // bucket_bytes))
    scattered = placed.withColumn(
        "_bucket", F.col("shard").cast("long") * per_shard + F.pmod(F.xxhash64(F.lit(seed + 1), "_order"), F.lit(per_shard))
    )

    # As many tasks as the bytes ask for, so that a task's share does not grow with the data.
    rows = (
        scattered.withColumn("_pos", F.lit(0).cast("long"))
        .repartition(max(shuffle_partitions(docs), -(-n_shards * int(most) // TASK_BYTES)), "_bucket")
        .sortWithinPartitions("_bucket", "_order")
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    dealt = rows.mapInArrow(lambda batches: _shuffle_buckets(batches, seed, 2 * bucket_bytes), schema)

    # Where each bucket starts in its shard: one row a bucket, from the ids alone.
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        scattered.groupBy("shard", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        dealt.join(starts, F.col("_bucket") == F.col("_b"))
        .withColumn("slot", F.col("_start") + F.col("_pos"))
        .select(*put_back(columns, names), *SHARDING_COLUMNS)
    )


def write_shards(shuffled: DataFrame, path: str | None = None) -> DataFrame:
    """Write the shards (folders ``shard=<n>``) and return the table read back."""
    path = path or new_run_dir(shuffled.sparkSession, "shards")
    shuffled.write.partitionBy("shard").parquet(path)
    return shuffled.sparkSession.read.schema(shuffled.schema).parquet(path)


def shard_digest(sharded: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per record of a sharded table: its size, CRC, law, shard and slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return sharded.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
