"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but space and the ASCII controls 9 to 13.
#: ``bytes.split()`` cuts at exactly these six bytes.
WORD_GAP = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array (null: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def set_aside(df: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with all columns but ``own`` under names that no operator uses, and these names.

    A name with a space in it: whatever the columns are called, helper
    columns added to the frame cannot meet them.
    """
    names = {c: f"carried {i}" for i, c in enumerate(df.columns) if c not in own}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns]), names


def put_back(columns: list[str], names: dict[str, str]) -> list[Column]:
    """The columns under their own names again."""
    return [F.col(f"`{names.get(c, c)}`").alias(c) for c in columns]


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``max_bytes`` of text (one row at least)."""
    sizes = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit integers (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, the same in every process; forgets all at ``limit``."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Order-sensitive 64-bit hash of every run of ``width`` word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15 + seed), dtype=np.uint64)
    for k in range(width):
        out *= np.uint64(0x100000001B3)
        out += hashes[k : k + n]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return mix64(out)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_digest(text: Column) -> Column:
    """128 bits that stand for a text (null counts as empty)."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("second"), whole).alias("b"))
