"""A corpus pipeline of five stages over ``documents``.

Every stage reads all rows that its predecessor wrote, decides on them, and
returns the columns of ``documents``; the last packs what is left.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, lines, near_duplicates, packing, quality
from ledgerlake.session import write_scratch_table
from ledgerlake.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts; ``n_chars`` follows."""
    cut = lines.remove_boilerplate(docs)
    changed = F.col("_removed_lines") > 0
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, n_chars).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return near_duplicates.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of packed sequences."""
    return packing.piece_digest(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: ProbMinHash, the tokenizer and task-wise packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet under the shared scratch folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
