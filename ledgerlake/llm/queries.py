"""Registered queries of the training-data operators (whole tables, production parameters)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (
    chat,
    decontaminate,
    fill_middle,
    html_text,
    lines,
    near_duplicates,
    packing,
    quality,
    secrets,
    sharding,
    substrings,
    token_alignment,
    urls,
)
from ledgerlake.llm.oracle import LLM_ORACLE_SQL
from ledgerlake.sources.tables import read_table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.with_probe_conversation(read_table(spark, sf_dir, "conversations"))
    return chat.digest_formatted(chat.format_conversations(conversations))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_digest(sharding.write_shards(sharding.shuffle_into_shards(docs)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge_quality(docs).drop("longest_repeat")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    labels = urls.labels_by_document_number(pages, read_table(spark, sf_dir, "labels"))
    return urls.judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict", "template")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.piece_digest(packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.repeat_digest(substrings.remove_repeats(docs))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    byte_path, piece_path = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align_tokenizers(docs, byte_path, piece_path)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_middle.fill_digest(fill_middle.fill_in_middle(docs))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.secret_digest(secrets.find_secrets(docs, public_tokenizers.path("word_bpe_49k.json")))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_sharding": op2_sharding,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_html_extraction": op5_html_extraction,
    "op6_packing": op6_packing,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_fill_middle": op12_fill_middle,
    "op13_secret_scan": op13_secret_scan,
}

__all__ = ["LLM_ORACLE_SQL", "LLM_QUERIES"]
