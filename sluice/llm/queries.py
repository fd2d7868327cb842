"""The operators as queries over the tables of a folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The pattern that splits text before the merges of the rank files.
PATTERN = public_tokenizers.PATTERN


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file; a parameter of every operator that reads one."""
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(spark: SparkSession, sf_dir: str):
    from sluice.llm.quality import fit_quality, rating

    labels = table(spark, sf_dir, "labels").select("doc_id", rating(F.col("quality"), F.col("toxic")).alias("grade"))
    return fit_quality(table(spark, sf_dir, "documents"), labels)


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.pages import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.rules import apply_rules

    return apply_rules(table(spark, sf_dir, "documents"))


def op4_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.wavelet import encode_and_read

    return encode_and_read(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.decontaminate import find_contamination

    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.sharding import row_size, shard_documents

    placed = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.bpe import digest_documents

    return digest_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), PATTERN)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.spans import digest_repeats

    return digest_repeats(table(spark, sf_dir, "documents"))


def op9_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.lattice import score_documents

    return score_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.near import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), threshold=(85, 100))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.middle import fill_in_middle

    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.conversations import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of the subpackage by name."""
    return {name: f for name, f in sorted(globals().items(), key=lambda x: (len(x[0].split("_")[0]), x[0])) if name[:2] == "op" and name[2].isdigit()}
