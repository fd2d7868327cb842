"""From raw documents to token ids: quality, near-duplicates, repeated spans, benchmark passages, encoding.

Every stage takes null texts (as empty ones), null and repeated ids (such rows are judged each by itself, and none is lost as a
duplicate of another with its id), empty tables and further columns of any name; all but the last keep every column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.bpe import encode_documents
from sluice.llm.decontaminate import remove_contaminated
from sluice.llm.near import keep_one
from sluice.llm.quality import keep_good
from sluice.llm.queries import PATTERN, quality_model, table, tokenizer
from sluice.llm.spans import remove_repeats
from sluice.llm.storage import cleared, new_path
from sluice.session import ship
from sluice.sources.tables import delete


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted to the labels, takes for good."""
    return keep_good(docs, quality_model(ship(spark), sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (five-word shingles, similarity 0.8)."""
    ship(spark)
    return keep_one(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes of 100-byte strings that start earlier; n_chars follows."""
    ship(spark)
    return remove_repeats(docs, length_col="n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in benchmark windows."""
    return remove_contaminated(docs, table(ship(spark), sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit), with the digest of the decoded bytes."""
    ship(spark)
    encoded = encode_documents(docs, tokenizer("byte_bpe_multi_50k.tiktoken"), PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the fitted classifier nor the merges of the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next, its working tables deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with cleared(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
