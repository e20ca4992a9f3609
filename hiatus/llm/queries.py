"""The operators over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiatus.llm.archives import archived
from hiatus.llm.conversations import damaged, repair, repair_report
from hiatus.llm.decontamination import contamination, hit_words
from hiatus.llm.embeddings import near_embeddings
from hiatus.llm.fingerprints import edited_fingerprints
from hiatus.llm.language_model import score_texts
from hiatus.llm.licenses import scan_licenses
from hiatus.llm.mixing import mix
from hiatus.llm.prefix_trie import prefix_trie, spliced, turn_sequences
from hiatus.llm.repeats import remove_repeats
from hiatus.llm.simhash import near_duplicates
from hiatus.llm.token_counts import token_counts
from hiatus.llm.toxicity import toxicity

#: Chain order: the label columns that the models learn, the last one decides.
TOXICITY_CHAIN = ("low_quality", "toxic")

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic"
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived(table(spark, sf_dir, "pages"))
    return records.select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(documents, keep=["doc_id"])


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(documents).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(documents, public_tokenizers.path(BYTE_VOCABULARY)).drop("text")


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(documents, public_tokenizers.path(PIECE_VOCABULARY))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    hits = hit_words()
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(documents, toxicity_labels(spark, sf_dir), TOXICITY_CHAIN).select(
        "doc_id",
        *[f"p_{c}" for c in TOXICITY_CHAIN],
        F.col("rejected").alias("toxic"),
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report = repair_report(repair(damaged(conversations)))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    joined = every.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spliced(turn_sequences(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_licenses": op4_licenses,
    "op5_token_counts": op5_token_counts,
    "op6_poisson_mix": op6_poisson_mix,
    "op7_embeddings": op7_embeddings,
    "op8_language_model": op8_language_model,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_minhash": op11_minhash,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
