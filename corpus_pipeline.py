"""A training corpus in five stages, each an operator of ``hiatus.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns
of ``documents``; the last adds the copy's number and its place in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiatus.llm.decontamination import contamination
from hiatus.llm.mixing import mix
from hiatus.llm.queries import TOXICITY_CHAIN, table, toxicity_labels
from hiatus.llm.repeats import remove_repeats
from hiatus.llm.simhash import near_duplicates
from hiatus.llm.tables import written
from hiatus.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    judged = toxicity(docs, toxicity_labels(spark, sf_dir), TOXICITY_CHAIN)
    return judged.where(~F.col("rejected")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return near_duplicates(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that stand elsewhere too.

    A cut may fall inside a character, of which no byte is kept then. Every
    document stays, also one with nothing left; untouched texts stay as they are.
    """

    cut = remove_repeats(docs.select(*COLUMNS), whole_characters=True).withColumn("_cut", F.col("n_removed") > 0)
    left = F.col("kept").cast("string")
    return cut.withColumns(
        {
            "text": F.when(F.col("_cut"), left).otherwise(F.col("text")),
            "n_chars": F.when(F.col("_cut"), F.char_length(left).cast("long")).otherwise(F.col("n_chars")),
        }
    ).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with a benchmark item."""
    found = contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents such that each source has the same share of bytes."""
    return mix(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: The classifiers and the cuts can't be expressed in SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
