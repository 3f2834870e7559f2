"""A training corpus in stages: each takes what the one before kept and returns what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import leaks, lines, packing, simhash, toxicity
from tallyframe.llm.catalog import MIN_LINES, table, vocabulary
from tallyframe.session import new_folder

#: Near copies: fingerprints of four-word shingles that differ in at most 4 of 64 bits.
NEAR_COPIES = simhash.Rule(words=4, radius=4)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Learned from labels of learning rows alone."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their later repeated runs of lines; those of which nothing is left go."""
    kept = lines.drop_repeated_lines(docs, MIN_LINES)
    whole = kept.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return whole.withColumn("n_chars", changed).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.one_of_each(docs, NEAR_COPIES)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences of 2048 ids."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), packing.SIZE, with_ids=False)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_leaks),
    ("packing", packed),
]

#: No SQL: neither the scores of a fitted classifier nor the ids of a tokenizer can be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
