"""The corpus pipeline: quality rules, near-duplicate removal, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm import jaccard, mixing, packing, quality, substring
from chainlake.llm.catalog import TOKENIZER
from chainlake.llm.scratch import store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.judge(docs, carry=COLUMNS[1:]).filter("kept").select(*COLUMNS)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.one_of_each(docs, n=5, percent=80).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that start earlier elsewhere are cut out; each row stays, if with less text."""
    cut = substring.cut_repeats(docs, carry=("lang", "source"), as_is=True)
    return cut.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long")).select(*COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(packing.pieces(docs, TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The last stage's token ids have no SQL form; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
