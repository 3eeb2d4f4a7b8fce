"""The corpus pipeline: raw documents to sampled token sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and read back as the
next one's ``docs``:

1. quality rules drop documents that fail the base rules or the likelihood ratio;
2. line dedup cuts repeated and nearly repeated lines out of the texts;
3. near-duplicate removal keeps the smallest id of each class;
4. decontamination drops documents with benchmark passages;
5. SentencePiece sampling encodes what is left, three distinct segmentations a text.

All but the last return the columns of ``documents``; ``n_chars``, where there
is one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import decontam, line_dedup, probminhash, quality_rules, sp_sampling
from tickline.llm.common import materialise, read_table, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.keep_good(docs, trusted)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = line_dedup.drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return probminhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sp_sampling.sample_segmentations(docs).drop("ids_sha256")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece_sampling", tokens),
]

#: Stages 1, 3 and 5 hash and sample in ways that SQL has no functions for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
