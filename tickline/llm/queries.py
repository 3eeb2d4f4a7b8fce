"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, filter_audit, html_wrappers, license_digest, line_dedup, probminhash, pu_quality, quality_rules, ranked_search, sp_sampling, substring_dedup, toxicity, warc
from .common import read_table, ship_package


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read_table(spark, sf_dir, "documents")).drop("text_key", "kept_text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = read_table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    lexicon, curve = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, lexicon, curve)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return captures.select(
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"),
        F.col("capture.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        "record_type",
        F.col("metadata.fields")["refers-to-page"].cast("long").alias("refers_to"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = quality_rules.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(read_table(spark, sf_dir, "documents"))


def op6_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_sampling.sample_segmentations(read_table(spark, sf_dir, "documents"), digest=True).drop("ids")


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    positives = read_table(spark, sf_dir, "labels").where(~held_out & (F.col("quality") == 1)).select("doc_id")
    net, prior = pu_quality.fit(docs, positives)
    scored = pu_quality.score(docs, net, prior)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("text_key", "kept_text")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.verdicts(decontam.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(read_table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.document_masks(docs, labels))


_ALL = [
    op1_line_dedup,
    op2_toxicity,
    op3_warc,
    op4_quality_rules,
    op5_license_scan,
    op6_sentencepiece_sampling,
    op7_pu_quality,
    op8_minhash_near_dedup,
    op9_substring_dedup,
    op10_benchmark_decontamination,
    op11_html_wrappers,
    op12_ranked_search,
    op13_filter_audit,
]


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir.rstrip("/"))

    return run


QUERIES = {f.__name__: _registered(f) for f in _ALL}
