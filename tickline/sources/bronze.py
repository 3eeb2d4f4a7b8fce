"""Bronze: the raw payload kept exactly as it arrived, plus landing metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def with_bronze_metadata(kafka_df: DataFrame) -> DataFrame:
    """Kafka-shaped rows -> bronze envelope.

    The payload is only cast to a string, never parsed here, so a message
    that fails to parse is still kept. Works on batch and streaming frames.
    """
    now = F.current_timestamp()
    return kafka_df.select(
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_ts"),
        now.alias("ingested_at"),
        F.to_date(now).alias("ingest_date"),
    )


def land_text(lines: DataFrame, topic: str = "local.file", partition: int = 0) -> DataFrame:
    """Batch landing of JSON-lines text (one ``value`` column) as bronze.

    Offsets come from ``monotonically_increasing_id``: unique, but they depend
    on the input partitioning, so they are only a tie-breaker within one run.
    """
    now = F.current_timestamp()
    return lines.select(
        F.col("value").alias("raw_value"),
        F.lit(topic).alias("kafka_topic"),
        F.lit(partition).cast("int").alias("kafka_partition"),
        F.monotonically_increasing_id().alias("kafka_offset"),
        now.alias("kafka_ts"),
        now.alias("ingested_at"),
        F.to_date(now).alias("ingest_date"),
    )


def read_text_lines(spark, path: str) -> DataFrame:
    """JSON-lines files as a one-column ``value`` frame (splittable text scan)."""
    return spark.read.text(path)
