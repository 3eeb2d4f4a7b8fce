"""Stream messages into bronze: one append-only query for every topic.

Replays after a restart are harmless: the checkpoint records the source
offsets that each committed micro-batch covered, and silver's keyed dedupe
absorbs the at-least-once redelivery of the source itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickline.schemas import KAFKA_SCHEMA
from tickline.sources.bronze import with_bronze_metadata

# ---------------------------------------------------------------- fixed values
MAX_OFFSETS_PER_TRIGGER = 50_000
TRIGGER_INTERVAL = "30 seconds"
# ------------------------------------------------------------ end fixed values


def read_kafka(
    spark: SparkSession,
    bootstrap: str,
    topics: list[str],
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """Kafka source for every topic, bounded micro-batches, no failure on
    retention loss. Needs the spark-sql-kafka package on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .option("failOnDataLoss", "false")
        .load()
    )


def read_kafka_files(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Files holding Kafka-shaped rows (key, value, topic, partition, offset,
    timestamp): the offline stand-in for ``read_kafka``. Each file is read
    once, in arrival order; ``max_files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(KAFKA_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def start_bronze_stream(
    source: DataFrame,
    bronze_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append the bronze envelope of ``source`` to ``bronze_path``,
    partitioned by ingest date and topic. ``trigger`` defaults to a
    processing-time trigger; tests pass ``{"availableNow": True}``."""
    trigger = trigger or {"processingTime": TRIGGER_INTERVAL}
    return (
        with_bronze_metadata(source)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date", "kafka_topic")
        .trigger(**trigger)
        .start(bronze_path)
    )


def write_kafka(records: DataFrame, bootstrap: str) -> None:
    """Publish (topic, key, value) records to the broker with idempotent,
    fully acknowledged, lz4-compressed producers. Needs the spark-sql-kafka
    package; ``records`` comes from routing events by kind and keying them
    by symbol (see the ``publish_records`` query)."""
    (
        records.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "lz4")
        .save()
    )
