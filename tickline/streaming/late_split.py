"""Late events on a stream: rows that arrive more than ``allowed`` behind what
their symbol has already shown go to a late table; the rest to on-time.

Spark's own watermark only drops late rows inside stateful operators; this
keeps them. Each micro-batch (``foreachBatch``):

1. reads the per-symbol high-water mark left by the latest earlier batch
   (one small row per symbol),
2. finds late rows with the same chunked prefix scan as the batch query,
3. writes late and on-time rows into a ``batch_id`` partition with dynamic
   overwrite, and the new high-water marks into their own ``batch_id``
   partition.

A batch that is retried after a failure rewrites exactly its own
partitions, so the outputs stay exactly-once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline.operators.ops import LATE_AFTER, late_events
from tickline.sources import tables

#: An offset counts within a topic and partition, so all three name a row.
ROW_IDENTITY = ("kafka_topic", "kafka_partition", "event_type", "kafka_offset")


def _write_batch(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def split_batch(batch: DataFrame, batch_id: int, root: str, allowed: str = LATE_AFTER) -> None:
    """Split one micro-batch of parsed rows (symbol, kafka_offset, event_ts and what else names a row).

    Every row of the batch ends in exactly one of the two tables.
    """
    spark = batch.sparkSession
    marks_path = f"{root}/high_water"
    marks = tables.read_if_exists(spark, marks_path)
    previous = sorted(int(r[0]) for r in marks.select("batch_id").distinct().collect()) if marks is not None else []
    earlier = [b for b in previous if b < batch_id]
    carried = marks.where(F.col("batch_id") == earlier[-1]).drop("batch_id") if earlier else None
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        identity = [c for c in ROW_IDENTITY if c in batch.columns]
        rows = batch.where(F.col("event_ts").isNotNull() & F.col("symbol").isNotNull())
        late = late_events(rows, allowed, carried_in=carried)
        same = [batch[c].eqNullSafe(F.col(f"__{c}")) for c in identity]
        # rows without a symbol or time can't be late: they are on time, for silver to judge
        on_time = batch.join(late.select([F.col(c).alias(f"__{c}") for c in identity]), same, "left_anti")
        _write_batch(late.withColumn("batch_id", F.lit(batch_id)), f"{root}/late")
        _write_batch(on_time.withColumn("batch_id", F.lit(batch_id)), f"{root}/on_time")
        seen = rows.groupBy("symbol").agg(F.max("event_ts").alias("high_water_ts"))
        if carried is not None:
            seen = seen.unionByName(carried).groupBy("symbol").agg(F.max("high_water_ts").alias("high_water_ts"))
        _write_batch(seen.withColumn("batch_id", F.lit(batch_id)), marks_path)
    finally:
        batch.unpersist()
    # a retry needs the marks of the batch before it; older ones have no reader
    tables.drop_partitions(spark, marks_path, "batch_id", earlier[:-1])


def start_late_split(parsed: DataFrame, root: str, checkpoint: str, allowed: str = LATE_AFTER, trigger: dict | None = None) -> StreamingQuery:
    """Run ``split_batch`` on every micro-batch of a parsed stream."""
    writer = parsed.writeStream.foreachBatch(lambda df, bid: split_batch(df, bid, root, allowed)).option(
        "checkpointLocation", checkpoint
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
