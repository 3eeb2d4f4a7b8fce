"""Registered streaming queries over several micro-batches and a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.plans.lineage import Lineage
from tickline.session import conf_set, scratch_path
from tickline.sources.feed import REDELIVERY_OFFSET
from tickline.streaming.incremental import stream_bars_join, stream_silver
from tickline.streaming.keyed_state import start_status_stream

SLICES = 4
HEARTBEAT = "heartbeat"
#: Rows of a slice that share a state partition.
STATE_ROWS = 250_000
#: Digits kept of doubles that depend on the order of addition.
STREAM_ROUND = {"avg_spread_bps": 9, "notional": 6, "vwap": 9}


def land_slices(bronze: DataFrame, path: str, slices: int = SLICES):
    """Append bronze in offset order, a file set for each slice and one for the redelivered copies; a generator."""
    top = bronze.where(F.col("kafka_offset") < REDELIVERY_OFFSET).agg(F.max("kafka_offset")).first()[0] or 0
    bounds = [top * k // slices for k in range(slices)] + [top + 1, REDELIVERY_OFFSET * 2]
    for low, high in zip(bounds, bounds[1:]):
        part = bronze.where((F.col("kafka_offset") >= low) & (F.col("kafka_offset") < high))
        part.write.mode("append").parquet(path)
        yield


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in five micro-batches, the job restarted after each: every row with its status."""
    lin, root = Lineage(spark, sf_dir), scratch_path(spark, "stream_late")
    # a timer is due a day later, so micro-batches without rows have nothing to do
    with conf_set(spark, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        for _ in land_slices(lin.bronze, f"{root}/bronze"):
            source = spark.readStream.schema(lin.bronze.schema).parquet(f"{root}/bronze")
            start_status_stream(source, f"{root}/rows", f"{root}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("kafka_topic", "kafka_partition", "kafka_offset", "status", "high_water_ts")


def heartbeat(bronze: DataFrame, after: str = "1 hour") -> DataFrame:
    """A quote and a trade of a symbol of their own, ``after`` the last row: they move the watermark past every bar."""
    at = F.date_format(F.max("ingested_at") + F.expr(f"INTERVAL {after}"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    common = f'"symbol":"{HEARTBEAT}","venue":"{HEARTBEAT}","event_ts":"'
    tick = F.concat(F.lit('{"event_type":"tick","seq":0,"bid":1.0,"ask":1.0,' + common), at, F.lit('"}'))
    trade = F.concat(F.lit('{"event_type":"trade","trade_id":"0","price":1.0,"qty":1,' + common), at, F.lit('"}'))
    one = bronze.agg(F.array(tick, trade).alias("values"), F.max("ingested_at").alias("t"))
    rows = one.select(F.explode("values").alias("raw_value"), "t")
    stamps = [F.col("t").alias("kafka_ts"), F.col("t").alias("ingested_at"), F.to_date("t").alias("ingest_date")]
    return rows.select("raw_value", F.lit(HEARTBEAT).alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.lit(0).cast("bigint").alias("kafka_offset"), *stamps)


def arrival_slices(bronze: DataFrame, slices: int = SLICES) -> tuple[list[DataFrame], int]:
    """Bronze in order of arrival, cut into slices of about as many rows, and the number of rows."""
    arrival = F.unix_micros("ingested_at")
    n, inner = bronze.agg(F.count("ingested_at"), F.percentile_approx(arrival, [k / slices for k in range(1, slices)])).first()
    bounds = [None, *(inner or []), None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        band = F.col("ingested_at").isNotNull()
        band = band if low is None else band & (arrival >= low)
        parts.append(bronze.where(band if high is None else band & (arrival < high)))
    return parts, n


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of the keyed state for slices of ``rows`` rows: the session's, unless fewer keep all cores busy.

    Every partition of every stateful operator commits its files in every
    micro-batch, with rows or without, and nothing coalesces them.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def q_stream_bars_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in order of arrival, a micro-batch a slice, joined into bars that all close.

    All tasks land a slice, so it is many files; the stream then takes all of
    them as one micro-batch and goes on from its checkpoint after the next.
    """
    lin, root = Lineage(spark, sf_dir), scratch_path(spark, "stream_bars_join")
    slices, rows = arrival_slices(lin.bronze)

    def run(close: bool) -> None:
        source = spark.readStream.schema(lin.bronze.schema).parquet(f"{root}/bronze")
        s = stream_silver(source)
        writer = stream_bars_join(s["ticks"], s["trades"]).writeStream.format("parquet").outputMode("append")
        # what a slice lets close comes out with the next one; only the last needs a micro-batch without rows
        with conf_set(spark, spark__sql__streaming__noDataMicroBatches__enabled=str(close).lower()):
            writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/bars").awaitTermination()

    with conf_set(spark, spark__sql__shuffle__partitions=str(state_partitions(spark, -(-rows // len(slices))))):
        for part in slices:
            part.write.mode("append").parquet(f"{root}/bronze")
            run(close=False)
        heartbeat(lin.bronze).coalesce(1).write.mode("append").parquet(f"{root}/bronze")
        run(close=True)
    bars = spark.read.parquet(f"{root}/bars")
    return bars.select([F.round(c, STREAM_ROUND[c]) + F.lit(0.0) if c in STREAM_ROUND else F.col(c) for c in bars.columns]).toDF(*bars.columns)


QUERIES = {"stream_late": q_stream_late, "stream_bars_join": q_stream_bars_join}
