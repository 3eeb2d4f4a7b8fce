"""Bars kept right by stored states: late rows are merged into the hours they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickline.operators.corrections import bar_states, bars_of_states, merge_states
from tickline.plans.lineage import Lineage
from tickline.plans.streams import STREAM_ROUND
from tickline.session import scratch_path
from tickline.sources import tables
from tickline.sources.feed import REDELIVERY_OFFSET

#: Partition columns: the batch that brought a state, and the hours since 1970 of its minute.
BATCH, HOUR = "batch_id", "state_hour"


def hour_of(minute: str) -> Column:
    return F.floor(F.unix_seconds(F.col(minute)) / 3600).cast("int")


class CorrectedBars:
    """Bars under ``root`` and the states they come from.

    A batch's states are a partition of their own, replaced as a whole, so
    applying a batch again changes nothing. Only hours that a batch touches
    (or touched before, if it is applied anew) are read and written.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.states_path, self.bars_path = f"{root}/bar_states", f"{root}/ohlcv_1m"

    def _hours(self, batch_id: int) -> set[int]:
        stored = tables.read_if_exists(self.spark, self.states_path)
        if stored is None:
            return set()
        # a value an hour, read from partition names
        return {r[0] for r in stored.where(F.col(BATCH) == batch_id).select(HOUR).distinct().collect()}

    def states(self, schema: StructType, hours: set[int]) -> DataFrame:
        """Stored states of ``hours``, of every batch."""
        full = StructType([*schema.fields, StructField(BATCH, IntegerType()), StructField(HOUR, IntegerType())])
        return self.spark.read.schema(full).parquet(self.states_path).where(F.col(HOUR).isin(*sorted(hours)))

    def apply(self, batch_id: int, ticks: DataFrame, trades: DataFrame) -> set[int]:
        """Store the states of a batch of clean rows and rebuild the bars of its hours, which are returned."""
        new = bar_states(ticks, trades)
        before = self._hours(batch_id)
        placed = new.withColumn(BATCH, F.lit(batch_id)).withColumn(HOUR, hour_of("minute"))
        tables.publish(placed, self.states_path, [BATCH, HOUR], only=[batch_id])
        hours = before | self._hours(batch_id)
        if hours:
            bars = bars_of_states(merge_states(self.states(new.schema, hours)))
            tables.publish(bars.withColumn(HOUR, hour_of("minute")), self.bars_path, [HOUR], only=sorted(hours))
        return hours

    def bars(self) -> DataFrame:
        return self.spark.read.parquet(self.bars_path).drop(HOUR)


def q_bars_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the first nine tenths of the log; the rest comes as a second batch, which is applied twice."""
    lin, root = Lineage(spark, sf_dir), scratch_path(spark, "bars_corrected")
    top = lin.bronze.where(F.col("kafka_offset") < REDELIVERY_OFFSET).agg(F.max("kafka_offset")).first()[0] or 0
    late = F.col("kafka_offset") > top * 9 // 10
    kept = CorrectedBars(spark, root)
    lin.silver.ticks.write.parquet(f"{root}/ticks")
    lin.silver.trades.write.parquet(f"{root}/trades")
    ticks, trades = spark.read.parquet(f"{root}/ticks"), spark.read.parquet(f"{root}/trades")
    for batch_id, rows in ((0, ~late), (1, late), (1, late)):
        kept.apply(batch_id, ticks.where(rows), trades.where(rows))
    bars = kept.bars()
    return bars.select([F.round(c, STREAM_ROUND[c]) + F.lit(0.0) if c in STREAM_ROUND else F.col(c) for c in bars.columns]).toDF(*bars.columns)


QUERIES = {"bars_corrected": q_bars_corrected}
