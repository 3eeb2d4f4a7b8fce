"""Lazily derived layers for one input folder: events -> feed -> bronze ->
silver -> gold -> marts. Nothing is computed until an action runs; each
property is built once per ``Lineage`` object."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators import bars as bars_ops
from tickline.operators import marts, risk as risk_ops
from tickline.operators.silver import SilverOutputs, build_silver
from tickline.session import prepare_session
from tickline.sources.feed import build_feed
from tickline.sources.seed import read_seed


class Lineage:
    def __init__(self, spark: SparkSession, sf_dir: str, dirt: bool = True, bronze: DataFrame | None = None):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.dirt = dirt
        self._bronze = bronze

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def bronze(self) -> DataFrame:
        return self._bronze if self._bronze is not None else build_feed(self.events, dirt=self.dirt)

    @cached_property
    def silver(self) -> SilverOutputs:
        return build_silver(self.bronze)

    @cached_property
    def bars(self) -> DataFrame:
        return bars_ops.build_ohlcv_1m(self.silver.ticks, self.silver.trades)

    @cached_property
    def risk(self) -> DataFrame:
        return risk_ops.build_symbol_risk_daily(self.bars)

    @cached_property
    def stg_bars(self) -> DataFrame:
        return marts.stg_bars(self.bars)

    @cached_property
    def stg_risk(self) -> DataFrame:
        return marts.stg_risk(self.risk)

    @cached_property
    def seed(self) -> DataFrame:
        return read_seed(self.spark)

    @cached_property
    def dim(self) -> DataFrame:
        return marts.dim_symbol(self.seed, self.stg_risk)

    @cached_property
    def performance(self) -> DataFrame:
        return marts.daily_performance(self.stg_risk, self.dim)

    @cached_property
    def liquidity(self) -> DataFrame:
        return marts.intraday_liquidity(self.stg_bars)

    def as_of(self):
        """The run clock for freshness: the latest bronze landing time, as a
        scalar subquery (evaluated in Spark, never on the driver)."""
        return self.bronze.agg(F.max("ingested_at")).scalar()
