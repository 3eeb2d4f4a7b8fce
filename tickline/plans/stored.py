"""Registered queries over named tables: marts by name, gated publishing, the audit table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators import serving
from tickline.operators.risk import build_symbol_risk_daily
from tickline.plans.lineage import Lineage
from tickline.plans.pipeline import Pipeline
from tickline.quality.checks import ContractViolationError, run_contract
from tickline.quality.contracts import load_builtin
from tickline.quality.marts import relationships
from tickline.session import scratch_path
from tickline.sources import tables
from tickline.sources.feed import DIRT_EVERY, REDELIVERY_OFFSET
from tickline.sources.seed import read_seed
from tickline.sources.warehouse import Warehouse, audit_latest, audit_runs, build_marts, day_positions

FIRST_RUN = datetime(2024, 1, 4, 6, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 1, 4, 7, tzinfo=timezone.utc)
#: Every so many minutes a bar of the broken feed has its high and low exchanged.
BROKEN_EVERY = 7
MISSING_SECTOR = "Technology"


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"), f"tickline_{uuid.uuid4().hex[:8]}").create()


def broken_bars(bars: DataFrame) -> DataFrame:
    """Bars of which every ``BROKEN_EVERY``-th minute has high and low exchanged and no open."""
    bad = F.minute("minute") % BROKEN_EVERY == 0
    high, low = F.when(bad, F.col("low")).otherwise(F.col("high")), F.when(bad, F.col("high")).otherwise(F.col("low"))
    return bars.withColumns({"high": high, "low": low, "open": F.when(~bad, F.col("open"))})


def publish_serving(wh: Warehouse, lin: Lineage) -> None:
    wh.save(read_seed(wh.spark), "reference", "symbol_reference")
    wh.publish(lin.bars, "serving", "ohlcv_1m", load_builtin("gold_ohlcv_1m"), "run-1", FIRST_RUN, sort=("minute",))
    stored = wh.table("serving", "ohlcv_1m")
    wh.publish(build_symbol_risk_daily(stored), "serving", "symbol_risk_daily")


def q_catalog_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = new_warehouse(spark)
    publish_serving(wh, Lineage(spark, sf_dir))
    build_marts(wh)
    return day_positions(wh)


def q_gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good version, then one whose contract fails: readers by name still get the good one."""
    wh, lin = new_warehouse(spark), Lineage(spark, sf_dir)
    contract = load_builtin("gold_ohlcv_1m")
    wh.publish(lin.bars, "serving", "ohlcv_1m", contract, "run-1", FIRST_RUN)
    try:
        wh.publish(broken_bars(wh.table("serving", "ohlcv_1m")), "serving", "ohlcv_1m", contract, "run-2", SECOND_RUN)
    except ContractViolationError:
        pass
    shown = wh.table("serving", "ohlcv_1m").groupBy("trade_date").agg(F.count(F.lit(1)).alias("bars"), F.count("open").alias("with_open"), F.sum("volume").alias("volume"))
    failed = wh.table("audit", "dq_results").where("run_id = 'run-2' AND NOT passed").agg(F.count(F.lit(1)).alias("n")).scalar()
    return shown.withColumn("failed_checks", failed)


def _audited(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Two audited runs: all three contracts on good layers, then the bars contract on broken bars."""
    wh, lin = new_warehouse(spark), Lineage(spark, sf_dir)
    for frame, contract in ((lin.silver.ticks, "silver_ticks"), (lin.silver.trades, "silver_trades"), (lin.bars, "gold_ohlcv_1m")):
        wh.audit(run_contract(frame, load_builtin(contract)).collect(), "run-1", FIRST_RUN)
    wh.audit(run_contract(broken_bars(lin.bars), load_builtin("gold_ohlcv_1m")).collect(), "run-2", SECOND_RUN)
    return wh


def q_dq_audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_latest(_audited(spark, sf_dir))


def q_dq_audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_runs(_audited(spark, sf_dir)).withColumn("pass_rate", F.round("pass_rate", 9) + F.lit(0.0))


def q_ohlc_violations_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.ohlc_violations(broken_bars(Lineage(spark, sf_dir).bars))
    return found.select("symbol", "minute", "high", "low", "close", "trade_date")


def q_dq_relationships_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose symbol is missing from a dimension that lacks one sector."""
    lin = Lineage(spark, sf_dir)
    orphans = relationships(lin.performance, lin.dim.where(F.col("sector") != MISSING_SECTOR), "symbol")
    return orphans.select("symbol", "trade_date", "sector", "total_volume", "liquidity_rank")


def q_incremental_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copies are rejected after the fact: re-running their ingest dates brings the later copies back.

    The copies land two days after the originals. All dates are built, date by
    date; then the originals come again as payloads that don't parse, and only
    their own dates are re-run.
    """
    lake = tables.Lake(scratch_path(spark, "incremental_rejected"))
    copy = F.col("kafka_offset") >= REDELIVERY_OFFSET
    landed = F.when(copy, F.col("ingested_at") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ingested_at"))
    bronze = Lineage(spark, sf_dir).bronze.withColumn("ingested_at", landed).withColumn("ingest_date", F.to_date("ingested_at"))
    Pipeline(spark, lake).land_bronze(bronze)
    dates = sorted(r[0] for r in bronze.select("ingest_date").distinct().collect())
    for date in dates:
        Pipeline(spark, lake).silver([date])
    spoilt = F.when(F.col("kafka_offset") % DIRT_EVERY["redelivered"] == 0, F.lit("{")).otherwise(F.col("raw_value"))
    originals = bronze.where(~copy)
    again = sorted(r[0] for r in originals.select("ingest_date").distinct().collect())
    # the copies of those dates (copies of day one may land on a date of originals) are landed again beside them
    whole = bronze.where(F.col("ingest_date").isin(*again)).withColumn("raw_value", F.when(~copy, spoilt).otherwise(F.col("raw_value")))
    tables.write_table(whole, lake, "bronze", "events", "overwrite", ["ingest_date", "kafka_topic"], dynamic=True)
    Pipeline(spark, lake).silver(again)
    return tables.read_table(spark, lake, "silver", "ticks")


QUERIES = {
    "incremental_rejected": q_incremental_rejected,
    "catalog_marts": q_catalog_marts,
    "gated_publish": q_gated_publish,
    "dq_audit_latest": q_dq_audit_latest,
    "dq_audit_runs": q_dq_audit_runs,
    "ohlc_violations_found": q_ohlc_violations_found,
    "dq_relationships_found": q_dq_relationships_found,
}
