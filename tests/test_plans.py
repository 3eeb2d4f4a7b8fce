"""Plan shapes the scale design depends on (static plans, AQE off)."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tickline.operators import bars as bars_ops
from tickline.operators import marts, risk as risk_ops, serving
from tickline.operators.silver import build_silver
from tickline.plans.lineage import Lineage
from tickline.quality.checks import run_contract
from tickline.quality.contracts import load_builtin
from tickline.sources.seed import read_seed

from conftest import SF_SMALL


@pytest.fixture()
def static_plans(spark):
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver and gold written to Parquet, as the pipeline leaves them."""
    root = str(tmp_path_factory.mktemp("stored"))
    lin = Lineage(spark, SF_SMALL)
    lin.silver.ticks.write.partitionBy("trade_date").parquet(os.path.join(root, "ticks"))
    lin.silver.trades.write.partitionBy("trade_date").parquet(os.path.join(root, "trades"))
    lin.bars.write.partitionBy("trade_date").parquet(os.path.join(root, "bars"))
    return root


def test_bronze_parsed_once(spark, static_plans):
    out = build_silver(Lineage(spark, SF_SMALL).bronze)
    for df in (out.ticks, out.quarantine_trades):
        assert count(r"from_json\(StructField\(event_type", plan(df)) == 1  # the payload; props parses are the feed's


def test_dedupe_limits_before_and_after_exchange(spark, static_plans):
    p = plan(Lineage(spark, SF_SMALL).silver.ticks)
    assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p


def test_bars_join_adds_no_exchange(spark, static_plans, stored):
    ticks = spark.read.parquet(os.path.join(stored, "ticks"))
    trades = spark.read.parquet(os.path.join(stored, "trades"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(bars_ops.build_ohlcv_1m(ticks, trades))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    assert count(r"Exchange hashpartitioning", p) == 2  # one per aggregate, none for the join


def test_risk_window_and_aggregate_share_one_exchange(spark, static_plans, stored):
    p = plan(risk_ops.build_symbol_risk_daily(spark.read.parquet(os.path.join(stored, "bars"))))
    assert count(r"Exchange", p) == 1 and "Window" in p


def test_dimension_join_is_left_to_the_planner(spark, static_plans, stored):
    risk = marts.stg_risk(risk_ops.build_symbol_risk_daily(spark.read.parquet(os.path.join(stored, "bars"))))
    dim = marts.dim_symbol(read_seed(spark), risk)
    performance = marts.daily_performance(risk, dim)
    hinted = performance._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted  # the seed can be any file, so no size is assumed
    p = plan(performance)
    assert "HashJoin" in p or "SortMergeJoin" in p
    assert "Cartesian" not in p and "NestedLoop" not in p


def test_count_checks_single_scan_of_the_table(spark, static_plans, stored):
    ticks = spark.read.parquet(os.path.join(stored, "ticks"))
    p = plan(run_contract(ticks, load_builtin("silver_ticks")))
    # one scan for every count check + one for the unique_key grouping
    assert count(r"FileScan parquet", p) == 2


def test_filters_and_columns_reach_the_scan(spark, static_plans, stored):
    bars = spark.read.parquet(os.path.join(stored, "bars"))
    p = plan(serving.symbol_bars(bars, "GS"))
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,GS)]" in p
    p = plan(bars.where(F.col("trade_date") == "2024-01-02").select("symbol", "close"))
    assert "PartitionFilters: [isnotnull(trade_date" in p
    assert re.search(r"ReadSchema: struct<symbol:string,close:double>", p)


def test_no_python_udf_in_core_plans(spark, static_plans):
    lin = Lineage(spark, SF_SMALL)
    for df in (lin.silver.ticks, lin.bars, lin.risk, lin.performance, lin.liquidity):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
