"""Gold -> marts: staging projections, the symbol dimension, daily facts and
intraday liquidity buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.functions import finance

RISK_STAGE_COLUMNS = [
    "symbol",
    "trade_date",
    "day_open",
    "day_high",
    "day_low",
    "day_close",
    "day_return_pct",
    "total_volume",
    "total_notional",
    "trade_count",
    "realised_vol_annualised",
    "var_95_log_ret",
    "max_drawdown",
    "avg_spread_bps",
]


def stg_bars(bars: DataFrame) -> DataFrame:
    """Bars renamed for the marts: ``minute`` -> ``bar_ts``, date re-derived."""
    return bars.select(
        "symbol",
        F.col("minute").alias("bar_ts"),
        F.to_date("minute").alias("trade_date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "notional",
        "vwap",
        "trade_count",
        "tick_count",
        "avg_spread_bps",
    )


def stg_risk(risk: DataFrame) -> DataFrame:
    return risk.select(*RISK_STAGE_COLUMNS)


def dim_symbol(seed: DataFrame, risk_stage: DataFrame) -> DataFrame:
    """Every seed symbol with its first / last trade date and mean realised vol.

    The observed side is pre-aggregated to one row per symbol before the
    join; the planner broadcasts whichever side its size allows.
    """
    observed = risk_stage.groupBy("symbol").agg(
        F.min("trade_date").alias("first_traded_date"),
        F.max("trade_date").alias("last_traded_date"),
        F.avg("realised_vol_annualised").alias("avg_realised_vol"),
    )
    return seed.join(observed, "symbol", "left").select(
        "symbol",
        "company_name",
        "sector",
        "base_price",
        F.col("annualised_vol").alias("design_vol"),
        "first_traded_date",
        "last_traded_date",
        "avg_realised_vol",
    )


def daily_performance(risk_stage: DataFrame, dim: DataFrame) -> DataFrame:
    """Risk rows with sector context, a liquidity rank per day and a vol bucket.

    The dimension has one row per seed symbol; whether it is small enough to
    broadcast is left to the planner, which knows its size. The rank orders
    one day's rows, one row per symbol, in one task. liquidity_rank is ``rank()`` by total notional within the day: ties share
    a rank and the next rank skips.
    """
    names = dim.select("symbol", "company_name", "sector")
    w = Window.partitionBy("trade_date").orderBy(F.col("total_notional").desc_nulls_first())
    r = risk_stage.join(names, "symbol", "left")
    return r.select(
        "symbol",
        "company_name",
        "sector",
        "trade_date",
        "day_open",
        "day_high",
        "day_low",
        "day_close",
        "day_return_pct",
        "total_volume",
        "total_notional",
        "trade_count",
        "realised_vol_annualised",
        "var_95_log_ret",
        "max_drawdown",
        "avg_spread_bps",
        F.rank().over(w).cast("bigint").alias("liquidity_rank"),  # bigint, as SQL engines type rank()
        finance.vol_bucket(F.col("realised_vol_annualised")).alias("vol_bucket"),
    )


def intraday_liquidity(bars_stage: DataFrame, width: str = "30 minutes") -> DataFrame:
    """Liquidity per (symbol, trade_date, 30-minute bucket).

    Spread is the unweighted mean of the bar spreads. Buckets start on the
    hour and the half hour (UTC session zone).
    """
    return (
        bars_stage.groupBy("symbol", "trade_date", F.window("bar_ts", width)["start"].alias("bucket_ts"))
        .agg(
            F.sum("volume").alias("bucket_volume"),
            F.sum("notional").alias("bucket_notional"),
            F.sum("trade_count").alias("bucket_trades"),
            F.avg("avg_spread_bps").alias("avg_spread_bps"),
            F.min("low").alias("bucket_low"),
            F.max("high").alias("bucket_high"),
        )
    )
