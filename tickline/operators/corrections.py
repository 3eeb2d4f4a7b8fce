"""Partial aggregate states of bars, which later rows join without a rebuild.

A state holds, for one (symbol, minute), what its quotes and trades so far
add up to: the first and last quote in bar order, the extreme mids, and sums
and counts. States of disjoint row sets merge by minimum, maximum and sum, in
any order and grouping, so a late row costs one more state and not another
scan of its date. A minute that has trades alone keeps its state: a quote that
comes later makes it a bar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.functions.timecols import bar_start
from tickline.operators.bars import BAR_KEY, bar_rows


def quote_states(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    quote = F.struct("event_ts", "seq", "venue", "mid")
    return ticks.groupBy("symbol", bar_start("event_ts", width).alias("minute")).agg(
        F.min(quote).alias("first_quote"),
        F.max(quote).alias("last_quote"),
        F.max("mid").alias("high"),
        F.min("mid").alias("low"),
        F.sum("spread_bps").alias("spread_sum"),
        F.count("spread_bps").alias("spread_count"),
        F.count(F.lit(1)).alias("tick_count"),
    )


def trade_states(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    return trades.groupBy("symbol", bar_start("event_ts", width).alias("minute")).agg(
        F.sum("qty").cast("bigint").alias("volume"), F.sum("notional").alias("notional"), F.count(F.lit(1)).alias("trade_count")
    )


def bar_states(ticks: DataFrame, trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """One state for each (symbol, minute) with a quote or a trade; the join adds no exchange."""
    return quote_states(ticks, width).join(trade_states(trades, width), BAR_KEY, "full")


def merge_states(states: DataFrame) -> DataFrame:
    """States of disjoint row sets as one state a (symbol, minute)."""
    least, most = ["first_quote", "low"], ["last_quote", "high"]
    sums = ["spread_sum", "spread_count", "tick_count", "volume", "notional", "trade_count"]
    merged = [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most] + [F.sum(c).alias(c) for c in sums]
    return states.groupBy(*BAR_KEY).agg(*merged)


def bars_of_states(states: DataFrame) -> DataFrame:
    """Bars of merged states, as ``build_ohlcv_1m`` gives them: minutes without quotes have none."""
    measured = states.where("tick_count > 0").select(
        *BAR_KEY,
        F.col("first_quote.mid").alias("open"),
        "high",
        "low",
        F.col("last_quote.mid").alias("close"),
        F.try_divide("spread_sum", "spread_count").alias("avg_spread_bps"),
        "tick_count",
        "volume",
        "notional",
        F.try_divide("notional", "volume").alias("vwap"),
        "trade_count",
    )
    return bar_rows(measured)
