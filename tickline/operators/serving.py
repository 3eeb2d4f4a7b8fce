"""Serving reads: reports, dashboard projections and KPIs over gold and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def risk_report(risk: DataFrame) -> DataFrame:
    """Daily risk summary, rounded for print, ordered by symbol and date."""
    return risk.select(
        "symbol",
        "trade_date",
        F.round("day_close", 2).alias("close"),
        F.round("day_return_pct", 2).alias("ret_pct"),
        F.round(F.col("realised_vol_annualised") * 100, 1).alias("vol_pct"),
        F.round(F.col("max_drawdown") * 100, 2).alias("max_dd_pct"),
        F.col("total_volume").alias("volume"),
        "trade_count",
    ).orderBy("symbol", "trade_date")


# Dashboard column labels, in display order.
DISPLAY_LABELS = {
    "symbol": "Symbol",
    "trade_date": "Date",
    "day_close": "Close",
    "day_return_pct": "Return %",
    "realised_vol_annualised": "Vol % (ann.)",
    "var_95_log_ret": "VaR95 (log ret)",
    "max_drawdown": "Max DD %",
    "total_volume": "Volume",
    "trade_count": "Trades",
    "avg_spread_bps": "Spread (bps)",
}


def risk_display(risk: DataFrame) -> DataFrame:
    """The dashboard's risk table: vol and drawdown in percent, rounded, relabelled."""
    scaled = {
        "realised_vol_annualised": F.round(F.col("realised_vol_annualised") * 100, 1),
        "max_drawdown": F.round(F.col("max_drawdown") * 100, 2),
        "day_return_pct": F.round("day_return_pct", 2),
    }
    return risk.select(
        *[scaled.get(c, F.col(c)).alias(label) for c, label in DISPLAY_LABELS.items()]
    )


def symbol_bars(bars: DataFrame, symbol: str) -> DataFrame:
    """One symbol's bars in time order (candles and volume).

    On a table partitioned by trade_date and sorted by symbol the filter is
    pushed into the Parquet scan as a row-group predicate.
    """
    return bars.where(F.col("symbol") == symbol).orderBy("minute")


def kpis(risk: DataFrame) -> DataFrame:
    """Headline numbers: Σnotional, Σtrades, distinct symbols, mean realised vol."""
    return risk.agg(
        F.sum("total_notional").alias("total_notional"),
        F.sum("trade_count").alias("total_trades"),
        F.count_distinct("symbol").alias("symbols"),
        F.avg("realised_vol_annualised").alias("avg_realised_vol"),
    )


def symbols(bars: DataFrame) -> DataFrame:
    """Sorted distinct symbols (the dashboard's selector)."""
    return bars.select("symbol").distinct().orderBy("symbol")


def ohlc_violations(bars: DataFrame) -> DataFrame:
    """Bars breaking the envelope low <= open, close <= high (must be empty)."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad = (l > h) | (o > h) | (o < l) | (c > h) | (c < l)
    return bars.where(bad)
