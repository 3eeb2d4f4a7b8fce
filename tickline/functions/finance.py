"""Finance formulas as Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
TRADING_DAYS_PER_YEAR = 252
MINUTES_PER_SESSION = 390
VAR_QUANTILE = 0.05
BPS = 10_000
# Volatility buckets: at least 0.50 HIGH, at least 0.25 MEDIUM, else LOW.
VOL_BUCKETS = [(0.50, "HIGH"), (0.25, "MEDIUM")]
VOL_BUCKET_DEFAULT = "LOW"
# ------------------------------------------------------------ end fixed values

ANNUALISATION = math.sqrt(TRADING_DAYS_PER_YEAR * MINUTES_PER_SESSION)


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    return F.try_divide(ask - bid, mid(bid, ask)) * BPS


def log_return(close: Column, prev_close: Column) -> Column:
    """ln(close / prev_close); NULL without a positive previous close."""
    return F.when(prev_close.isNotNull() & (prev_close > 0), F.ln(F.try_divide(close, prev_close)))


def vol_bucket(vol: Column) -> Column:
    """HIGH / MEDIUM / LOW; a NULL volatility falls through to LOW."""
    expr = None
    for threshold, name in VOL_BUCKETS:
        expr = (F.when if expr is None else expr.when)(vol >= threshold, F.lit(name))
    return expr.otherwise(F.lit(VOL_BUCKET_DEFAULT))
