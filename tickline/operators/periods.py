"""Measures of any period from small stored states, merged without rescanning rows.

Value at risk merges one KLL sketch a (symbol, date); distinct traders merge one
Theta sketch a date; drawdown merges one (peak, trough, drawdown) state a
(symbol, date). A state's size doesn't grow with its rows, so a hot symbol or a
long period is a few states, never one task over all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions.finance import VAR_QUANTILE
from tickline.operators.risk import DAY_KEY

#: Size of a KLL sketch, and the bound on a quantile's rank error that goes with it (99 % confidence: 2.3 / k**0.9).
KLL_K = 1024
#: Theta sketches keep 2**THETA_LG hashes; counts up to that are exact, beyond it the error is 3 / sqrt(2**THETA_LG) at 99.7 %.
THETA_LG = 12


def kll_rank_error(k: int = KLL_K) -> float:
    return 2.296 / k**0.9021


def theta_error(lg: int = THETA_LG) -> float:
    return 3 / (2**lg - 1) ** 0.5


def period_start(date: Column, period: str) -> Column:
    """First day of the ``week`` or ``month`` (or ``day``, ``year``) of a date; ``all`` is one period."""
    return F.lit("1970-01-01").cast("date") if period == "all" else F.date_trunc(period, date).cast("date")


# ------------------------------------------------------------- value at risk
def return_sketches(returns: DataFrame, k: int = KLL_K) -> DataFrame:
    """One KLL sketch of log returns a (symbol, trade_date); days without returns have none."""
    return returns.where("log_ret IS NOT NULL").groupBy(*DAY_KEY).agg(F.kll_sketch_agg_double("log_ret", F.lit(k)).alias("sketch"))


def var_period(sketches: DataFrame, period: str, quantile: float = VAR_QUANTILE) -> DataFrame:
    """``symbol, period_start, n_returns, var_log_ret`` from merged daily sketches."""
    whole = sketches.groupBy("symbol", period_start(F.col("trade_date"), period).alias("period_start")).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select(
        "symbol",
        "period_start",
        F.kll_sketch_get_n_double("sketch").alias("n_returns"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(quantile)).alias("var_log_ret"),
    )


def within_rank_bound(var: DataFrame, returns: DataFrame, period: str, quantile: float = VAR_QUANTILE, bound: float | None = None) -> DataFrame:
    """``var`` with ``within_bound``: the exact rank of its value is as near to ``quantile`` as the sketch promises.

    One value stands for a range of ranks: those below it, up to those at or below it.
    """
    bound = kll_rank_error() if bound is None else bound
    rows = returns.where("log_ret IS NOT NULL").select("symbol", period_start(F.col("trade_date"), period).alias("period_start"), "log_ret")
    ranks = rows.join(var, ["symbol", "period_start"]).groupBy("symbol", "period_start").agg(
        (F.count_if(F.col("log_ret") < F.col("var_log_ret")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("log_ret") <= F.col("var_log_ret")) / F.count(F.lit(1))).alias("up_to"),
    )
    inside = (F.col("below") - bound <= quantile) & (F.col("up_to") + bound >= quantile)
    return var.join(ranks, ["symbol", "period_start"]).select(*var.columns, inside.alias("within_bound"))


# ------------------------------------------------------------------ drawdown
def drawdown_states(returns: DataFrame) -> DataFrame:
    """``peak``, ``trough`` and ``drawdown`` of the closes of a (symbol, trade_date)."""
    return returns.groupBy(*DAY_KEY).agg(F.max("close").alias("peak"), F.min("close").alias("trough"), F.min("drawdown").alias("drawdown"))


def drawdown_period(states: DataFrame, period: str) -> DataFrame:
    """Largest fall from a running peak over a period, across its days.

    Days follow one another as states: the fall is the least of each one's own
    and of each day's trough against the highest peak before it. A period's
    states (one a day) are folded in order; there is no window over its rows.
    """
    day = F.struct("trade_date", "peak", "trough", "drawdown")
    whole = states.groupBy("symbol", period_start(F.col("trade_date"), period).alias("period_start")).agg(F.sort_array(F.collect_list(day)).alias("days"))
    start = F.struct(F.lit(None).cast("double").alias("peak"), F.lit(None).cast("double").alias("drawdown"))

    def add(acc: Column, d: Column) -> Column:
        fall = F.try_divide(d["trough"], acc["peak"]) - 1
        return F.struct(F.greatest(acc["peak"], d["peak"]).alias("peak"), F.least(acc["drawdown"], d["drawdown"], fall).alias("drawdown"))

    folded = F.aggregate("days", start, add)
    return whole.select("symbol", "period_start", F.size("days").cast("bigint").alias("days"), folded["peak"].alias("peak"), folded["drawdown"].alias("max_drawdown"))


# ----------------------------------------------------------- distinct traders
def trader_sketches(trades: DataFrame, lg: int = THETA_LG) -> DataFrame:
    """One Theta sketch of trader ids a trade date."""
    return trades.groupBy("trade_date").agg(F.theta_sketch_agg("trader_id", F.lit(lg)).alias("sketch"))


def traders_seen(sketches: DataFrame) -> DataFrame:
    """For each date: traders of the day, of all days up to it, and those who had traded on the day before it in the table."""
    from pyspark.sql import Window

    order = Window.orderBy("trade_date")  # one row a date
    union = F.aggregate(
        F.collect_list("sketch").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("sketch"), lambda acc, s: F.theta_union(acc, s)
    )
    before = F.lag("sketch").over(order)
    return sketches.select(
        "trade_date",
        F.theta_sketch_estimate("sketch").alias("traders"),
        F.theta_sketch_estimate(union).alias("traders_to_date"),
        F.when(before.isNotNull(), F.theta_sketch_estimate(F.theta_intersection("sketch", F.coalesce(before, F.col("sketch"))))).otherwise(0).alias("returning"),
    )
