"""Gold bars and daily risk on hand-made frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickline.functions.finance import ANNUALISATION
from tickline.operators.bars import build_ohlcv_1m, build_ohlcv_1m_single_aggregate
from tickline.operators.risk import build_symbol_risk_daily, minute_returns

T = dt.datetime(2024, 1, 2, 10, 0, 0)
TICK_SCHEMA = "symbol string, venue string, seq long, event_ts timestamp, mid double, spread_bps double"
TRADE_SCHEMA = "trade_id string, symbol string, event_ts timestamp, qty int, notional double"


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICK_SCHEMA)


def trades(spark, rows):
    return spark.createDataFrame(rows, TRADE_SCHEMA)


def test_vwap_volume_and_trade_count(spark):
    tk = ticks(spark, [("GS", "NYSE", 1, T.replace(second=1), 41.5, 6.0), ("GS", "NYSE", 2, T.replace(second=52), 40.25, 9.0)])
    tr = trades(spark, [("a", "GS", T.replace(second=8), 7, 287.0), ("b", "GS", T.replace(second=9), 1, 44.0), ("c", "GS", T.replace(second=59), 8, 333.0)])
    bar = build_ohlcv_1m(tk, tr).first()
    assert bar["vwap"] == 664.0 / 16 and bar["volume"] == 16 and bar["trade_count"] == 3
    assert (bar["open"], bar["high"], bar["low"], bar["close"]) == (41.5, 41.5, 40.25, 40.25)
    assert bar["avg_spread_bps"] == 7.5 and bar["tick_count"] == 2


def test_minute_without_trades_keeps_null_vwap_and_zero_volume(spark):
    tk = ticks(spark, [("GS", "NYSE", 1, T, 100.0, 1.0)])
    tr = trades(spark, [("a", "GS", T + dt.timedelta(minutes=5), 10, 1000.0)])  # minute without quotes: lost
    bars = build_ohlcv_1m(tk, tr).collect()
    assert len(bars) == 1
    assert bars[0]["volume"] == 0 and bars[0]["notional"] == 0.0 and bars[0]["trade_count"] == 0
    assert bars[0]["vwap"] is None


def test_open_close_ties_broken_by_seq_then_venue_any_partitioning(spark):
    same = T.replace(second=10)
    rows = [
        ("GS", "NYSE", 7, same, 101.0, 1.0),
        ("GS", "NYSE", 3, same, 102.0, 1.0),
        ("GS", "ARCA", 3, same, 103.0, 1.0),
        ("GS", "IEX", 9, same, 104.0, 1.0),
    ]
    tk = ticks(spark, rows)
    tr = trades(spark, [])
    for parts in (1, 2, 4):
        bar = build_ohlcv_1m(tk.repartition(parts).orderBy(F.rand(parts)), tr).first()
        assert bar["open"] == 103.0  # seq 3, venue ARCA < NYSE
        assert bar["close"] == 104.0  # seq 9


def test_union_aggregate_equals_join_form(spark):
    rows = [("S%d" % (i % 3), "NYSE", i, T + dt.timedelta(seconds=7 * i), 100.0 + i % 11, float(i % 5)) for i in range(300)]
    trs = [("t%d" % i, "S%d" % (i % 3), T + dt.timedelta(seconds=13 * i), 1 + i % 9, (1 + i % 9) * 100.0) for i in range(200)]
    a = build_ohlcv_1m(ticks(spark, rows), trades(spark, trs))
    b = build_ohlcv_1m_single_aggregate(ticks(spark, rows), trades(spark, trs)).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def bars_frame(spark, closes, day=T, gap_after=None):
    rows = []
    minute = day
    for i, c in enumerate(closes):
        rows.append(("GS", minute, c, c, c, c, 1.0, 1, 0, 0.0, None, 0, minute.date()))
        minute += dt.timedelta(minutes=2 if gap_after is not None and i == gap_after else 1)
    schema = ("symbol string, minute timestamp, open double, high double, low double, close double, avg_spread_bps double, "
              "tick_count long, volume long, notional double, vwap double, trade_count long, trade_date date")
    return spark.createDataFrame(rows, schema)


def test_one_bar_day_has_null_vol_and_var(spark):
    r = build_symbol_risk_daily(bars_frame(spark, [100.0])).first()
    assert r["realised_vol_annualised"] is None and r["var_95_log_ret"] is None
    assert r["max_drawdown"] == 0.0 and r["day_return_pct"] == 0.0


def test_two_bar_day_has_null_vol_one_return(spark):
    r = build_symbol_risk_daily(bars_frame(spark, [100.0, 101.0])).first()
    assert r["realised_vol_annualised"] is None
    assert r["var_95_log_ret"] == pytest.approx(math.log(1.01))


def test_gap_minute_return_spans_the_gap(spark):
    rets = minute_returns(bars_frame(spark, [100.0, 110.0, 99.0], gap_after=0)).orderBy("minute").collect()
    assert rets[1]["log_ret"] == pytest.approx(math.log(1.1))
    r = build_symbol_risk_daily(bars_frame(spark, [100.0, 110.0, 99.0], gap_after=0)).first()
    lr = [math.log(1.1), math.log(0.9)]
    mean = sum(lr) / 2
    sd = math.sqrt(sum((x - mean) ** 2 for x in lr) / 1)
    assert r["realised_vol_annualised"] == pytest.approx(sd * ANNUALISATION)


def test_rise_fall_rise_drawdown(spark):
    r = build_symbol_risk_daily(bars_frame(spark, [100.0, 120.0, 90.0, 130.0])).first()
    assert r["max_drawdown"] == pytest.approx(90.0 / 120.0 - 1)
    assert r["day_open"] == 100.0 and r["day_close"] == 130.0 and r["day_return_pct"] == pytest.approx(30.0)


def test_var_is_observed_fifth_percentile(spark):
    closes = [100.0]
    for i in range(40):
        closes.append(closes[-1] * (1.0 + ((i * 7) % 13 - 6) / 1000.0))
    rets = sorted(math.log(b / a) for a, b in zip(closes, closes[1:]))
    r = build_symbol_risk_daily(bars_frame(spark, closes)).first()
    assert r["var_95_log_ret"] == pytest.approx(rets[math.ceil(0.05 * len(rets)) - 1], rel=1e-12)


def test_no_return_across_days(spark):
    d1 = bars_frame(spark, [100.0, 101.0])
    d2 = bars_frame(spark, [200.0, 202.0], day=T + dt.timedelta(days=1))
    rets = minute_returns(d1.unionByName(d2)).where(F.col("log_ret").isNotNull()).count()
    assert rets == 2
