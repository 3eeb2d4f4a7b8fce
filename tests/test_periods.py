"""Stored states: what they merge to, how they are read, and payload drift."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickline.operators import drift, periods
from tickline.plans.lineage import Lineage
from tickline.plans.periods import drifted, footer_aggregates, footer_query, stored_freshness
from tickline.operators.risk import minute_returns
from tickline.streaming.keyed_state import LateAndDuplicate

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_drawdown_states_merge_like_one_window(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in ("a", "b"):
        close = 100.0
        for i in range(300):
            close *= float(np.exp(rng.normal(0, 0.02)))
            rows.append((s, pd.Timestamp("2024-01-01") + pd.Timedelta(hours=7 * i), close))
    bars = spark.createDataFrame([(s, m.to_pydatetime(), c) for s, m, c in rows], "symbol string, minute timestamp, close double").withColumn("trade_date", F.to_date("minute"))
    states = periods.drawdown_states(minute_returns(bars))
    for period in ("week", "month", "all"):
        got = {(r["symbol"], r["period_start"]): r["max_drawdown"] for r in periods.drawdown_period(states, period).collect()}
        want = {}
        for s in ("a", "b"):
            own = pd.DataFrame([(m, c) for x, m, c in rows if x == s], columns=["m", "c"])
            keys = {"week": own.m.dt.to_period("W-SUN").dt.start_time.dt.date, "month": own.m.dt.to_period("M").dt.start_time.dt.date, "all": [pd.Timestamp("1970-01-01").date()] * len(own)}[period]
            for k, g in own.groupby(keys):
                want[s, k] = (g.c / g.c.cummax() - 1).min()
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_periods_read_states_alone(spark, tmp_path):
    returns = minute_returns(Lineage(spark, SF_SMALL).bars)
    periods.return_sketches(returns).write.parquet(str(tmp_path / "r"))
    periods.drawdown_states(returns).write.parquet(str(tmp_path / "d"))
    merged = periods.var_period(spark.read.parquet(str(tmp_path / "r")), "month")
    folded = periods.drawdown_period(spark.read.parquet(str(tmp_path / "d")), "month")
    for df in (merged, folded):
        assert "Window" not in _plan(df) and df.count() > 0
    loose = periods.within_rank_bound(merged.withColumn("var_log_ret", F.lit(9.9)), returns, "month")
    assert not any(r["within_bound"] for r in loose.collect())


def test_freshness_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("us", F.col("id") * 7).repartition(3).write.parquet(path)
    assert stored_freshness(spark, path, "us") == (1000, 6993)
    with footer_aggregates(spark):
        plan = _plan(footer_query(spark, path, "us"))
    assert "PushedAggregation: [COUNT(*), MAX(us)]" in plan
    assert "PushedAggregation" not in _plan(footer_query(spark, path, "us"))


def test_variant_extraction_equals_from_json(spark, tmp_path):
    lin = Lineage(spark, SF_SMALL)
    lin.bronze.write.parquet(str(tmp_path / "b"))
    bronze = spark.read.parquet(str(tmp_path / "b"))
    rows = drift.as_variant(bronze).where("event_type = 'tick'").select(
        "kafka_offset", F.try_variant_get("payload", "$.bid", "double").alias("bid"), F.try_variant_get("payload", "$.seq", "bigint").alias("seq"), F.try_variant_get("payload", "$.symbol", "string").alias("symbol")
    )
    parsed = bronze.select("kafka_offset", F.from_json("raw_value", "event_type string, bid double, seq bigint, symbol string").alias("p")).where("p.event_type = 'tick'").select("kafka_offset", "p.bid", "p.seq", "p.symbol")
    assert rows.count() == parsed.count() and rows.exceptAll(parsed).count() == 0
    found = {(r["field"], r["drift"]) for r in drift.payload_drift(drifted(bronze)).select("field", "drift").distinct().collect()}
    assert {("fee", "unknown"), ("bid", "type"), ("venue", "type"), ("bid", "missing")} <= found
    assert drift.payload_drift(bronze.where("1 = 0")).count() == 0


class _Value:
    def __init__(self):
        self.held = None

    def get(self):
        return self.held

    def update(self, v):
        self.held = v

    def clear(self):
        self.held = None


class _Map(dict):
    def getValue(self, k):
        return self.get(k)

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        del self[k]

    def iterator(self):
        return iter(list(self.items()))


class _Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, *_):
        return _Value()

    def getMapState(self, *_):
        return _Map()

    def registerTimer(self, t):
        self.timers.append(t)


class _Due:
    def __init__(self, t):
        self.t = t

    def getExpiryTimeInMs(self):
        return self.t


def test_processor_marks_forgets_and_renews():
    p, handle = LateAndDuplicate(allowed_us=600_000_000, keep_ms=1000), _Handle()
    p.init(handle)

    def feed(now, *rows):
        """Rows of (offset, minute, digest, reason)."""
        df = pd.DataFrame(
            [("t", 0, "s", o, "tick", "", 0, None if m is None else m * 60_000_000, r, d, now) for o, m, d, r in rows],
            columns=["kafka_topic", "kafka_partition", "symbol", "kafka_offset", "event_type", "raw_value", "ingested_us", "event_us", "quarantine_reason", "digest", "seen_ms"],
        )
        out = next(p.handleInputRows(None, iter([df]), None))
        return list(out["status"]), list(out["high_water_us"].dropna() // 60_000_000)

    assert feed(0, (3, 100, 7, None), (1, 80, 5, None), (2, None, 6, "bad"), (4, 80, 5, None), (5, 89, 8, None)) == (["on_time", "quarantined", "on_time", "duplicate", "late"], [100])
    assert feed(500, (6, 90, 9, None), (7, 200, 1, None)) == (["on_time", "on_time"], [])
    assert feed(600, (8, 100, 7, None), (9, None, 0, "bad")) == (["duplicate", "quarantined"], [])
    assert handle.timers == [1000]
    p.handleExpiredTimer(None, None, _Due(1000))  # every minute but 80 and 89 was touched since
    assert sorted(m for (m,) in p.seen) == [90, 100, 200] and handle.timers == [1000, 2000]
    p.handleExpiredTimer(None, None, _Due(2000))
    assert not p.seen and p.mark.get() is None
    assert feed(2500, (10, 1, 5, None)) == (["on_time"], [])
