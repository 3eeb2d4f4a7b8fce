"""Bars from stored states: late batches merged in equal a rebuild."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tickline.operators.bars import build_ohlcv_1m
from tickline.plans.corrections import CorrectedBars

TICKS = "symbol string, venue string, seq long, event_ts timestamp, mid double, spread_bps double, batch int"
TRADES = "symbol string, event_ts timestamp, qty int, notional double, batch int"


def test_late_batches_equal_a_rebuild_and_read_their_hours_alone(spark, tmpdir_path):
    rnd = random.Random(5)
    open_at = dt.datetime(2024, 1, 2, 9, 0, 0)
    at = lambda hours: open_at + dt.timedelta(hours=rnd.randrange(hours), minutes=rnd.randrange(5), seconds=rnd.randrange(60))
    ticks = [(rnd.choice("ab"), "v", k, at(3), 100 + rnd.randrange(400) / 64, rnd.randrange(64) / 8, 0) for k in range(200)]
    trades = [(rnd.choice("ab"), at(3), rnd.randrange(1, 9), rnd.randrange(1, 999) / 4, 0) for _ in range(100)]
    # late: quotes and trades of the first hour alone, one of them in a minute that had trades only so far
    ticks += [(rnd.choice("ab"), "v", 1000 + k, at(1), 90 + rnd.randrange(2000) / 64, rnd.randrange(64) / 8, 1) for k in range(20)]
    trades += [("a", open_at + dt.timedelta(minutes=7), 3, 30.0, 0), ("b", open_at + dt.timedelta(minutes=8), 2, 10.0, 1)]
    ticks += [("a", "v", 2000, open_at + dt.timedelta(minutes=7, seconds=5), 101.0, 1.0, 1)]
    t, d = spark.createDataFrame(ticks, TICKS), spark.createDataFrame(trades, TRADES)
    kept = CorrectedBars(spark, os.path.join(tmpdir_path, "c"))
    part = lambda df, k: df.where(F.col("batch") == k)
    assert len(kept.apply(0, part(t, 0), part(d, 0))) == 3
    minute = open_at + dt.timedelta(minutes=7)
    assert kept.bars().where((F.col("symbol") == "a") & (F.col("minute") == F.lit(minute))).count() == 0
    other = sorted(f for f in spark.read.parquet(kept.bars_path).where("hour(minute) > 9").select("_metadata.file_path").distinct().toPandas()["file_path"])
    hours = kept.apply(1, part(t, 1), part(d, 1))
    assert len(hours) == 1
    want = build_ohlcv_1m(t.drop("batch"), d.drop("batch"))
    rows = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert kept.bars().columns == want.columns and rows(kept.bars()) == rows(want)
    # the bars of other hours keep their files, and the states of other hours aren't read
    assert other == sorted(f for f in spark.read.parquet(kept.bars_path).where("hour(minute) > 9").select("_metadata.file_path").distinct().toPandas()["file_path"])
    plan = kept.states(spark.read.parquet(kept.states_path).drop("batch_id", "state_hour").schema, hours)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "state_hour" in filters[: filters.index("]")]
    # a batch applied again changes nothing; applied without its quotes, the hours it had touched follow
    kept.apply(1, part(t, 1), part(d, 1))
    assert rows(kept.bars()) == rows(want)
    kept.apply(1, part(t, 9), part(d, 9))
    assert rows(kept.bars()) == rows(build_ohlcv_1m(part(t, 0).drop("batch"), part(d, 0).drop("batch")))
