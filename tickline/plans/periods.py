"""Registered queries over stored states: periods, payload drift, freshness from file footers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators import drift, periods
from tickline.operators.risk import minute_returns
from tickline.plans.lineage import Lineage
from tickline.session import scratch_path

#: Drift put into the feed: every so many offsets a trade with a fee, a quote with a text bid, a trade with a venue list.
FEE_EVERY, TEXT_EVERY, LIST_EVERY = 11, 13, 17


def _stored(df: DataFrame, name: str, *partition: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*partition) if partition else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_var_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly value at risk from stored daily sketches; whether its exact rank is within the bound."""
    returns = minute_returns(Lineage(spark, sf_dir).bars)
    sketches = _stored(periods.return_sketches(returns), "return_sketches", "trade_date")
    var = periods.var_period(sketches, "week")
    return periods.within_rank_bound(var, returns, "week").drop("var_log_ret")


def q_drawdown_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawdown over the month, across its days, from stored daily states."""
    states = _stored(periods.drawdown_states(minute_returns(Lineage(spark, sf_dir).bars)), "drawdown_states", "trade_date")
    out = periods.drawdown_period(states, "month")
    return out.withColumn("max_drawdown", F.round("max_drawdown", 12) + F.lit(0.0))


def q_traders_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traders a day, to date and returning, from stored sketches, against exact counts within the sketch's error."""
    trades = Lineage(spark, sf_dir).silver.trades
    seen = periods.traders_seen(_stored(periods.trader_sketches(trades), "trader_sketches", "trade_date"))
    exact = trades.groupBy("trade_date").agg(F.count_distinct("trader_id").alias("exact_traders"))
    near = F.abs(F.col("traders") - F.col("exact_traders")) <= F.ceil(periods.theta_error() * F.col("exact_traders"))
    return seen.join(exact, "trade_date").select("trade_date", "exact_traders", near.alias("within_bound"), (F.col("returning") <= F.col("traders_to_date")).alias("returning_fits"))


def drifted(bronze: DataFrame) -> DataFrame:
    """Bronze with drift in some payloads: an unknown field, a number as text, a list for a text."""
    raw, offset = F.col("raw_value"), F.col("kafka_offset")
    trade = raw.startswith('{"event_type":"trade"')
    fee = F.regexp_replace(raw, '^\\{"event_type":"trade"', '{"event_type":"trade","fee":0.5')
    text = F.regexp_replace(raw, '"bid":([0-9.-]+)', '"bid":"$1"')
    listed = F.regexp_replace(raw, '"venue":"([A-Z]+)"', '"venue":["$1"]')
    changed = F.when(trade & (offset % FEE_EVERY == 0), fee).when(~trade & (offset % TEXT_EVERY == 0), text).when(trade & (offset % LIST_EVERY == 0), listed).otherwise(raw)
    return bronze.withColumn("raw_value", changed)


def q_payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of stored bronze: the payload text is read back, not derived again for every use of it."""
    return drift.payload_drift(_stored(drifted(_stored(Lineage(spark, sf_dir).bronze, "bronze")), "drifted"))


@contextmanager
def footer_aggregates(spark: SparkSession):
    """Parquet scans started inside answer ``max``, ``min`` and ``count`` from file footers."""
    keys = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_freshness(spark: SparkSession, path: str, micros: str) -> tuple[int, int | None]:
    """Rows of a stored table and the latest value of a column of microseconds, without reading a row."""
    with footer_aggregates(spark):
        return tuple(footer_query(spark, path, micros).first())


def footer_query(spark: SparkSession, path: str, micros: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.max(micros).alias("latest"))


def q_stored_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lin, path = Lineage(spark, sf_dir), scratch_path(spark, "stored_freshness")
    lin.bars.withColumn("minute_us", F.unix_micros("minute")).write.parquet(path)
    rows, latest = stored_freshness(spark, path, "minute_us")
    behind = (F.unix_micros(F.max("ingested_at")) - F.lit(latest)) / 6e7
    return lin.bronze.agg(behind.alias("age_minutes")).select(
        F.lit(rows).cast("bigint").alias("rows"), F.timestamp_micros(F.lit(latest)).alias("max_loaded"), (F.round("age_minutes", 6) + F.lit(0.0)).alias("age_minutes")
    )


QUERIES = {
    "var_period": q_var_period,
    "drawdown_period": q_drawdown_period,
    "traders_seen": q_traders_seen,
    "payload_drift": q_payload_drift,
    "stored_freshness": q_stored_freshness,
}
