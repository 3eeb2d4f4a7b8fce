"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's ``events`` table (and nothing else but the
ten-row symbol seed) and derives its layer lazily, so its work grows with
the input. Doubles that come out of aggregations are rounded (digits per
column below) because sums of doubles depend on the order of addition;
row-level values are returned exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators import bars as bars_ops
from tickline.operators import ops, risk as risk_ops, serving
from tickline.operators.silver import TICK_KEY, TRADE_KEY, dedupe, kind_rows
from tickline.plans.corrections import QUERIES as CORRECTION_QUERIES
from tickline.plans.lineage import Lineage
from tickline.plans.periods import QUERIES as PERIOD_QUERIES
from tickline.plans.pipeline import Pipeline
from tickline.plans.stored import QUERIES as STORED_QUERIES
from tickline.plans.streams import QUERIES as STREAM_QUERIES
from tickline.quality.checks import run_contract, source_freshness
from tickline.quality.contracts import Contract, DatasetChecks, load_builtin
from tickline.quality.marts import MART_CONTRACTS, SOURCE_FRESHNESS, mart_contract, relationships
from tickline.schemas import TICK_COLUMNS, TRADE_COLUMNS
from tickline.session import scratch_path
from tickline.sources import tables
from tickline.sources.bronze import land_text, with_bronze_metadata
from tickline.sources.feed import TOPIC_TICKS, TOPIC_TRADES, as_kafka_records
from tickline.streaming.bronze_stream import read_kafka_files, start_bronze_stream
from tickline.streaming.incremental import stream_bars, stream_silver

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept for aggregated doubles in query output.
ROUND = {
    "avg_spread_bps": 9,
    "notional": 6,
    "vwap": 9,
    "total_notional": 6,
    "bucket_notional": 6,
    "realised_vol_annualised": 9,
    "avg_realised_vol": 9,
    "var_95_log_ret": 12,
    "max_drawdown": 12,
    "log_ret": 12,
    "day_return_pct": 9,
    "quarantine_rate": 9,
    "age_minutes": 6,
    "pass_rate": 9,
}

DISPLAY_SYMBOL = "GS"
FRESHNESS_MINUTES = 60


def rounded(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = digits or ROUND
    return df.select(
        *[
            (F.round(F.col(f"`{c}`"), digits[c]) + F.lit(0.0)).alias(c) if c in digits and t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def _lin(spark: SparkSession, sf_dir: str) -> Lineage:
    return Lineage(spark, sf_dir)


# ------------------------------------------------------------------ bronze
def q_feed_bronze(spark, sf_dir):
    return _lin(spark, sf_dir).bronze


def q_bronze_envelope(spark, sf_dir):
    env = with_bronze_metadata(as_kafka_records(_lin(spark, sf_dir).bronze))
    return env.drop("ingested_at", "ingest_date")


def q_land_text(spark, sf_dir):
    lines = _lin(spark, sf_dir).bronze.select(F.col("raw_value").alias("value"))
    return land_text(lines).select("raw_value", "kafka_topic", "kafka_partition")


# ------------------------------------------------------------------ silver
def _parsed(spark, sf_dir, kind):
    """One kind's rows of the tagged parse that the pipeline runs."""
    columns = TICK_COLUMNS if kind == "tick" else TRADE_COLUMNS
    return kind_rows(_lin(spark, sf_dir).silver.tagged, kind, columns).drop("quarantine_reason")


def q_parse_ticks(spark, sf_dir):
    return _parsed(spark, sf_dir, "tick")


def q_parse_trades(spark, sf_dir):
    return _parsed(spark, sf_dir, "trade")


def q_quarantine_ticks(spark, sf_dir):
    return _lin(spark, sf_dir).silver.quarantine_ticks


def q_quarantine_trades(spark, sf_dir):
    return _lin(spark, sf_dir).silver.quarantine_trades


def q_quarantine_unparsed(spark, sf_dir):
    return _lin(spark, sf_dir).silver.quarantine_unparsed


def q_dedupe_ticks(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, "tick")
    return dedupe(parsed, TICK_KEY).select(*TICK_KEY, "event_ts", "kafka_offset", "ingested_at")


def q_dedupe_trades(spark, sf_dir):
    parsed = _parsed(spark, sf_dir, "trade")
    return dedupe(parsed, TRADE_KEY).select(*TRADE_KEY, "symbol", "event_ts", "kafka_offset", "ingested_at")


def q_silver_ticks(spark, sf_dir):
    return _lin(spark, sf_dir).silver.ticks


def q_silver_trades(spark, sf_dir):
    return _lin(spark, sf_dir).silver.trades


# -------------------------------------------------------------------- gold
def q_ohlcv_1m(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).bars)


def q_minute_volume(spark, sf_dir):
    return rounded(bars_ops.build_minute_volume(_lin(spark, sf_dir).silver.trades))


def q_minute_returns(spark, sf_dir):
    r = risk_ops.minute_returns(_lin(spark, sf_dir).bars)
    return rounded(r.select("symbol", "trade_date", "minute", "close", "prev_close", "log_ret", "running_peak", "drawdown"))


def q_symbol_risk_daily(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).risk)


# ------------------------------------------------------------------- marts
def q_stg_bars(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).stg_bars)


def q_stg_risk(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).stg_risk)


def q_dim_symbol(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).dim)


def q_daily_performance(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).performance)


def q_intraday_liquidity(spark, sf_dir):
    return rounded(_lin(spark, sf_dir).liquidity)


# ----------------------------------------------------------------- serving
def q_risk_report(spark, sf_dir):
    return serving.risk_report(_lin(spark, sf_dir).risk)


def q_risk_display(spark, sf_dir):
    return rounded(serving.risk_display(_lin(spark, sf_dir).risk), {"VaR95 (log ret)": 12, "Spread (bps)": 9})


def q_symbol_bars(spark, sf_dir):
    return rounded(serving.symbol_bars(_lin(spark, sf_dir).bars, DISPLAY_SYMBOL))


def q_kpis(spark, sf_dir):
    return rounded(serving.kpis(_lin(spark, sf_dir).risk), {"total_notional": 6, "avg_realised_vol": 9})


def q_symbols(spark, sf_dir):
    return serving.symbols(_lin(spark, sf_dir).bars)


def q_ohlc_violations(spark, sf_dir):
    return rounded(serving.ohlc_violations(_lin(spark, sf_dir).bars))


# --------------------------------------------------------------------- ops
def q_quarantine_report(spark, sf_dir):
    s = _lin(spark, sf_dir).silver
    return ops.quarantine_report(
        {
            "quarantine_ticks": s.quarantine_ticks,
            "quarantine_trades": s.quarantine_trades,
            "quarantine_unparsed": s.quarantine_unparsed,
        }
    )


def q_quarantine_rate(spark, sf_dir):
    s = _lin(spark, sf_dir).silver
    return rounded(ops.quarantine_rate([s.ticks, s.trades], [s.quarantine_ticks, s.quarantine_trades]))


def q_stage_counts(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    s = lin.silver
    return ops.stage_counts(
        {
            "bronze": lin.bronze,
            "silver_ticks": s.ticks,
            "silver_trades": s.trades,
            "quarantine_ticks": s.quarantine_ticks,
            "quarantine_trades": s.quarantine_trades,
            "quarantine_unparsed": s.quarantine_unparsed,
            "ohlcv_1m": lin.bars,
            "symbol_risk_daily": lin.risk,
        }
    )


def q_conservation(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    return ops.conservation(lin.bronze, lin.silver)


def q_late_events(spark, sf_dir):
    tagged = _lin(spark, sf_dir).silver.tagged
    parsed = tagged.where(F.col("event_type").isin("tick", "trade")).select(
        "event_type", "symbol", "kafka_offset", F.col("event_ts_parsed").alias("event_ts")
    )
    return ops.late_events(parsed)


# ----------------------------------------------------------------- quality
def q_dq_ticks(spark, sf_dir):
    return run_contract(_lin(spark, sf_dir).silver.ticks, load_builtin("silver_ticks"))


def q_dq_trades(spark, sf_dir):
    return run_contract(_lin(spark, sf_dir).silver.trades, load_builtin("silver_trades"))


def q_dq_bars(spark, sf_dir):
    return run_contract(_lin(spark, sf_dir).bars, load_builtin("gold_ohlcv_1m"))


def _all_contract_results(lin: Lineage) -> DataFrame:
    s = lin.silver
    return (
        run_contract(s.ticks, load_builtin("silver_ticks"))
        .unionByName(run_contract(s.trades, load_builtin("silver_trades")))
        .unionByName(run_contract(lin.bars, load_builtin("gold_ohlcv_1m")))
    )


def q_dq_unique_key(spark, sf_dir):
    q = _lin(spark, sf_dir).silver.quarantine_ticks
    contract = Contract(dataset="silver/quarantine_ticks", checks=DatasetChecks(unique_key=TICK_KEY))
    return run_contract(q, contract)


def q_dq_unique(spark, sf_dir):
    q = _lin(spark, sf_dir).silver.quarantine_trades
    contract = Contract.from_dict(
        {
            "dataset": "silver/quarantine_trades",
            "columns": [{"name": "trade_id", "unique": True}, {"name": "trader_id", "unique": True}],
        }
    )
    return run_contract(q, contract)


def q_dq_freshness(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    contract = Contract(
        dataset="gold/ohlcv_1m",
        checks=DatasetChecks(freshness_column="minute", freshness_max_age_minutes=FRESHNESS_MINUTES),
    )
    return run_contract(lin.bars, contract, as_of=lin.as_of())


def q_dq_source_freshness(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    out = source_freshness(
        lin.bars,
        SOURCE_FRESHNESS["column"],
        SOURCE_FRESHNESS["warn_after_minutes"],
        SOURCE_FRESHNESS["error_after_minutes"],
        as_of=lin.as_of(),
        name="gold.ohlcv_1m",
    )
    return rounded(out)


def q_dq_marts(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    frames = {"dim_symbol": lin.dim, "daily_performance": lin.performance, "intraday_liquidity": lin.liquidity}
    out = None
    for name in MART_CONTRACTS:
        r = run_contract(frames[name], mart_contract(name))
        out = r if out is None else out.unionByName(r)
    return out


def q_dq_relationships(spark, sf_dir):
    lin = _lin(spark, sf_dir)
    return rounded(relationships(lin.performance, lin.dim, "symbol"))


def q_dq_pass_rate(spark, sf_dir):
    r = _all_contract_results(_lin(spark, sf_dir))
    out = r.agg(
        F.count_if("passed").alias("passed_checks"),
        F.count(F.lit(1)).alias("total_checks"),
    ).withColumn("pass_rate", F.col("passed_checks") / F.col("total_checks"))
    return rounded(out)


def q_dq_latest(spark, sf_dir):
    r = _all_contract_results(_lin(spark, sf_dir)).withColumn("checked_at", F.current_timestamp())
    return (
        r.orderBy(F.col("checked_at").desc(), "dataset", "check_name")
        .limit(50)
        .drop("checked_at")
    )


def q_dq_latest_share(spark, sf_dir):
    """Share of passed checks among the latest 50 results (the dashboard gauge)."""
    latest = q_dq_latest(spark, sf_dir)
    out = latest.agg(F.count_if("passed").alias("passed_checks"), F.count(F.lit(1)).alias("shown_checks"))
    return rounded(
        out.withColumn("pass_share", F.col("passed_checks") / F.greatest(F.col("shown_checks"), F.lit(1))),
        {"pass_share": 9},
    )


# ------------------------------------------------------------ tables / sinks
def q_publish_gold(spark, sf_dir):
    """Load the bars twice into a serving table; the table equals one load."""
    bars = _lin(spark, sf_dir).bars
    path = scratch_path(spark, "publish_ohlcv_1m")
    tables.publish(bars, path, ["trade_date"])
    tables.publish(bars, path, ["trade_date"])
    return rounded(spark.read.parquet(path))


def q_publish_after_removal(spark, sf_dir):
    """Load all bars, then a source without its first trade date: the serving table follows."""
    bars = _lin(spark, sf_dir).bars
    path = scratch_path(spark, "publish_after_removal")
    tables.publish(bars, path, ["trade_date"])
    first = spark.read.parquet(path).agg(F.min("trade_date")).first()[0]
    tables.publish(bars.where(F.col("trade_date") > F.lit(first)), path, ["trade_date"])
    return rounded(spark.read.schema(bars.schema).parquet(path))


def q_incremental_silver(spark, sf_dir):
    """Silver ticks built one ingest date at a time, the first of them twice."""
    lake = tables.Lake(scratch_path(spark, "incremental_silver"))
    bronze = _lin(spark, sf_dir).bronze
    Pipeline(spark, lake).land_bronze(bronze)
    dates = sorted(r[0] for r in bronze.select("ingest_date").distinct().collect())
    for date in [*dates[:1], *dates]:
        Pipeline(spark, lake).silver([date])
    return tables.read_table(spark, lake, "silver", "ticks")


def q_publish_records(spark, sf_dir):
    """Clean silver events routed to their topic, keyed by symbol, as JSON."""
    s = _lin(spark, sf_dir).silver
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    ticks = s.ticks.select(
        F.lit(TOPIC_TICKS).alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(
            F.struct(
                "event_type", "symbol", "venue", "seq", iso(F.col("event_ts")).alias("event_ts"),
                "bid", "ask", "bid_size", "ask_size", "last",
            )
        ).alias("value"),
    )
    trades = s.trades.select(
        F.lit(TOPIC_TRADES).alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(
            F.struct(
                "event_type", "trade_id", "symbol", "venue", iso(F.col("event_ts")).alias("event_ts"),
                "price", "qty", "side", "order_type", "trader_id",
            )
        ).alias("value"),
    )
    return ticks.unionByName(trades)


def q_compact(spark, sf_dir):
    """Write bars as many small files, compact them, read back."""
    bars = _lin(spark, sf_dir).bars
    path = scratch_path(spark, "compact_ohlcv_1m")
    bars.repartition(16).write.mode("overwrite").partitionBy("trade_date").parquet(path)
    tables.compact(spark, path, ["trade_date"], sort_by=["symbol", "minute"])
    return rounded(spark.read.parquet(path))


# --------------------------------------------------------------- streaming
def q_stream_bronze(spark, sf_dir):
    """The feed as Kafka-shaped files, ingested by the bronze stream
    (checkpointed, available-now trigger), read back without clock columns."""
    root = scratch_path(spark, "stream_bronze")
    as_kafka_records(_lin(spark, sf_dir).bronze).write.parquet(f"{root}/topic_log")
    q = start_bronze_stream(
        read_kafka_files(spark, f"{root}/topic_log"), f"{root}/bronze", f"{root}/checkpoint", trigger={"availableNow": True}
    )
    q.awaitTermination()
    return spark.read.parquet(f"{root}/bronze").drop("ingested_at", "ingest_date")


def q_stream_bars(spark, sf_dir):
    """Bronze streamed through incremental silver into windowed bars.

    The stored bronze is one micro-batch; the following no-data batch moves
    the watermark to (latest event time - 10 minutes) and emits every bar
    that closed before it. Bars still open at the end are not emitted.
    """
    lin = _lin(spark, sf_dir)
    root = scratch_path(spark, "stream_bars")
    lin.bronze.write.parquet(f"{root}/bronze")
    bronze = spark.readStream.schema(lin.bronze.schema).parquet(f"{root}/bronze")
    s = stream_silver(bronze)
    q = (
        stream_bars(s["ticks"], s["trades"])
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/bars")
    )
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/bars"))


QUERIES: dict[str, Query] = {
    "feed_bronze": q_feed_bronze,
    "bronze_envelope": q_bronze_envelope,
    "land_text": q_land_text,
    "parse_ticks": q_parse_ticks,
    "parse_trades": q_parse_trades,
    "quarantine_ticks": q_quarantine_ticks,
    "quarantine_trades": q_quarantine_trades,
    "quarantine_unparsed": q_quarantine_unparsed,
    "dedupe_ticks": q_dedupe_ticks,
    "dedupe_trades": q_dedupe_trades,
    "silver_ticks": q_silver_ticks,
    "silver_trades": q_silver_trades,
    "ohlcv_1m": q_ohlcv_1m,
    "minute_volume": q_minute_volume,
    "minute_returns": q_minute_returns,
    "symbol_risk_daily": q_symbol_risk_daily,
    "stg_bars": q_stg_bars,
    "stg_risk": q_stg_risk,
    "dim_symbol": q_dim_symbol,
    "daily_performance": q_daily_performance,
    "intraday_liquidity": q_intraday_liquidity,
    "risk_report": q_risk_report,
    "risk_display": q_risk_display,
    "symbol_bars": q_symbol_bars,
    "kpis": q_kpis,
    "symbols": q_symbols,
    "ohlc_violations": q_ohlc_violations,
    "quarantine_report": q_quarantine_report,
    "quarantine_rate": q_quarantine_rate,
    "stage_counts": q_stage_counts,
    "conservation": q_conservation,
    "late_events": q_late_events,
    "dq_ticks": q_dq_ticks,
    "dq_trades": q_dq_trades,
    "dq_bars": q_dq_bars,
    "dq_unique_key": q_dq_unique_key,
    "dq_unique": q_dq_unique,
    "dq_freshness": q_dq_freshness,
    "dq_source_freshness": q_dq_source_freshness,
    "dq_marts": q_dq_marts,
    "dq_relationships": q_dq_relationships,
    "dq_pass_rate": q_dq_pass_rate,
    "dq_latest": q_dq_latest,
    "dq_latest_share": q_dq_latest_share,
    "publish_gold": q_publish_gold,
    "publish_after_removal": q_publish_after_removal,
    "incremental_silver": q_incremental_silver,
    "publish_records": q_publish_records,
    "compact": q_compact,
    "stream_bronze": q_stream_bronze,
    "stream_bars": q_stream_bars,
    **STORED_QUERIES,
    **STREAM_QUERIES,
    **PERIOD_QUERIES,
    **CORRECTION_QUERIES,
}
