"""Deterministic market feed derived from the driver's ``events`` table.

The engine's tests and queries need quote and trade messages; the driver
ships generic click events. This module maps each event to one message
(integer arithmetic until the final price division, so any SQL engine can
rebuild the same values) and injects a fixed set of defects, then returns
bronze-shaped rows: JSON payload plus Kafka-style metadata.

Everything is a single projection over ``events`` plus one filtered
union for redelivered messages: no shuffle, no driver round trip.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Symbol universe, in order; the s-th symbol is picked by user_id % 10.
SYMBOLS = ["AAPL", "MSFT", "NVDA", "AMZN", "GOOG", "META", "TSLA", "GS", "JPM", "MS"]
# Venues, in order; picked by event_id % 4.
VENUES = ["NYSE", "NASDAQ", "ARCA", "IEX"]
# Driver event types that become trades; every other type becomes a tick.
TRADE_EVENT_TYPES = ["purchase", "signup"]
TOPIC_TICKS = "market.ticks.v1"
TOPIC_TRADES = "market.trades.v1"
KAFKA_PARTITIONS = 6
SESSION_OPEN = datetime(2024, 1, 2, 13, 30, tzinfo=timezone.utc)
# Time folding: seconds of the driver's day are scaled by 13/48 onto a 6.5 h session.
FOLD_NUM, FOLD_DEN = 13, 48
REDELIVERY_OFFSET = 1_000_000_000
INGEST_LAG_US = 1_000_000
REDELIVERY_LAG_US = 61_000_000
BAD_TIMESTAMP_TEXT = "not-a-time"
TRUNCATE_TO = 10
# Defects: the defect applies to every event whose id is divisible by n.
DIRT_EVERY = {
    "null_prices": 41,
    "null_qty": 43,
    "negative_qty": 47,
    "crossed": 53,
    "bad_timestamp": 59,
    "redelivered": 61,
    "truncated": 67,
    "null_symbol": 71,
    "null_trade_id": 73,
    "negative_prices": 79,
}
# ------------------------------------------------------------ end fixed values

DAY_US = 86_400_000_000
SESSION_OPEN_US = int(SESSION_OPEN.timestamp()) * 1_000_000


def _every(name: str, dirt: bool) -> Column:
    if not dirt:
        return F.lit(False)
    return (F.col("id") % DIRT_EVERY[name]) == 0


def _array_pick(values: list[str], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index]


def build_feed(events: DataFrame, dirt: bool = True) -> DataFrame:
    """``events`` -> bronze rows (raw_value, kafka_topic, kafka_partition,
    kafka_offset, kafka_ts, ingested_at, ingest_date).

    Built as a few stacked projections, each naming its intermediate
    columns, so no large expression is repeated in the plan. Needs the
    session zone pinned to UTC (see ``tickline.session``).
    """
    base = events.select(
        F.col("event_id").alias("id"),
        F.col("user_id"),
        F.col("event_type").isin(*TRADE_EVENT_TYPES).alias("is_trade"),
        F.col("value"),
        F.from_json("props", "k BIGINT")["k"].alias("k"),
        (F.unix_micros(F.col("ts").cast("timestamp")) % F.lit(DAY_US)).alias("sod"),
        F.dayofmonth("ts").alias("dom"),
    )
    s = F.col("user_id") % 10
    flags = [_every(name, dirt).alias(f"d_{name}") for name in DIRT_EVERY]
    step1 = base.select(
        "id",
        "user_id",
        "is_trade",
        "value",
        "k",
        (F.lit(10_000) + F.lit(1_000) * s + F.expr("(k * (user_id % 10 + 1)) div 10")).alias(
            "cents"
        ),
        (F.lit(1) + F.col("id") % 5).alias("h"),
        (
            F.lit(SESSION_OPEN_US)
            + (F.col("dom") % 2) * F.lit(DAY_US)
            + F.expr(f"(sod * {FOLD_NUM}) div {FOLD_DEN}")
        ).alias("true_us"),
        *flags,
    )
    d = {name: F.col(f"d_{name}") for name in DIRT_EVERY}
    cents, h = F.col("cents"), F.col("h")
    low, high, mark = (cents - h) / 100, (cents + h) / 100, cents / 100
    qty0 = (F.lit(1) + F.floor("value")).cast("int")
    iso_ts = F.date_format(F.timestamp_micros("true_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    step2 = step1.select(
        "id",
        "user_id",
        "is_trade",
        "k",
        "true_us",
        d["redelivered"].alias("redelivered"),
        d["truncated"].alias("truncated"),
        _array_pick(SYMBOLS, F.col("user_id") % 10).alias("symbol"),
        _array_pick(VENUES, F.col("id") % 4).alias("venue"),
        F.when(d["bad_timestamp"], F.lit(BAD_TIMESTAMP_TEXT)).otherwise(iso_ts).alias("event_ts"),
        F.when(d["null_prices"], F.lit(None))
        .when(d["negative_prices"], -low)
        .when(d["crossed"], high)
        .otherwise(low)
        .alias("bid"),
        F.when(d["null_prices"], F.lit(None))
        .when(d["negative_prices"], -high)
        .when(d["crossed"], low)
        .otherwise(high)
        .alias("ask"),
        F.when(d["null_prices"], F.lit(None)).otherwise(mark).alias("last"),
        F.when(d["null_prices"], F.lit(None))
        .when(d["negative_prices"], -mark)
        .otherwise(mark)
        .alias("price"),
        F.when(d["null_qty"], F.lit(None))
        .when(d["negative_qty"], -qty0)
        .otherwise(qty0)
        .alias("qty"),
        d["null_symbol"].alias("null_symbol"),
        d["null_trade_id"].alias("null_trade_id"),
    )
    tick = F.struct(
        F.lit("tick").alias("event_type"),
        F.when(F.col("null_symbol"), F.lit(None)).otherwise(F.col("symbol")).alias("symbol"),
        "venue",
        F.col("id").alias("seq"),
        "event_ts",
        "bid",
        "ask",
        (F.lit(1) + F.col("k")).cast("int").alias("bid_size"),
        (F.lit(100) - F.col("k")).cast("int").alias("ask_size"),
        "last",
    )
    trade = F.struct(
        F.lit("trade").alias("event_type"),
        F.when(F.col("null_trade_id"), F.lit(None))
        .otherwise(F.concat(F.lit("T"), F.col("id").cast("string")))
        .alias("trade_id"),
        "symbol",
        "venue",
        "event_ts",
        "price",
        "qty",
        F.when(F.col("id") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        F.when(F.col("id") % 3 == 0, "LIMIT").otherwise("MARKET").alias("order_type"),
        F.format_string("T%04d", F.col("user_id")).alias("trader_id"),
    )
    step3 = step2.select(
        "id",
        "user_id",
        "is_trade",
        "true_us",
        "redelivered",
        "truncated",
        F.when(F.col("is_trade"), F.to_json(trade)).otherwise(F.to_json(tick)).alias("payload"),
    )
    rows = step3.select(
        F.when(F.col("truncated"), F.substring("payload", 1, TRUNCATE_TO))
        .otherwise(F.col("payload"))
        .alias("raw_value"),
        F.when(F.col("is_trade"), F.lit(TOPIC_TRADES)).otherwise(F.lit(TOPIC_TICKS)).alias(
            "kafka_topic"
        ),
        (s % KAFKA_PARTITIONS).cast("int").alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        (F.col("true_us") + F.lit(INGEST_LAG_US)).alias("_ingest_us"),
        "redelivered",
    )
    copies = rows.where("redelivered").select(
        "raw_value",
        "kafka_topic",
        "kafka_partition",
        (F.col("kafka_offset") + F.lit(REDELIVERY_OFFSET)).alias("kafka_offset"),
        (F.col("_ingest_us") - F.lit(INGEST_LAG_US) + F.lit(REDELIVERY_LAG_US)).alias(
            "_ingest_us"
        ),
    )
    landed = rows.drop("redelivered").unionByName(copies)
    ingested_at = F.timestamp_micros("_ingest_us")
    return landed.select(
        "raw_value",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        ingested_at.alias("kafka_ts"),
        ingested_at.alias("ingested_at"),
        F.to_date(ingested_at).alias("ingest_date"),
    )


def as_kafka_records(bronze: DataFrame) -> DataFrame:
    """Bronze rows back into the shape a Kafka source delivers
    (key, value, topic, partition, offset, timestamp); key is the symbol."""
    symbol = F.get_json_object("raw_value", "$.symbol")
    return bronze.select(
        symbol.alias("key"),
        F.col("raw_value").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_ts").alias("timestamp"),
    )
