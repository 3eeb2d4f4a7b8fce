"""Explicit schemas. Nothing is inferred: a bad batch must not change a type."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    BooleanType,
)

# Wire payload of a quote ("tick") message, in field order.
TICK_SCHEMA = StructType(
    [
        StructField("event_type", StringType()),
        StructField("symbol", StringType()),
        StructField("venue", StringType()),
        StructField("seq", LongType()),
        StructField("event_ts", StringType()),
        StructField("bid", DoubleType()),
        StructField("ask", DoubleType()),
        StructField("bid_size", IntegerType()),
        StructField("ask_size", IntegerType()),
        StructField("last", DoubleType()),
    ]
)

# Wire payload of a trade message, in field order.
TRADE_SCHEMA = StructType(
    [
        StructField("event_type", StringType()),
        StructField("trade_id", StringType()),
        StructField("symbol", StringType()),
        StructField("venue", StringType()),
        StructField("event_ts", StringType()),
        StructField("price", DoubleType()),
        StructField("qty", IntegerType()),
        StructField("side", StringType()),
        StructField("order_type", StringType()),
        StructField("trader_id", StringType()),
    ]
)


def _superset(*schemas: StructType) -> StructType:
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            fields.setdefault(field.name, field)
    return StructType(list(fields.values()))


# One schema covering both message kinds, so bronze is parsed once per run.
PAYLOAD_SCHEMA = _superset(TICK_SCHEMA, TRADE_SCHEMA)

TICK_COLUMNS = [f.name for f in TICK_SCHEMA.fields]
TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]

BRONZE_SCHEMA = StructType(
    [
        StructField("raw_value", StringType()),
        StructField("kafka_topic", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("kafka_ts", TimestampType()),
        StructField("ingested_at", TimestampType()),
        StructField("ingest_date", DateType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# Shape of a Kafka source row (and of its offline file stand-in).
KAFKA_SCHEMA = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

DQ_RESULT_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("dataset", StringType()),
        StructField("check_name", StringType()),
        StructField("severity", StringType()),
        StructField("passed", BooleanType()),
        StructField("observed", StringType()),
        StructField("threshold", StringType()),
        StructField("checked_at", TimestampType()),
    ]
)

SEED_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("company_name", StringType()),
        StructField("sector", StringType()),
        StructField("base_price", DoubleType()),
        StructField("annualised_vol", DoubleType()),
    ]
)
