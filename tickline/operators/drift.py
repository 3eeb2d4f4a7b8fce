"""Drift of payloads: fields that messages carry against the fields they should.

Payloads are read as VARIANT, so nothing about their shape is assumed: every
field of every message is listed with the kind of value it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tickline.schemas import TICK_SCHEMA, TRADE_SCHEMA

SCHEMAS = {"tick": TICK_SCHEMA, "trade": TRADE_SCHEMA}


def as_variant(bronze: DataFrame) -> DataFrame:
    """Bronze with ``payload`` (VARIANT, NULL where it isn't JSON) and its ``event_type``."""
    parsed = bronze.withColumn("payload", F.try_parse_json("raw_value"))
    return parsed.withColumn("event_type", F.try_variant_get("payload", "$.event_type", "string"))


def value_kind(value: Column) -> Column:
    """``integer``, ``decimal``, ``string``, ``boolean``, ``null``, ``array`` or ``object``."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "BIGINT", "integer")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "decimal")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", "null")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("object")
    )


def _allowed(schema: StructType) -> dict[str, list[str]]:
    def kinds(t) -> list[str]:
        return ["string"] if isinstance(t, StringType) else ["integer", "decimal"] if isinstance(t, DoubleType) else ["integer"]

    return {f.name: kinds(f.dataType) for f in schema.fields}


def expected_fields(spark: SparkSession) -> DataFrame:
    """``event_type, field, allowed``: one row for each field of the wire schemas."""
    rows = [(kind, name, allowed) for kind, schema in SCHEMAS.items() for name, allowed in _allowed(schema).items()]
    return spark.createDataFrame(rows, "event_type string, field string, allowed array<string>")


def payload_drift(bronze: DataFrame) -> DataFrame:
    """Departures by kind and date: ``event_type, ingest_date, field, observed, drift, rows``.

    ``drift`` is ``unknown`` (a field the schema lacks), ``type`` (a value of
    another kind) or ``missing`` (messages without a field of the schema).
    Fields are counted by (kind, date, field, value kind) before they meet the
    schema's few rows. Messages of unknown kind, or that aren't JSON, go to the
    unparsed quarantine and aren't listed here.
    """
    spark = bronze.sparkSession
    rows = as_variant(bronze).where(F.col("event_type").isin(*SCHEMAS)).select("event_type", "ingest_date", "payload")
    each = rows.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer()))
    seen = each.groupBy("event_type", "ingest_date", F.col("key").alias("field"), value_kind(F.col("value")).alias("observed")).agg(F.count(F.lit(1)).alias("rows"))
    fields = expected_fields(spark)
    judged = seen.join(fields, ["event_type", "field"], "left")
    drift = F.when(F.col("allowed").isNull(), "unknown").when(~F.array_contains("allowed", F.col("observed")), "type")
    present = judged.withColumn("drift", drift).where("drift IS NOT NULL").select("event_type", "ingest_date", "field", "observed", "drift", "rows")
    totals = rows.groupBy("event_type", "ingest_date").agg(F.count(F.lit(1)).alias("n"))
    held = seen.groupBy("event_type", "ingest_date", "field").agg(F.sum("rows").alias("held"))
    wanted = totals.join(fields.select("event_type", "field"), "event_type").join(held, ["event_type", "ingest_date", "field"], "left")
    missing = wanted.withColumn("rows", F.col("n") - F.coalesce("held", F.lit(0))).where("rows > 0")
    return present.unionByName(missing.select("event_type", "ingest_date", "field", F.lit("").alias("observed"), F.lit("missing").alias("drift"), "rows"))
