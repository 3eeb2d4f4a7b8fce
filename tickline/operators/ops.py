"""Operations views: quarantine triage, the quarantine-rate gate, stage counts,
conservation and late events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.operators.silver import TICK_KEY, TRADE_KEY, SilverOutputs

# ---------------------------------------------------------------- fixed values
QUARANTINE_RATE_GATE = 0.05
LATE_AFTER = "10 minutes"
# ------------------------------------------------------------ end fixed values


class QuarantineRateExceeded(ValueError):
    """The share of quarantined rows is above the gate."""


def quarantine_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per (table, reason) over every quarantine table.

    Each table is aggregated on its own (partial + final) and the small
    results are unioned, so no quarantine row crosses the network twice.
    """
    parts = [
        df.groupBy("quarantine_reason")
        .count()
        .select(F.lit(name).alias("table_name"), "quarantine_reason", F.col("count").alias("rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def quarantine_rate(clean: list[DataFrame], dirty: list[DataFrame]) -> DataFrame:
    """One row: clean, dirty, rate = dirty / max(clean + dirty, 1), gate flag."""

    def total(frames: list[DataFrame], name: str) -> DataFrame:
        counts = [f.agg(F.count(F.lit(1)).alias("n")) for f in frames]
        return reduce(DataFrame.unionByName, counts).agg(F.sum("n").alias(name))

    # Two one-row aggregates side by side: collect them as named columns of
    # one union, then pivot with max(), avoiding any join.
    both = total(clean, "n").select(F.lit("clean").alias("k"), "n").unionByName(
        total(dirty, "n").select(F.lit("dirty").alias("k"), "n")
    )
    row = both.agg(
        F.max(F.when(F.col("k") == "clean", F.col("n"))).cast("bigint").alias("clean_rows"),
        F.max(F.when(F.col("k") == "dirty", F.col("n"))).cast("bigint").alias("quarantined_rows"),
    )
    rate = F.col("quarantined_rows") / F.greatest(F.col("clean_rows") + F.col("quarantined_rows"), F.lit(1))
    return row.withColumn("quarantine_rate", rate).withColumn(
        "gate_breached", F.col("quarantine_rate") > QUARANTINE_RATE_GATE
    )


def enforce_quarantine_rate(rate_row) -> None:
    """Raise when the gate is breached (``rate_row`` is the collected single row)."""
    if rate_row["gate_breached"]:
        raise QuarantineRateExceeded(
            f"Quarantine rate {rate_row['quarantine_rate']:.1%} exceeds "
            f"{QUARANTINE_RATE_GATE:.0%}: investigate the upstream feed"
        )


def stage_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named frame, as one DataFrame (one job)."""
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("stage"), "rows") for n, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def _keys(tagged: DataFrame, kind: str, key: list[str]) -> DataFrame:
    """The distinct business keys among the clean rows of a kind."""
    return tagged.where((F.col("event_type") == kind) & F.col("quarantine_reason").isNull()).select(*key).distinct()


def conservation(bronze: DataFrame, silver: SilverOutputs) -> DataFrame:
    """Every bronze row accounted for, exactly.

    bronze = unparsed + Σ over kinds (clean + duplicates + quarantined), where
    clean counts rows that pass every rule before de-duplication. One pass
    over the tagged parse gives the per-kind splits. Duplicates are counted
    without silver, as clean rows less distinct keys; ``balanced`` also asks
    that silver holds one row for each of those keys.
    """
    tagged = silver.tagged
    split = tagged.agg(
        F.count(F.lit(1)).alias("parsed_rows"),
        F.count_if(F.col("event_type") == "tick").alias("tick_rows"),
        F.count_if(F.col("event_type") == "trade").alias("trade_rows"),
        F.count_if((F.col("event_type") == "tick") & F.col("quarantine_reason").isNull()).alias("tick_clean"),
        F.count_if((F.col("event_type") == "trade") & F.col("quarantine_reason").isNull()).alias("trade_clean"),
    )
    counts = stage_counts(
        {
            "bronze": bronze,
            "tick_keys": _keys(tagged, "tick", TICK_KEY),
            "trade_keys": _keys(tagged, "trade", TRADE_KEY),
            "silver_ticks": silver.ticks,
            "silver_trades": silver.trades,
            "quarantine_ticks": silver.quarantine_ticks,
            "quarantine_trades": silver.quarantine_trades,
            "quarantine_unparsed": silver.quarantine_unparsed,
        }
    )
    wide = counts.agg(
        *[
            F.max(F.when(F.col("stage") == s, F.col("rows"))).alias(s)
            for s in (
                "bronze",
                "tick_keys",
                "trade_keys",
                "silver_ticks",
                "silver_trades",
                "quarantine_ticks",
                "quarantine_trades",
                "quarantine_unparsed",
            )
        ]
    )
    # Both sides are single rows: stack them and collapse with max() per column.
    cols = ["parsed_rows", "tick_clean", "trade_clean"]
    stacked = split.select(*cols, *[F.lit(None).cast("bigint").alias(c) for c in wide.columns]).unionByName(
        wide.select(*[F.lit(None).cast("bigint").alias(c) for c in cols], *wide.columns)
    )
    one = stacked.agg(*[F.max(c).alias(c) for c in cols + wide.columns])
    out = one.select(
        "bronze",
        "quarantine_unparsed",
        F.col("tick_clean").alias("ticks_clean"),
        (F.col("tick_clean") - F.col("tick_keys")).alias("ticks_duplicates"),
        F.col("quarantine_ticks").alias("ticks_quarantined"),
        F.col("trade_clean").alias("trades_clean"),
        (F.col("trade_clean") - F.col("trade_keys")).alias("trades_duplicates"),
        F.col("quarantine_trades").alias("trades_quarantined"),
        ((F.col("silver_ticks") == F.col("tick_keys")) & (F.col("silver_trades") == F.col("trade_keys"))).alias("_survive"),
    )
    accounted = (
        F.col("quarantine_unparsed")
        + F.col("ticks_clean")
        + F.col("ticks_quarantined")
        + F.col("trades_clean")
        + F.col("trades_quarantined")
    )
    balanced = (F.col("accounted") == F.col("bronze")) & F.col("_survive")
    return out.withColumn("accounted", accounted).withColumn("balanced", balanced).drop("_survive")


def late_events(
    parsed: DataFrame, allowed: str = LATE_AFTER, chunk: int = 1 << 20, carried_in: DataFrame | None = None
) -> DataFrame:
    """Events that arrive later than ``allowed`` behind what their symbol had
    already shown: event_ts < max(event_ts of earlier offsets, same symbol) - allowed.

    The running maximum is a prefix scan over offsets. To keep a hot symbol
    from landing in one task, offsets are cut into chunks of ``chunk``:
    (1) the maximum per (symbol, chunk) is aggregated, (2) a prefix maximum
    runs over those per-chunk values (one row per chunk, small), (3) each
    chunk scans its own rows and starts from the prefix of the chunks before
    it. No task ever holds more than one chunk of one symbol.

    ``carried_in`` (symbol, high_water_ts) is the high-water mark left by
    earlier input (a previous micro-batch); it is one row per symbol.
    """
    rows = parsed.where(F.col("event_ts").isNotNull() & F.col("symbol").isNotNull()).withColumn(
        "_chunk", F.floor(F.col("kafka_offset") / F.lit(chunk))
    )
    per_chunk = rows.groupBy("symbol", "_chunk").agg(F.max("event_ts").alias("_chunk_max"))
    before = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select("symbol", "_chunk", F.max("_chunk_max").over(before).alias("_carry"))
    inside = (
        Window.partitionBy("symbol", "_chunk")
        .orderBy("kafka_offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    scanned = rows.withColumn("_seen", F.max("event_ts").over(inside)).join(carried, ["symbol", "_chunk"], "left")
    parts = [F.col("_seen"), F.col("_carry")]
    if carried_in is not None:
        scanned = scanned.join(carried_in.select("symbol", F.col("high_water_ts").alias("_before")), "symbol", "left")
        parts.append(F.col("_before"))
    high_water = F.greatest(*parts)
    lateness = F.col("event_ts") < high_water - F.expr(f"INTERVAL {allowed}")
    return scanned.where(lateness).withColumn("high_water_ts", high_water).drop("_chunk", "_seen", "_carry", "_before")
