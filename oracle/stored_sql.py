"""Oracle SQL of the queries over named tables."""

from __future__ import annotations

from oracle.duckdb_sql import _results, sql
from tickline.plans.stored import BROKEN_EVERY, FIRST_RUN, MISSING_SECTOR, SECOND_RUN
from tickline.quality.contracts import load_builtin
from tickline.sources.feed import DIRT_EVERY, REDELIVERY_OFFSET

_BAD = f"date_part('minute', minute) % {BROKEN_EVERY} = 0"
BROKEN = (
    f"(SELECT * REPLACE (CASE WHEN {_BAD} THEN low ELSE high END AS high, CASE WHEN {_BAD} THEN high ELSE low END AS low, "
    f"CASE WHEN NOT {_BAD} THEN open END AS open) FROM bars)"
)


def _stamp(t) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _run(run_id: str, at, *parts: str) -> str:
    union = " UNION ALL ".join(parts)
    return f"SELECT '{run_id}' AS run_id, dataset, check_name, severity, passed, observed, threshold, {_stamp(at)} AS checked_at FROM ({union})"


def _audit() -> str:
    first = _run(
        "run-1",
        FIRST_RUN,
        _results("silver_ticks", load_builtin("silver_ticks")),
        _results("silver_trades", load_builtin("silver_trades")),
        _results("bars", load_builtin("gold_ohlcv_1m")),
    )
    return f"{first} UNION ALL {_run('run-2', SECOND_RUN, _results(BROKEN, load_builtin('gold_ohlcv_1m')))}"


def stored_sql() -> dict[str, str]:
    return {
        "incremental_rejected": sql(
            "SELECT event_type, symbol, venue, seq, event_ts_parsed AS event_ts, bid, ask, bid_size, ask_size, last, kafka_offset, "
            f"CASE WHEN kafka_offset >= {REDELIVERY_OFFSET} THEN ingested_at + INTERVAL 2 DAY ELSE ingested_at END AS ingested_at, "
            "(bid + ask) / 2 AS mid, (ask - bid) / ((bid + ask) / 2) * 10000 AS spread_bps, CAST(event_ts_parsed AS DATE) AS trade_date "
            f"FROM ticks_tagged WHERE quarantine_reason IS NULL AND NOT (kafka_offset < {REDELIVERY_OFFSET} AND kafka_offset % {DIRT_EVERY['redelivered']} = 0) "
            "QUALIFY row_number() OVER (PARTITION BY symbol, venue, seq ORDER BY kafka_offset) = 1"
        ),
        "catalog_marts": sql(
            "SELECT b.symbol, b.trade_date, p.sector, p.liquidity_rank, p.vol_bucket, count(*) AS bars, "
            "CAST(sum(b.volume) AS BIGINT) AS bar_volume, any_value(p.total_volume) AS total_volume, "
            "count(*) FILTER (WHERE b.high = p.day_high) AS minutes_at_high, count(*) FILTER (WHERE b.low = p.day_low) AS minutes_at_low, "
            "count(*) FILTER (WHERE b.close > p.day_open) AS minutes_above_open "
            "FROM stg_bars b JOIN daily_performance p ON b.symbol = p.symbol AND b.trade_date = p.trade_date GROUP BY ALL"
        ),
        "gated_publish": sql(
            "SELECT trade_date, count(*) AS bars, count(open) AS with_open, CAST(sum(volume) AS BIGINT) AS volume, "
            f"(SELECT count(*) FROM ({_results(BROKEN, load_builtin('gold_ohlcv_1m'))}) WHERE NOT passed) AS failed_checks "
            "FROM bars GROUP BY trade_date"
        ),
        "dq_audit_latest": sql(f"SELECT * FROM ({_audit()}) ORDER BY checked_at DESC, dataset, check_name LIMIT 50"),
        "dq_audit_runs": sql(
            "SELECT run_id, max(checked_at) AS checked_at, count(*) FILTER (WHERE passed) AS passed_checks, count(*) AS total_checks, "
            f"ROUND(count(*) FILTER (WHERE passed) / count(*), 9) + 0.0 AS pass_rate FROM ({_audit()}) GROUP BY run_id"
        ),
        "ohlc_violations_found": sql(
            f"SELECT symbol, minute, high, low, close, trade_date FROM {BROKEN} "
            "WHERE low > high OR open > high OR open < low OR close > high OR close < low"
        ),
        "dq_relationships_found": sql(
            "SELECT symbol, trade_date, sector, total_volume, liquidity_rank FROM daily_performance "
            f"WHERE symbol IS NOT NULL AND symbol NOT IN (SELECT symbol FROM dim_symbol WHERE sector <> '{MISSING_SECTOR}')"
        ),
    }
