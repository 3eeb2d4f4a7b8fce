"""Oracle SQL of the streaming queries."""

from __future__ import annotations

from oracle.duckdb_sql import _select, sql

STATUS = """
clean AS (
  SELECT event_type, symbol, kafka_offset, ingested_at, event_ts_parsed, symbol || venue || seq AS business_key FROM ticks_tagged WHERE quarantine_reason IS NULL
  UNION ALL
  SELECT event_type, symbol, kafka_offset, ingested_at, event_ts_parsed, trade_id FROM trades_tagged WHERE quarantine_reason IS NULL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, business_key ORDER BY kafka_offset) AS place,
         max(event_ts_parsed) OVER (PARTITION BY event_type, symbol ORDER BY kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
  FROM clean
),
judged AS (
  SELECT kafka_offset, CASE WHEN place > 1 THEN 'duplicate' WHEN event_ts_parsed < mark - INTERVAL 10 MINUTE THEN 'late' ELSE 'on_time' END AS status, mark FROM placed
)
"""


def streams_sql() -> dict[str, str]:
    return {
        "stream_late": sql("SELECT 1").rsplit("SELECT 1", 1)[0].rstrip()
        + f", {STATUS} SELECT b.kafka_topic, b.kafka_partition, b.kafka_offset, coalesce(j.status, 'quarantined') AS status, "
        "CASE WHEN j.status = 'late' THEN j.mark END AS high_water_ts FROM bronze b LEFT JOIN judged j USING (kafka_offset)",
        "stream_bars_join": sql(_select("bars")),
        "bars_corrected": sql(_select("bars")),
    }
