"""Oracle SQL of the queries over stored states."""

from __future__ import annotations

from oracle.duckdb_sql import sql
from tickline.operators.drift import SCHEMAS, _allowed
from tickline.plans.periods import FEE_EVERY, LIST_EVERY, TEXT_EVERY

_FIELDS = ", ".join(f"('{kind}', '{name}', {allowed!r})" for kind, schema in SCHEMAS.items() for name, allowed in _allowed(schema).items())

DRIFT = f"""
, changed AS (
  SELECT ingest_date, CASE
    WHEN starts_with(raw_value, '{{"event_type":"trade"') AND kafka_offset % {FEE_EVERY} = 0
      THEN regexp_replace(raw_value, '^\\{{"event_type":"trade"', '{{"event_type":"trade","fee":0.5')
    WHEN NOT starts_with(raw_value, '{{"event_type":"trade"') AND kafka_offset % {TEXT_EVERY} = 0
      THEN regexp_replace(raw_value, '"bid":([0-9.-]+)', '"bid":"\\1"')
    WHEN starts_with(raw_value, '{{"event_type":"trade"') AND kafka_offset % {LIST_EVERY} = 0
      THEN regexp_replace(raw_value, '"venue":"([A-Z]+)"', '"venue":["\\1"]')
    ELSE raw_value END AS j FROM bronze
), good AS (
  SELECT json_extract_string(j, '$.event_type') AS event_type, ingest_date, j FROM (SELECT * FROM changed WHERE json_valid(j))
), each AS (
  SELECT event_type, ingest_date, field, CASE json_type(j, '$.' || field)
           WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'decimal' WHEN 'VARCHAR' THEN 'string'
           WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' ELSE 'object' END AS observed
  FROM (SELECT event_type, ingest_date, j, unnest(json_keys(j)) AS field FROM good)
), seen AS (
  SELECT event_type, ingest_date, field, observed, count(*) AS rows FROM each GROUP BY ALL
), fields AS (
  SELECT * FROM (VALUES {_FIELDS}) t(event_type, field, allowed)
), totals AS (
  SELECT event_type, ingest_date, count(*) AS n FROM good GROUP BY ALL
)
SELECT s.event_type, s.ingest_date, s.field, observed, CASE WHEN allowed IS NULL THEN 'unknown' ELSE 'type' END AS drift, rows
FROM seen s LEFT JOIN fields f ON s.event_type = f.event_type AND s.field = f.field
WHERE allowed IS NULL OR NOT list_contains(allowed, observed)
UNION ALL
SELECT t.event_type, t.ingest_date, f.field, '', 'missing', n - coalesce(h.held, 0)
FROM totals t JOIN fields f ON t.event_type = f.event_type
LEFT JOIN (SELECT event_type, ingest_date, field, CAST(sum(rows) AS BIGINT) AS held FROM seen GROUP BY ALL) h
  ON h.event_type = t.event_type AND h.ingest_date = t.ingest_date AND h.field = f.field
WHERE n - coalesce(h.held, 0) > 0
"""


def periods_sql() -> dict[str, str]:
    return {
        "var_period": sql(
            "SELECT symbol, CAST(date_trunc('week', trade_date) AS DATE) AS period_start, count(*) AS n_returns, true AS within_bound "
            "FROM minute_returns WHERE log_ret IS NOT NULL GROUP BY ALL"
        ),
        "drawdown_period": sql(
            "SELECT symbol, period_start, count(DISTINCT trade_date) AS days, max(close) AS peak, ROUND(min(close / top - 1), 12) + 0.0 AS max_drawdown "
            "FROM (SELECT symbol, trade_date, CAST(date_trunc('month', trade_date) AS DATE) AS period_start, close, "
            "max(close) OVER (PARTITION BY symbol, date_trunc('month', trade_date) ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top "
            "FROM bars) GROUP BY symbol, period_start"
        ),
        "traders_seen": sql(
            "SELECT trade_date, count(DISTINCT trader_id) AS exact_traders, true AS within_bound, true AS returning_fits FROM silver_trades GROUP BY trade_date"
        ),
        "payload_drift": sql("SELECT 1").rsplit("SELECT 1", 1)[0].rstrip() + DRIFT,
        "stored_freshness": sql(
            "SELECT count(*) AS rows, max(minute) AS max_loaded, ROUND((epoch_us((SELECT t FROM as_of)) - epoch_us(max(minute))) / 6e7, 6) + 0.0 AS age_minutes FROM bars"
        ),
    }
