"""Mart tests as contracts: unique / not_null / accepted_values / ranges /
key combinations, plus the referential check from facts to the dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.quality.contracts import Contract
from tickline.sources.seed import SECTORS

# ---------------------------------------------------------------- fixed values
MART_CONTRACTS = {
    "dim_symbol": {
        "dataset": "marts/dim_symbol",
        "columns": [
            {"name": "symbol", "not_null": True, "unique": True},
            {"name": "sector", "not_null": True, "accepted_values": SECTORS},
        ],
    },
    "daily_performance": {
        "dataset": "marts/fct_daily_symbol_performance",
        "columns": [
            {"name": "symbol", "not_null": True},
            {"name": "trade_date", "not_null": True},
            {"name": "day_close", "not_null": True, "min_value": 0, "inclusive": False},
            {"name": "vol_bucket", "accepted_values": ["LOW", "MEDIUM", "HIGH"]},
        ],
        "checks": {"unique_key": ["symbol", "trade_date"]},
    },
    "intraday_liquidity": {
        "dataset": "marts/fct_intraday_liquidity",
        "columns": [{"name": "bucket_volume", "min_value": 0}],
    },
}
# Source freshness on the bars' minute: warn after 2 hours, error after 24.
SOURCE_FRESHNESS = {"column": "minute", "warn_after_minutes": 120, "error_after_minutes": 1440}
# ------------------------------------------------------------ end fixed values


def mart_contract(name: str) -> Contract:
    return Contract.from_dict(MART_CONTRACTS[name])


def relationships(facts: DataFrame, dim: DataFrame, column: str = "symbol", dataset: str = "") -> DataFrame:
    """Fact rows whose ``column`` has no match in the dimension (NULLs are not
    checked). A left-anti join: the dimension is the build side."""
    keys = dim.select(column).distinct()
    return facts.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
