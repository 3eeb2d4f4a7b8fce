"""Validity rules and the first-true-rule reason column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def tick_rules() -> list[Rule]:
    """Quote rules, in the order they are tried.

    ``nan_price`` is an addition: a JSON ``NaN`` parses to a double NaN,
    which is neither NULL nor <= 0 and would otherwise reach silver.
    """
    bid, ask = F.col("bid"), F.col("ask")
    return [
        ("null_symbol", F.col("symbol").isNull()),
        ("null_prices", bid.isNull() | ask.isNull()),
        ("nan_price", F.isnan(bid) | F.isnan(ask)),
        ("non_positive_price", (bid <= 0) | (ask <= 0)),
        ("crossed_quote", ask < bid),
        ("bad_timestamp", F.col("event_ts_parsed").isNull()),
    ]


def trade_rules() -> list[Rule]:
    """Trade rules, in the order they are tried."""
    price, qty = F.col("price"), F.col("qty")
    return [
        ("null_trade_id", F.col("trade_id").isNull()),
        ("null_price", price.isNull()),
        ("nan_price", F.isnan(price)),
        ("non_positive_price", price <= 0),
        ("null_qty", qty.isNull()),
        ("non_positive_qty", qty <= 0),
        ("bad_timestamp", F.col("event_ts_parsed").isNull()),
    ]


def first_true_reason(rules: list[Rule]) -> Column:
    """Name of the first rule that is TRUE; NULL when none is.

    A rule that evaluates to NULL does not fire. ``coalesce`` of one
    ``when`` per rule keeps the expression linear in the number of rules.
    """
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(pred, F.lit(name)) for name, pred in rules])
