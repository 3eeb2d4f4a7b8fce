"""Property test: the reason column equals the first rule that is TRUE, with
SQL three-valued logic (a NULL comparison never fires)."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tickline.functions.rules import first_true_reason, tick_rules, trade_rules

PRICES = st.sampled_from([None, -1.5, 0.0, 0.5, 100.0, 100.2, float("nan")])
TS = st.sampled_from([None, dt.datetime(2024, 1, 2, 14, 0)])


def expected_tick(symbol, bid, ask, ts):
    def le0(x):
        return None if x is None else (x <= 0)

    def either(a, b):  # SQL OR
        if a is True or b is True:
            return True
        if a is None or b is None:
            return None
        return False

    checks = [
        ("null_symbol", symbol is None),
        ("null_prices", bid is None or ask is None),
        ("nan_price", either(None if bid is None else math.isnan(bid), None if ask is None else math.isnan(ask))),
        ("non_positive_price", either(le0(bid), le0(ask))),
        ("crossed_quote", None if bid is None or ask is None else ask < bid),
        ("bad_timestamp", ts is None),
    ]
    for name, value in checks:
        if value is True:
            return name
    return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "GS"]), PRICES, PRICES, TS), min_size=30, max_size=60))
def test_tick_reason_is_first_true_rule(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, bid double, ask double, event_ts_parsed timestamp")
    got = [r["r"] for r in df.select(first_true_reason(tick_rules()).alias("r")).collect()]
    assert got == [expected_tick(*row) for row in rows]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "T1"]), PRICES, st.sampled_from([None, -2, 0, 1, 7]), TS), min_size=30, max_size=60))
def test_trade_reason_is_first_true_rule(spark, rows):
    df = spark.createDataFrame(rows, "trade_id string, price double, qty int, event_ts_parsed timestamp")
    got = [r["r"] for r in df.select(first_true_reason(trade_rules()).alias("r")).collect()]
    want = []
    for tid, price, qty, ts in rows:
        if tid is None:
            want.append("null_trade_id")
        elif price is None:
            want.append("null_price")
        elif math.isnan(price):
            want.append("nan_price")
        elif price <= 0:
            want.append("non_positive_price")
        elif qty is None:
            want.append("null_qty")
        elif qty <= 0:
            want.append("non_positive_qty")
        elif ts is None:
            want.append("bad_timestamp")
        else:
            want.append(None)
    assert got == want
