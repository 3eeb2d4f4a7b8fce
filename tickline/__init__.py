"""tickline: a Spark-native market-data medallion engine.

Raw quote and trade messages land untouched in bronze; silver parses,
validates, quarantines and de-duplicates them; gold builds one-minute
OHLCV/VWAP bars and daily per-symbol risk; marts add dimensions, ranks
and 30-minute liquidity buckets; data contracts gate every layer.

Every transform is a pure ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so Catalyst plans it and Tungsten runs it.
"""

__version__ = "0.1.0"
