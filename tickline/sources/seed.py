"""Symbol reference seed: name, sector, design price and volatility per symbol."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

from tickline.schemas import SEED_SCHEMA

# ---------------------------------------------------------------- fixed values
# symbol,company_name,sector,base_price,annualised_vol
SYMBOL_REFERENCE_CSV = """\
symbol,company_name,sector,base_price,annualised_vol
AAPL,Apple Inc.,Technology,232.0,0.25
MSFT,Microsoft Corp.,Technology,451.0,0.22
NVDA,NVIDIA Corp.,Technology,138.0,0.45
AMZN,Amazon.com Inc.,Consumer,215.0,0.30
GOOG,Alphabet Inc.,Technology,196.0,0.26
META,Meta Platforms,Technology,605.0,0.32
TSLA,Tesla Inc.,Automotive,342.0,0.55
GS,Goldman Sachs Group,Financials,612.0,0.28
JPM,JPMorgan Chase & Co.,Financials,265.0,0.24
MS,Morgan Stanley,Financials,138.0,0.27
"""
SECTORS = ["Technology", "Financials", "Consumer", "Automotive"]
# ------------------------------------------------------------ end fixed values


def read_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed with declared column types (never inferred).

    With ``path``, a CSV with a header is read by Spark (any shared file
    system). Without, the built-in ten-row seed becomes a local relation:
    its size is known to the planner, so joins against it broadcast it.
    """
    if path:
        return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)
    rows = list(csv.DictReader(io.StringIO(SYMBOL_REFERENCE_CSV)))
    typed = [
        (r["symbol"], r["company_name"], r["sector"], float(r["base_price"]), float(r["annualised_vol"]))
        for r in rows
    ]
    return spark.createDataFrame(typed, SEED_SCHEMA)
