"""Named tables and views: what a consumer reads by name.

Four databases under one shared folder: ``reference`` (the seed), ``serving``
(bars and daily risk), ``staging`` (views over serving) and ``marts`` (tables).
Serving tables are bucketed by (symbol, trade_date) and sorted by minute, so a
join of bars and risk needs no exchange, and a hot symbol is spread over its
dates. A table gets one file a bucket: rows are dealt by the bucket columns
before the write.

Publishing is write, audit, switch. A new version is a table of its own; its
contract runs on the stored rows and leaves its results in ``audit.dq_results``;
only when it holds does the view that readers use move to the new version. A
reader therefore sees the old version until then, and still after a failure.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators import marts
from tickline.quality.checks import enforce, run_contract
from tickline.quality.contracts import Contract
from tickline.schemas import DQ_RESULT_SCHEMA

LAYERS = ("reference", "serving", "staging", "marts", "audit")
BUCKET_KEY = ("symbol", "trade_date")
#: Versions of a published table that are kept for readers that have one open.
KEEP_VERSIONS = 2


@dataclass(frozen=True)
class Warehouse:
    """Databases ``<prefix>_<layer>`` whose tables live below ``root`` (any path all executors share)."""

    spark: SparkSession
    root: str
    prefix: str = "tickline"

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"`{self.database(layer)}`.`{table}`"

    def create(self) -> Warehouse:
        for layer in LAYERS:
            location = f"{self.root.rstrip('/')}/{layer}.db"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}` LOCATION '{location}'")
        return self

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database(layer)}.{table}")

    def save(
        self, df: DataFrame, layer: str, table: str, keys: tuple[str, ...] = (), sort: tuple[str, ...] = (), buckets: int | None = None, analyse: bool = True
    ) -> DataFrame:
        """Replace a table; with ``keys`` it is bucketed (as many buckets as shuffle partitions) and sorted.

        ``analyse`` stores row count and column statistics, from which the
        planner orders joins and tells what is small enough to broadcast.
        """
        writer = df
        if keys:
            buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer = df.repartition(buckets, *keys)
        out = writer.write.format("parquet").mode("overwrite")
        if keys:
            out = out.bucketBy(buckets, *keys)
            out = out.sortBy(*keys, *sort)
        out.saveAsTable(f"{self.database(layer)}.{table}")
        if analyse:
            self.spark.sql(f"ANALYZE TABLE {self.name(layer, table)} COMPUTE STATISTICS FOR ALL COLUMNS")
        return self.table(layer, table)

    def versions(self, layer: str, table: str) -> list[str]:
        """Stored versions of a published table, oldest first."""
        names = [t.name for t in self.spark.catalog.listTables(self.database(layer)) if t.name.startswith(f"{table}__v")]
        return sorted(names, key=lambda n: int(n.rsplit("__v", 1)[1]))

    def publish(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        contract: Contract | None = None,
        run_id: str | None = None,
        checked_at: datetime | None = None,
        keys: tuple[str, ...] = BUCKET_KEY,
        sort: tuple[str, ...] = (),
        buckets: int | None = None,
    ) -> str:
        """Write a version, audit it, then point the view ``table`` at it; the version's name.

        A failed error-severity check raises before the switch; its results
        are in the audit table, and the rejected version is dropped.
        """
        stored = self.versions(layer, table)
        version = f"{table}__v{int(stored[-1].rsplit('__v', 1)[1]) + 1 if stored else 1}"
        written = self.save(df, layer, version, keys, sort, buckets, analyse=False)
        if contract is not None:
            results = run_contract(written, contract).collect()
            self.audit(results, run_id, checked_at)
            try:
                enforce(results)
            except Exception:
                self.spark.sql(f"DROP TABLE {self.name(layer, version)}")
                raise
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS SELECT * FROM {self.name(layer, version)}")
        for old in self.versions(layer, table)[:-KEEP_VERSIONS]:
            self.spark.sql(f"DROP TABLE {self.name(layer, old)}")
        return version

    def audit(self, results: list, run_id: str | None = None, checked_at: datetime | None = None) -> str:
        """Append check results (a few dozen rows of one contract) with run id and stamp."""
        run_id = run_id or uuid.uuid4().hex[:8]
        schema = "dataset string, check_name string, severity string, passed boolean, observed string, threshold string"
        stamp = F.lit(checked_at).cast("timestamp") if checked_at else F.current_timestamp()
        rows = self.spark.createDataFrame([tuple(r) for r in results], schema).withColumns({"run_id": F.lit(run_id), "checked_at": stamp})
        rows.select([F.col(f.name).cast(f.dataType) for f in DQ_RESULT_SCHEMA.fields]).write.mode("append").saveAsTable(f"{self.database('audit')}.dq_results")
        return run_id

    def drop(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database(layer)}` CASCADE")


def build_marts(wh: Warehouse) -> None:
    """Staging views over the serving tables, then the marts as tables, all read by name."""

    def view(name: str, build: Callable[[DataFrame], DataFrame], source: str) -> None:
        columns = ", ".join(f"`{c}`" for c in build(wh.table("serving", source)).columns)
        # renamed and re-derived columns, as the staging functions define them
        renamed = f"SELECT *, minute AS bar_ts FROM {wh.name('serving', source)}" if source == "ohlcv_1m" else f"SELECT * FROM {wh.name('serving', source)}"
        wh.spark.sql(f"CREATE OR REPLACE VIEW {wh.name('staging', name)} AS SELECT {columns} FROM ({renamed})")

    view("stg_ohlcv_1m", marts.stg_bars, "ohlcv_1m")
    view("stg_symbol_risk_daily", marts.stg_risk, "symbol_risk_daily")
    bars, risk = wh.table("staging", "stg_ohlcv_1m"), wh.table("staging", "stg_symbol_risk_daily")
    dim = wh.save(marts.dim_symbol(wh.table("reference", "symbol_reference"), risk), "marts", "dim_symbol")
    wh.save(marts.daily_performance(risk, dim), "marts", "fct_daily_symbol_performance", BUCKET_KEY)
    wh.save(marts.intraday_liquidity(bars), "marts", "fct_intraday_liquidity", BUCKET_KEY, ("bucket_ts",))


def day_positions(wh: Warehouse) -> DataFrame:
    """Bars against their day, by name: where in the day's range each symbol's minutes traded.

    Both tables are bucketed alike, so the join and the grouping run bucket by
    bucket without an exchange.
    """
    return wh.spark.sql(
        f"""
        SELECT b.symbol, b.trade_date, p.sector, p.liquidity_rank, p.vol_bucket,
               count(*) AS bars, sum(b.volume) AS bar_volume, any_value(p.total_volume) AS total_volume,
               count_if(b.high = p.day_high) AS minutes_at_high, count_if(b.low = p.day_low) AS minutes_at_low,
               count_if(b.close > p.day_open) AS minutes_above_open
        FROM {wh.name("staging", "stg_ohlcv_1m")} b
        JOIN {wh.name("marts", "fct_daily_symbol_performance")} p ON b.symbol = p.symbol AND b.trade_date = p.trade_date
        GROUP BY b.symbol, b.trade_date, p.sector, p.liquidity_rank, p.vol_bucket
        """
    )


def audit_latest(wh: Warehouse, n: int = 50) -> DataFrame:
    """The latest ``n`` stored results, newest stamp first (the dashboard's list)."""
    return wh.table("audit", "dq_results").orderBy(F.col("checked_at").desc(), "dataset", "check_name").limit(n)


def audit_runs(wh: Warehouse) -> DataFrame:
    """Passed and total checks of each run."""
    counted = wh.table("audit", "dq_results").groupBy("run_id").agg(
        F.max("checked_at").alias("checked_at"), F.count_if("passed").alias("passed_checks"), F.count(F.lit(1)).alias("total_checks")
    )
    return counted.withColumn("pass_rate", F.col("passed_checks") / F.col("total_checks"))
