"""The medallion run as Spark jobs with gates between the layers.

Order: bronze -> silver (+ quarantine) -> contracts on silver -> gold bars ->
gold risk -> contract on bars -> serving tables -> marts -> mart tests.
A failed error-severity check raises ``ContractViolationError`` after its
results have been appended to the audit table; nothing after it runs.

Every table is written once per run. Row counts come from
``DataFrame.observe`` on the writes, not from extra ``count()`` jobs. The
parsed bronze is persisted around the five silver writes and released
after; if an executor is lost, Spark recomputes the lost blocks from the
bronze files. Gold reads silver back from the lake, and risk reads bars
back, so each stage starts from stored data with a short lineage.
"""

from __future__ import annotations

import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickline.operators import bars as bars_ops
from tickline.operators import marts, ops, risk as risk_ops
from tickline.operators.silver import DEDUPE_ORDER, TICK_KEY, TRADE_KEY, build_silver, dedupe, losers, parse_all
from tickline.quality.checks import enforce, run_contract
from tickline.quality.contracts import load_builtin
from tickline.quality.marts import MART_CONTRACTS, mart_contract, relationships
from tickline.session import checkpoint_root
from tickline.sources import tables
from tickline.sources.seed import read_seed
from tickline.sources.tables import Lake

logger = logging.getLogger(__name__)


#: Silver tables: message kind and business key.
KINDS = {"ticks": ("tick", TICK_KEY), "trades": ("trade", TRADE_KEY)}


def _copies(name: str) -> str:
    """The table of clean rows that lost to an earlier copy."""
    return f"{name}_copies"


class EmptyBronzeError(RuntimeError):
    """Bronze holds no rows: the ingest is not running."""


@dataclass
class RunReport:
    run_id: str
    counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    dq: list = field(default_factory=list)


def _write_observed(df: DataFrame, name: str, write) -> int:
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def _concurrently(tasks: dict[str, callable]) -> dict:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each). Small jobs then share the executors instead of queueing; the
    first failure is raised after all have finished."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _publish_counted(df: DataFrame, name: str, path: str, partition_by: list[str], fmt: str, only: list | None = None) -> int:
    rows = Observation(name)
    tables.publish(df, path, partition_by, fmt, only=only, observed=rows)
    return int(rows.get["rows"])


class Pipeline:
    def __init__(self, spark: SparkSession, lake: Lake, run_id: str | None = None):
        self.spark = spark
        self.lake = lake
        self.report = RunReport(run_id or uuid.uuid4().hex[:8])
        self._ledger_rows: list[dict] = []
        self.touched_trade_dates: list | None = None
        self._bars_results: list | None = None
        self._stage_rows: dict[str, tuple[int | None, int | None]] = {}

    # --------------------------------------------------------------- helpers
    def _path(self, layer: str, table: str) -> str:
        return self.lake.path(layer, table)

    def _read(self, layer: str, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.lake, layer, table)

    def _ledger(self, job: str, status: str, rows_in: int, rows_out: int, started: datetime) -> None:
        """Record a stage in the run ledger (written once per run, see ``flush_ledger``)."""
        self._ledger_rows.append(
            {
                "run_id": self.report.run_id,
                "job_name": job,
                "status": status,
                "rows_in": rows_in,
                "rows_out": rows_out,
                "started_at": started,
                "finished_at": datetime.now(timezone.utc),
            }
        )

    def flush_ledger(self) -> None:
        if self._ledger_rows:
            tables.append_ledger(self.spark, self._path("ops", "pipeline_runs"), self._ledger_rows)
            self._ledger_rows = []

    def _gate(self, results) -> None:
        """Persist first, then enforce: a failing run still leaves its audit rows.

        ``results`` is a result DataFrame (a few dozen rows, collected here)
        or rows already collected."""
        rows = results.collect() if isinstance(results, DataFrame) else list(results)
        self.report.dq.extend(rows)
        if rows:
            schema = "dataset string, check_name string, severity string, passed boolean, observed string, threshold string"
            tables.persist_results(
                self.spark.createDataFrame([tuple(r) for r in rows], schema),
                self._path("ops", "dq_results"),
                self.report.run_id,
            )
        enforce(rows)

    def _timed(self, name: str, fn):
        """Run one stage: time it and record it in the run ledger, also when it fails."""
        started = datetime.now(timezone.utc)
        t = time.perf_counter()
        self._stage_rows.pop(name, None)
        try:
            out = fn()
        except Exception:
            self._ledger(name, "failed", *self._stage_rows.get(name, (None, None)), started)
            raise
        finally:
            self.report.seconds[name] = round(time.perf_counter() - t, 3)
        self._ledger(name, "success", *self._stage_rows.get(name, (None, None)), started)
        return out

    # ---------------------------------------------------------------- stages
    def land_bronze(self, bronze: DataFrame) -> int:
        """Append landed rows to bronze, partitioned by ingest date and topic."""
        tables.refuse_streamed(self.spark, self._path("bronze", "events"))
        n = _write_observed(
            bronze,
            "bronze_landed",
            lambda d: tables.write_table(d, self.lake, "bronze", "events", "append", ["ingest_date", "kafka_topic"]),
        )
        self.report.counts["bronze_landed"] = n
        self._stage_rows["land_bronze"] = (n, n)
        return n

    def silver(self, ingest_dates: list | None = None) -> dict[str, int]:
        """Bronze -> silver tables and quarantine.

        Without ``ingest_dates`` silver and quarantine are rebuilt whole from
        all of bronze. With a list of ingest dates only those bronze
        partitions are read (partition pruning); exactly the quarantine
        partitions of those dates and the silver partitions of the trade
        dates they touch, now or before, are replaced, emptied ones included.
        """
        bronze = self._read("bronze", "events")
        if ingest_dates is not None:
            bronze = bronze.where(F.col("ingest_date").isin(*ingest_dates))
        obs = Observation("bronze_rows")
        tagged = parse_all(bronze).observe(obs, F.count(F.lit(1)).alias("rows"))
        if bronze.isEmpty():  # reads at most one row
            self._stage_rows["silver"] = (0, 0)
            raise EmptyBronzeError("Bronze is empty: is the ingest running?")
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = build_silver(bronze, tagged=tagged)
            incremental = ingest_dates is not None
            if incremental:
                self.touched_trade_dates = self._touched(out, ingest_dates)
            outputs = out.tables()
            for name in KINDS:
                every = self._with_stored(name, out.clean[name], ingest_dates) if incremental else out.clean[name]
                if every is not out.clean[name]:
                    outputs[name] = dedupe(every, KINDS[name][1], DEDUPE_ORDER)
                outputs[_copies(name)] = losers(every, KINDS[name][0])
            tasks = {}
            for name, df in outputs.items():
                part, only = "trade_date", self.touched_trade_dates
                if name.startswith("quarantine"):
                    df = df.withColumn("ingest_date", F.to_date("ingested_at")) if "ingest_date" not in df.columns else df
                    part, only = "ingest_date", ingest_dates

                tasks[name] = lambda df=df, name=name, part=part, only=only if incremental else None: _publish_counted(
                    df, f"silver_{name}", self._path("silver", name), [part], self.lake.fmt, only
                )
            # The first write parses bronze into the cache (and counts it);
            # the others then read the cache as concurrent jobs.
            counts = {"ticks": tasks.pop("ticks")()}
            counts.update(_concurrently(tasks))
            bronze_rows = int(obs.get["rows"])
        finally:
            tagged.unpersist()
        counts["bronze"] = bronze_rows
        self.report.counts.update({f"silver_{k}" if k != "bronze" else k: v for k, v in counts.items()})
        self._stage_rows["silver"] = (bronze_rows, counts["ticks"] + counts["trades"])
        return counts

    def _touched(self, out, ingest_dates: list) -> list:
        """Trade dates that rows of ``ingest_dates`` have, or had when they were last stored."""
        dates = out.ticks.select("trade_date").unionByName(out.trades.select("trade_date"))
        for name in [t for kind in KINDS for t in (kind, _copies(kind))]:
            stored = tables.read_if_exists(self.spark, self._path("silver", name), self.lake.fmt)
            if stored is not None:
                dates = dates.unionByName(stored.where(F.to_date("ingested_at").isin(*ingest_dates)).select("trade_date"))
        return sorted(r[0] for r in dates.distinct().collect() if r[0] is not None)

    def _with_stored(self, name: str, fresh: DataFrame, ingest_dates: list) -> DataFrame:
        """All clean rows of the touched trade dates: the re-run dates' new ones and the others' stored ones.

        A redelivered copy can arrive on a later ingest date than the
        original; both carry the same event time, hence the same trade date.
        The stored rows of the touched trade dates (a literal list, which
        prunes partitions) that came from other ingest dates are survivors
        and, in a small table beside them, the copies that lost; with the new
        rows they are all clean rows there are, so the same total order picks
        the survivor a full rebuild would, also when a re-run now rejects a
        first copy. The rows are checkpointed into the shared folder, which
        cuts their lineage to the stored files, so those can be overwritten.
        """
        own = ~F.to_date("ingested_at").isin(*ingest_dates) & F.col("trade_date").isin(*self.touched_trade_dates)
        every = fresh
        for table in (name, _copies(name)):
            stored = tables.read_if_exists(self.spark, self._path("silver", table), self.lake.fmt)
            if stored is not None:
                every = every.unionByName(stored.where(own).select(*fresh.columns))
        if every is fresh:
            return fresh
        checkpoint_root(self.spark)
        return every.checkpoint(eager=True)

    def _now(self, df: DataFrame) -> DataFrame:
        """The trade dates this run rebuilt; all of them on a full run.

        Keys never span trade dates: a key's copies share their event time.
        """
        return df if self.touched_trade_dates is None else df.where(F.col("trade_date").isin(*self.touched_trade_dates))

    def dq_silver(self) -> None:
        ticks = run_contract(self._now(self._read("silver", "ticks")), load_builtin("silver_ticks"))
        trades = run_contract(self._now(self._read("silver", "trades")), load_builtin("silver_trades"))
        self._gate(ticks.unionByName(trades))

    def gold(self, trade_dates: list | None = None) -> dict[str, int]:
        """Silver -> bars -> risk. With ``trade_dates`` only those dates are
        read (partition pruning) and their partitions replaced; bars and risk
        never span two trade dates, so other dates stay valid."""
        ticks, trades = self._read("silver", "ticks"), self._read("silver", "trades")
        if trade_dates is not None:
            ticks = ticks.where(F.col("trade_date").isin(*trade_dates))
            trades = trades.where(F.col("trade_date").isin(*trade_dates))

        def write(df: DataFrame, name: str) -> int:
            return _publish_counted(df, name, self._path("gold", name), ["trade_date"], self.lake.fmt, trade_dates)

        n_bars = write(bars_ops.build_ohlcv_1m(ticks, trades), "ohlcv_1m")
        stored = self._read("gold", "ohlcv_1m")
        if trade_dates is not None:
            stored = stored.where(F.col("trade_date").isin(*trade_dates))
        risk = risk_ops.build_symbol_risk_daily(stored)
        # The bars contract only reads the stored bars, so it runs as a
        # concurrent job next to the risk write; its gate is enforced in
        # ``dq_gold`` before anything is published.
        done = _concurrently(
            {
                "risk": lambda: write(risk, "symbol_risk_daily"),
                "bars_contract": lambda: run_contract(stored, load_builtin("gold_ohlcv_1m")).collect(),
            }
        )
        n_risk = done["risk"]
        self._bars_results = done["bars_contract"]
        self.report.counts.update({"ohlcv_1m": n_bars, "symbol_risk_daily": n_risk})
        self._stage_rows["gold"] = (self.report.counts.get("silver_ticks"), n_bars)
        return {"ohlcv_1m": n_bars, "symbol_risk_daily": n_risk}

    def dq_gold(self) -> None:
        if self._bars_results is not None:  # computed next to the risk write
            rows, self._bars_results = self._bars_results, None
            self._gate(rows)
        else:
            self._gate(run_contract(self._now(self._read("gold", "ohlcv_1m")), load_builtin("gold_ohlcv_1m")))

    def publish(self) -> None:
        """Serving copies: all of gold, or on an incremental run its touched trade dates."""
        _concurrently(
            {
                t: lambda t=t: tables.publish(
                    self._read("gold", t), self._path("serving", t), ["trade_date"], self.lake.fmt, only=self.touched_trade_dates
                )
                for t in ("ohlcv_1m", "symbol_risk_daily")
            }
        )

    def marts(self) -> None:
        bars = marts.stg_bars(self._read("serving", "ohlcv_1m"))
        risk = marts.stg_risk(self._read("serving", "symbol_risk_daily"))
        dim = marts.dim_symbol(read_seed(self.spark), risk)
        tables.write_table(dim, self.lake, "marts", "dim_symbol", "overwrite")
        dim = self._read("marts", "dim_symbol")
        _concurrently(
            {
                "daily_performance": lambda: tables.write_table(
                    marts.daily_performance(risk, dim), self.lake, "marts", "daily_performance", "overwrite"
                ),
                "intraday_liquidity": lambda: tables.write_table(
                    marts.intraday_liquidity(bars), self.lake, "marts", "intraday_liquidity", "overwrite"
                ),
            }
        )

    def dq_marts(self) -> None:
        frames = {name: self._read("marts", name) for name in MART_CONTRACTS}
        results = None
        for name in MART_CONTRACTS:
            r = run_contract(frames[name], mart_contract(name))
            results = r if results is None else results.unionByName(r)
        orphans = relationships(frames["daily_performance"], frames["dim_symbol"]).agg(F.count(F.lit(1)).alias("n"))
        rel = orphans.select(
            F.lit("marts/fct_daily_symbol_performance").alias("dataset"),
            F.lit("symbol.relationships(dim_symbol.symbol)").alias("check_name"),
            F.lit("error").alias("severity"),
            (F.col("n") == 0).alias("passed"),
            F.concat(F.col("n").cast("string"), F.lit(" orphans")).alias("observed"),
            F.lit("0").alias("threshold"),
        )
        self._gate(results.unionByName(rel))

    def run(self, bronze: DataFrame | None = None, ingest_dates: list | None = None) -> RunReport:
        """Gated run. ``bronze`` (optional) is landed first. With
        ``ingest_dates`` only those bronze dates are processed and only the
        trade dates they touch are rebuilt in silver and gold."""
        try:
            if bronze is not None:
                self._timed("land_bronze", lambda: self.land_bronze(bronze))
            self._timed("silver", lambda: self.silver(ingest_dates))
            self._timed("dq_silver", self.dq_silver)
            self._timed("gold", lambda: self.gold(self.touched_trade_dates if ingest_dates is not None else None))
            self._timed("dq_gold", self.dq_gold)
            self._timed("publish", self.publish)
            self._timed("marts", self.marts)
            self._timed("dq_marts", self.dq_marts)
        finally:
            self.flush_ledger()
        return self.report


#: Tables of the daily maintenance: partition columns and order inside files.
MAINTAINED = {
    ("bronze", "events"): (["ingest_date", "kafka_topic"], ["kafka_partition", "kafka_offset"]),
    ("silver", "ticks"): (["trade_date"], ["symbol", "event_ts"]),
    ("silver", "trades"): (["trade_date"], ["symbol", "event_ts"]),
}


def maintain(spark: SparkSession, lake: Lake) -> dict[str, dict]:
    """Compact the partitions with small files of the tables that grow by them."""
    done = {}
    for (layer, name), (partition_by, sort_by) in MAINTAINED.items():
        path = lake.path(layer, name)
        if tables.read_if_exists(spark, path, lake.fmt) is not None:
            done[f"{layer}/{name}"] = tables.compact(spark, path, partition_by, fmt=lake.fmt, sort_by=sort_by)
    return done


def run_ops_daily(spark: SparkSession, lake: Lake) -> dict:
    """Maintenance, then quarantine triage: counts by reason and the quarantine-rate gate."""
    from pyspark.sql.types import DateType, StructField, StructType

    from tickline.operators.silver import silver_schemas

    maintenance = maintain(spark, lake)
    schemas = silver_schemas(spark)
    for name in ("quarantine_ticks", "quarantine_trades"):
        schemas[name] = StructType(schemas[name].fields + [StructField("ingest_date", DateType())])
    read = lambda t: tables.read_table(spark, lake, "silver", t, schema=schemas[t])
    quarantine = {t: read(t) for t in ("quarantine_ticks", "quarantine_trades", "quarantine_unparsed")}
    report = [r.asDict() for r in ops.quarantine_report(quarantine).collect()]
    rate = ops.quarantine_rate(
        [read("ticks"), read("trades")], [quarantine["quarantine_ticks"], quarantine["quarantine_trades"]]
    ).first()
    summary = {"report": report, "rate": rate.asDict(), "maintenance": maintenance}
    ops.enforce_quarantine_rate(rate)
    return summary
