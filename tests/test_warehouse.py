"""Named tables: bucketed joins without exchange, views, gated versions, the audit table."""

import uuid

import pytest
from pyspark.sql import functions as F

from tickline.plans.lineage import Lineage
from tickline.plans.stored import FIRST_RUN, SECOND_RUN, broken_bars, publish_serving
from tickline.quality.checks import ContractViolationError
from tickline.quality.contracts import load_builtin
from tickline.sources.warehouse import Warehouse, audit_latest, audit_runs, build_marts, day_positions

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), f"t_{uuid.uuid4().hex[:8]}").create()
    publish_serving(w, Lineage(spark, SF_SMALL))
    build_marts(w)
    yield w
    w.drop()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_and_grouping_have_no_exchange(spark, wh):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = day_positions(wh)
        assert df.count() > 0 and "Exchange" not in _plan(df) and "SortMergeJoin" in _plan(df)
        joined = wh.table("serving", "ohlcv_1m").join(wh.table("serving", "symbol_risk_daily"), ["symbol", "trade_date"])
        assert "Exchange" not in _plan(joined)
        loose = wh.table("serving", "ohlcv_1m").join(Lineage(spark, SF_SMALL).risk, ["symbol", "trade_date"])
        assert "Exchange" in _plan(loose)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_file_a_bucket_and_statistics(spark, wh):
    files = wh.table("serving", "ohlcv_1m").inputFiles()
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {wh.name('marts', 'dim_symbol')}").collect()}
    assert "10 rows" in described["Statistics"]


def test_views_follow_the_mart_definitions(spark, wh):
    lin = Lineage(spark, SF_SMALL)
    kinds = {t.name: t.tableType for t in spark.catalog.listTables(wh.database("staging"))}
    assert kinds == {"stg_ohlcv_1m": "VIEW", "stg_symbol_risk_daily": "VIEW"}
    assert wh.table("staging", "stg_ohlcv_1m").exceptAll(lin.stg_bars).count() == 0
    assert wh.table("marts", "fct_intraday_liquidity").count() == lin.liquidity.count()


def test_failed_gate_leaves_the_old_version(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), f"t_{uuid.uuid4().hex[:8]}").create()
    contract = load_builtin("gold_ohlcv_1m")
    bars = Lineage(spark, SF_SMALL).bars
    w.publish(bars, "serving", "ohlcv_1m", contract, "a", FIRST_RUN)
    reader = w.table("serving", "ohlcv_1m")
    n = reader.count()
    seen = []

    def watched(df):
        """What a reader sees while the next version is being written."""
        seen.append(w.table("serving", "ohlcv_1m").count())
        return df

    with pytest.raises(ContractViolationError):
        w.publish(watched(broken_bars(reader)), "serving", "ohlcv_1m", contract, "b", SECOND_RUN)
    assert seen == [n] and w.table("serving", "ohlcv_1m").count() == n
    assert w.table("serving", "ohlcv_1m").where("open IS NULL").count() == 0
    assert w.versions("serving", "ohlcv_1m") == ["ohlcv_1m__v1"]
    runs = {r["run_id"]: r for r in audit_runs(w).collect()}
    assert runs["a"]["pass_rate"] == 1.0 and runs["b"]["passed_checks"] == runs["b"]["total_checks"] - 1
    assert audit_latest(w, 3).select("run_id").distinct().collect() == [("b",)]
    for k in range(3):
        w.publish(w.table("serving", "ohlcv_1m").where(F.col("volume") >= k), "serving", "ohlcv_1m", contract, f"c{k}")
    assert len(w.versions("serving", "ohlcv_1m")) == 2
    w.drop()
