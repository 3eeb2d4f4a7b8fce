"""Gated pipeline: full run, idempotent re-run, gates, conservation, publish, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from tickline.operators.ops import QuarantineRateExceeded
from tickline.plans.lineage import Lineage
from tickline.plans.pipeline import EmptyBronzeError, Pipeline, run_ops_daily
from tickline.quality.checks import ContractViolationError
from tickline.schemas import BRONZE_SCHEMA
from tickline.sources import tables
from tickline.sources.feed import build_feed
from tickline.sources.seed import read_seed
from tickline.sources.tables import Lake

from conftest import SF_SMALL


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def table_rows(spark, lake, layer, name, drop=()):
    df = spark.read.parquet(lake.path(layer, name)).drop(*drop)
    df = df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_full_run_then_rerun_is_identical(spark, tmpdir_path):
    lake = Lake(tmpdir_path)
    p = Pipeline(spark, lake)
    rep = p.run(build_feed(events(spark)))
    assert rep.counts["silver_ticks"] == 545 and rep.counts["silver_trades"] == 351
    assert rep.counts["ohlcv_1m"] == 526 and rep.counts["symbol_risk_daily"] == 20
    assert len(rep.dq) == 74 + 12 and all(r["passed"] for r in rep.dq)
    before = {t: table_rows(spark, lake, "gold", t) for t in ("ohlcv_1m", "symbol_risk_daily")}
    serving = table_rows(spark, lake, "serving", "ohlcv_1m")
    Pipeline(spark, lake).run()  # same bronze, second run
    assert {t: table_rows(spark, lake, "gold", t) for t in before} == before
    assert table_rows(spark, lake, "serving", "ohlcv_1m") == serving  # no doubling
    audit = spark.read.parquet(lake.path("ops", "dq_results"))
    assert audit.select("run_id").distinct().count() == 2
    ledger = spark.read.parquet(lake.path("ops", "pipeline_runs"))
    stages = ["silver", "dq_silver", "gold", "dq_gold", "publish", "marts", "dq_marts"]
    first = {r["job_name"]: r for r in ledger.where(F.col("run_id") == rep.run_id).collect()}
    assert set(first) == {"land_bronze", *stages} and all(r["status"] == "success" for r in first.values())
    assert first["silver"]["rows_in"] == 1017 and first["gold"]["rows_out"] == 526
    assert ledger.count() == len(first) + len(stages)


def test_empty_bronze_raises(spark, tmpdir_path):
    lake = Lake(tmpdir_path)
    spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(lake.path("bronze", "events"))
    with pytest.raises(EmptyBronzeError):
        Pipeline(spark, lake).silver()


def test_failed_check_is_recorded_then_raised(spark, tmpdir_path):
    lake = Lake(tmpdir_path)
    p = Pipeline(spark, lake)
    p.land_bronze(build_feed(events(spark)))
    p.silver()
    # Corrupt silver: a negative bid must stop the run after the audit rows are written.
    ticks = spark.read.parquet(lake.path("silver", "ticks"))
    ticks.withColumn("bid", F.lit(-1.0)).write.mode("overwrite").parquet(lake.path("silver", "ticks_bad"))
    os.rename(lake.path("silver", "ticks"), lake.path("silver", "ticks_old"))
    os.rename(lake.path("silver", "ticks_bad"), lake.path("silver", "ticks"))
    with pytest.raises(ContractViolationError):
        p._timed("dq_silver", p.dq_silver)
    audit = spark.read.parquet(lake.path("ops", "dq_results"))
    assert audit.where("check_name = 'bid.range' AND NOT passed").count() == 1
    p.flush_ledger()
    ledger = spark.read.parquet(lake.path("ops", "pipeline_runs"))
    assert [r["status"] for r in ledger.where("job_name = 'dq_silver'").collect()] == ["failed"]


def test_quarantine_gate(spark, tmpdir_path):
    dirty = Lake(os.path.join(tmpdir_path, "dirty"))
    Pipeline(spark, dirty).run(build_feed(events(spark)))
    with pytest.raises(QuarantineRateExceeded):
        run_ops_daily(spark, dirty)
    clean = Lake(os.path.join(tmpdir_path, "clean"))
    Pipeline(spark, clean).run(build_feed(events(spark), dirt=False))
    summary = run_ops_daily(spark, clean)
    assert summary["rate"]["quarantined_rows"] == 0


def test_conservation_is_exact(spark):
    row = Lineage(spark, SF_SMALL)
    from tickline.operators.ops import conservation

    r = conservation(row.bronze, row.silver).first()
    assert r["balanced"] and r["bronze"] == 1017 and r["quarantine_unparsed"] == 16


def test_duplicating_bronze_leaves_silver_unchanged(spark):
    lin = Lineage(spark, SF_SMALL)
    copy = lin.bronze.withColumn("kafka_offset", F.col("kafka_offset") + 10**12).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")
    )
    doubled = Lineage(spark, SF_SMALL, bronze=lin.bronze.unionByName(copy))
    for name in ("ticks", "trades"):
        a = getattr(lin.silver, name)
        b = getattr(doubled.silver, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_input_order_does_not_change_gold(spark):
    lin = Lineage(spark, SF_SMALL)
    shuffled = Lineage(spark, SF_SMALL, bronze=lin.bronze.repartition(5).orderBy(F.rand(3)))
    a, b = lin.bars, shuffled.bars
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_compaction_keeps_rows_and_cuts_files(spark, tmpdir_path):
    bars = Lineage(spark, SF_SMALL).bars
    path = os.path.join(tmpdir_path, "bars")
    bars.repartition(12).write.partitionBy("trade_date").parquet(path)
    before_files = tables.file_count(spark.read.parquet(path))
    before = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    tables.compact(spark, path, ["trade_date"])
    after = spark.read.parquet(path)
    assert tables.file_count(after) < before_files
    assert sorted(tuple(r) for r in after.collect()) == before


def test_seed_has_declared_types(spark, tmpdir_path):
    seed = read_seed(spark)
    assert dict(seed.dtypes) == {"symbol": "string", "company_name": "string", "sector": "string",
                                 "base_price": "double", "annualised_vol": "double"}
    assert seed.count() == 10
    path = os.path.join(tmpdir_path, "seed.csv")
    seed.coalesce(1).write.option("header", True).csv(path)
    assert sorted(read_seed(spark, path).collect()) == sorted(seed.collect())


def test_incremental_silver_equals_full_rebuild(spark, tmpdir_path):
    """Process ingest dates one at a time (one of them twice, and a late
    redelivery landing on a later date): silver equals a full rebuild."""
    feed = build_feed(events(spark))
    late_copies = (
        feed.where(F.col("kafka_offset") % 7 == 0)
        .withColumn("kafka_offset", F.col("kafka_offset") + 5 * 10**9)
        .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 2 DAYS"))
        .withColumn("kafka_ts", F.col("ingested_at"))
        .withColumn("ingest_date", F.to_date("ingested_at"))
    )
    bronze = feed.unionByName(late_copies)
    full = Lake(os.path.join(tmpdir_path, "full"))
    inc = Lake(os.path.join(tmpdir_path, "inc"))
    for lake in (full, inc):
        Pipeline(spark, lake).land_bronze(bronze)
    Pipeline(spark, full).silver()
    dates = sorted(r[0] for r in spark.read.parquet(inc.path("bronze", "events")).select("ingest_date").distinct().collect())
    assert len(dates) == 4
    p = Pipeline(spark, inc)
    p.silver([dates[0]])
    p.silver([dates[0]])  # re-run of the same date
    for d in dates[1:]:
        p.silver([d])
    for name in ("ticks", "trades", "quarantine_ticks", "quarantine_trades", "quarantine_unparsed"):
        assert table_rows(spark, full, "silver", name) == table_rows(spark, inc, "silver", name), name


def test_incremental_run_equals_full_run(spark, tmpdir_path):
    bronze = build_feed(events(spark))
    full = Lake(os.path.join(tmpdir_path, "full"))
    inc = Lake(os.path.join(tmpdir_path, "inc"))
    Pipeline(spark, full).run(bronze)
    Pipeline(spark, inc).land_bronze(bronze)
    dates = sorted(r[0] for r in spark.read.parquet(inc.path("bronze", "events")).select("ingest_date").distinct().collect())
    for d in dates:
        Pipeline(spark, inc).run(ingest_dates=[d])
    for layer, name in (("gold", "ohlcv_1m"), ("gold", "symbol_risk_daily"), ("marts", "daily_performance")):
        assert table_rows(spark, full, layer, name) == table_rows(spark, inc, layer, name), name


def test_clustered_spreads_a_hot_partition(spark, tmpdir_path):
    # One date holds 90 % of the rows: adaptive execution must split it over
    # several writing tasks. Tiny advisory size so that 18,000 rows count as skewed.
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    path = os.path.join(tmpdir_path, "out")
    try:
        df = spark.range(0, 20000, 1, 8).withColumn("d", F.when(F.col("id") < 18000, F.lit("hot")).otherwise(F.lit("cold")))
        tables.clustered(df, ["d"]).write.partitionBy("d").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot_files = [f for f in os.listdir(os.path.join(path, "d=hot")) if f.endswith(".parquet")]
    assert len(hot_files) >= 4
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == list(range(20000))


def test_text_landing_and_table_io(spark, tmpdir_path):
    from tickline.sources.bronze import land_text, read_text_lines

    lin = Lineage(spark, SF_SMALL)
    text = os.path.join(tmpdir_path, "events.jsonl")
    lin.bronze.select("raw_value").write.text(text)
    landed = land_text(read_text_lines(spark, text))
    assert landed.count() == 1017
    assert landed.select("kafka_offset").distinct().count() == 1017
    assert sorted(r[0] for r in landed.select("raw_value").collect()) == sorted(
        r[0] for r in lin.bronze.select("raw_value").collect()
    )
    lake = Lake(os.path.join(tmpdir_path, "lake"))
    bars = lin.bars
    tables.write_table(bars, lake, "gold", "bars", mode="overwrite", partition_by=["trade_date"])
    one_day = bars.where(F.col("trade_date") == F.lit("2024-01-02").cast("date"))
    tables.write_table(one_day, lake, "gold", "bars", mode="overwrite", partition_by=["trade_date"], dynamic=True)
    assert tables.read_table(spark, lake, "gold", "bars").count() == bars.count()


def test_unreadable_silver_stops_the_merge_and_keeps_the_table(spark, tmpdir_path, monkeypatch):
    lake = Lake(os.path.join(tmpdir_path, "lake"))
    p = Pipeline(spark, lake)
    p.land_bronze(build_feed(events(spark)))
    p.silver()
    before = {n: table_rows(spark, lake, "silver", n) for n in ("ticks", "trades")}
    date = spark.read.parquet(lake.path("bronze", "events")).first()["ingest_date"]
    original = tables.read_if_exists

    def broken(spark, path, fmt="parquet"):
        if path.endswith("ticks"):
            raise OSError("storage is away")
        return original(spark, path, fmt)

    monkeypatch.setattr(tables, "read_if_exists", broken)
    with pytest.raises(OSError):
        Pipeline(spark, lake).silver([date])
    assert before == {n: table_rows(spark, lake, "silver", n) for n in ("ticks", "trades")}


def test_missing_table_is_none_and_other_failures_are_raised(spark, tmpdir_path):
    assert tables.read_if_exists(spark, os.path.join(tmpdir_path, "nowhere")) is None
    bad = os.path.join(tmpdir_path, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet file")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says of a broken file
        tables.read_if_exists(spark, bad)


def test_rerun_removes_rows_that_are_gone(spark, tmpdir_path):
    """A date whose bronze rows were taken away loses its silver and quarantine rows; other dates stay."""
    feed = build_feed(events(spark))
    lake = Lake(os.path.join(tmpdir_path, "lake"))
    Pipeline(spark, lake).land_bronze(feed)
    dates = sorted(r[0] for r in feed.select("ingest_date").distinct().collect())
    for d in dates:
        Pipeline(spark, lake).silver([d])
    left = feed.where((F.col("ingest_date") != dates[0]) | (F.col("kafka_offset") % 2 == 0))
    left.write.mode("overwrite").partitionBy("ingest_date", "kafka_topic").parquet(lake.path("bronze", "events"))
    Pipeline(spark, lake).silver([dates[0]])
    want = Lake(os.path.join(tmpdir_path, "want"))
    Pipeline(spark, want).land_bronze(left)
    Pipeline(spark, want).silver()
    for name in ("ticks", "trades", "quarantine_ticks", "quarantine_trades", "quarantine_unparsed"):
        assert table_rows(spark, lake, "silver", name) == table_rows(spark, want, "silver", name), name


def test_rebuild_and_publish_drop_what_is_gone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, d string")
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("v", "d").collect())
    tables.publish(df, path, ["d"])
    tables.publish(df.where("d <> 'c'"), path, ["d"])
    assert read() == [(1, "a"), (2, "b")]
    tables.publish(df.where("d = 'b'").withColumn("v", F.lit(9)), path, ["d"], only=["a", "b"])
    assert read() == [(9, "b")]
    tables.publish(df, path, ["d"], only=["c"])
    assert read() == [(3, "c"), (9, "b")]


def test_compaction_bounds_and_sorts_files_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 2).alias("d"))
    df.repartition(9).write.partitionBy("d").parquet(path)
    out = tables.compact(spark, path, ["d"], rows_per_file=1000, sort_by=["v"])
    assert out["before"] == 18 and out["after"] >= 6
    for name in spark.read.parquet(path).inputFiles():
        values = [r["v"] for r in spark.read.parquet(name).collect()]
        assert len(values) <= 1000 and values == sorted(values)
    assert spark.read.parquet(path).count() == 5000
    files = sorted(spark.read.parquet(path).inputFiles())
    assert tables.compact(spark, path, ["d"], rows_per_file=1000, sort_by=["v"]) == {"before": out["after"], "after": out["after"], "rewritten": 0}
    assert sorted(spark.read.parquet(path).inputFiles()) == files  # a second run touches no file


def test_compaction_leaves_compact_partitions_alone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    df = spark.range(900).select(F.col("id").alias("v"), F.lit("t").alias("topic"), (F.col("id") % 3).alias("d"))
    df.where("d = 0").coalesce(1).write.partitionBy("d", "topic").parquet(path)
    df.where("d <> 0").repartition(5).write.mode("append").partitionBy("d", "topic").parquet(path)
    df.where("d = 1").limit(0).write.mode("append").partitionBy("d", "topic").parquet(path)
    spark.createDataFrame([(-1, "t", None)], "v long, topic string, d long").write.mode("append").partitionBy("d", "topic").parquet(path)
    of = lambda d: sorted(f for f in spark.read.parquet(path).inputFiles() if f"/d={d}/" in f)
    alone = of(0)
    assert tables.fragmented(spark, path, ["d", "topic"]) == [1, 2]
    assert tables.compact(spark, path, ["d", "topic"])["rewritten"] == 2
    assert of(0) == alone and len(of(1)) == len(of(2)) == 1
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == list(range(-1, 900))
    empty = os.path.join(tmpdir_path, "e")
    df.limit(0).write.partitionBy("d", "topic").parquet(empty)
    assert tables.compact(spark, empty, ["d", "topic"]) == {"before": 0, "after": 0, "rewritten": 0}


def test_broken_off_compaction_leaves_a_whole_copy(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    spark.range(1000).withColumn("d", F.col("id") % 3).repartition(6).write.partitionBy("d").parquet(path)
    publish = tables.publish

    def fails(*args, **kw):
        raise OSError("lost")

    monkeypatch.setattr(tables, "publish", fails)
    with pytest.raises(tables.CompactionError) as broken:
        tables.compact(spark, path, ["d"])
    copy = str(broken.value).rsplit(" ", 1)[1]
    assert sorted(r["id"] for r in spark.read.parquet(copy).collect()) == list(range(1000))
    monkeypatch.setattr(tables, "publish", publish)
    assert tables.compact(spark, path, ["d"])["rewritten"] == 3
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(1000))


def test_streamed_tables_are_refused(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "s")
    spark.range(10).withColumn("d", F.lit(1)).write.parquet(f"{root}/in")
    q = spark.readStream.schema("id long, d int").parquet(f"{root}/in").writeStream.format("parquet").partitionBy("d")
    q.option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start(f"{root}/bronze/events").awaitTermination()
    with pytest.raises(tables.StreamedTableError):
        tables.compact(spark, f"{root}/bronze/events", ["d"])
    with pytest.raises(tables.StreamedTableError):
        Pipeline(spark, Lake(root)).land_bronze(build_feed(events(spark)))
    assert spark.read.parquet(f"{root}/bronze/events").count() == 10


def test_conservation_sees_a_lost_survivor(spark):
    from dataclasses import replace

    from tickline.operators import ops

    lin = Lineage(spark, SF_SMALL)
    assert ops.conservation(lin.bronze, lin.silver).first()["balanced"]
    lost = replace(lin.silver, ticks=lin.silver.ticks.where("kafka_offset % 5 <> 0"))
    assert not ops.conservation(lin.bronze, lost).first()["balanced"]
