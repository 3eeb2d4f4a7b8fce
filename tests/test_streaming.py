"""Streaming: bronze ingest with restart, bounded batches, incremental silver and bars."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tickline.operators.bars import build_ohlcv_1m
from tickline.operators.silver import build_silver
from tickline.schemas import KAFKA_SCHEMA
from tickline.streaming.bronze_stream import read_kafka_files, start_bronze_stream
from tickline.streaming.incremental import stream_bars, stream_silver

T = dt.datetime(2024, 1, 2, 10, 0, 0)


def tick_json(seq, ts, bid=100.0, ask=100.2, symbol="GS"):
    return json.dumps({"event_type": "tick", "symbol": symbol, "venue": "NYSE", "seq": seq,
                       "event_ts": ts.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00", "bid": bid, "ask": ask,
                       "bid_size": 1, "ask_size": 1, "last": bid})


def write_batch(spark, folder, name, records):
    rows = [(r[0], r[1], "market.ticks.v1", 0, r[2], T) for r in records]
    spark.createDataFrame(rows, KAFKA_SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def run_bronze(spark, root, **kw):
    src = read_kafka_files(spark, os.path.join(root, "in", "*"), **kw)
    q = start_bronze_stream(src, os.path.join(root, "bronze"), os.path.join(root, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return q


def test_bronze_stream_restart_no_loss_no_double(spark, tmpdir_path):
    inp = os.path.join(tmpdir_path, "in")
    write_batch(spark, inp, "f1", [("GS", tick_json(1, T), 1), ("GS", tick_json(2, T), 2)])
    write_batch(spark, inp, "f2", [("GS", "{\"event_ty", 3)])
    run_bronze(spark, tmpdir_path)
    write_batch(spark, inp, "f3", [("GS", tick_json(3, T), 4)])
    run_bronze(spark, tmpdir_path)  # restart from the same checkpoint
    bronze = spark.read.parquet(os.path.join(tmpdir_path, "bronze"))
    assert sorted(r["kafka_offset"] for r in bronze.collect()) == [1, 2, 3, 4]
    assert bronze.where(F.col("kafka_offset") == 3).first()["raw_value"] == "{\"event_ty"  # untouched
    assert set(bronze.columns) >= {"ingest_date", "kafka_topic", "ingested_at", "kafka_ts"}


def test_bounded_micro_batches(spark, tmpdir_path):
    inp = os.path.join(tmpdir_path, "in")
    for i in range(3):
        write_batch(spark, inp, f"f{i}", [("GS", tick_json(i, T), i)])
    q = run_bronze(spark, tmpdir_path, max_files_per_trigger=1)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3


def bronze_stream_of(spark, tmpdir_path, records):
    """Land each record list as its own bronze micro-batch, then stream bronze
    back one file per trigger, so event time advances batch by batch."""
    inp = os.path.join(tmpdir_path, "in")
    for i, recs in enumerate(records):
        write_batch(spark, inp, f"f{i}", [recs] if isinstance(recs, tuple) else recs)
        src = read_kafka_files(spark, os.path.join(inp, "*"))
        q = start_bronze_stream(
            src.coalesce(1), os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "ckpt"),
            trigger={"availableNow": True},
        )
        q.awaitTermination()
    path = os.path.join(tmpdir_path, "bronze")
    static = spark.read.parquet(path)
    stream = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, static


def collect_stream(df, name, ckpt, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
    q = q.trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_streaming_silver_drops_redelivery(spark, tmpdir_path):
    payload = tick_json(7, T)
    stream, static = bronze_stream_of(spark, tmpdir_path, [[("GS", payload, 1)], [("GS", payload, 1000000001)]])
    out = collect_stream(stream_silver(stream)["ticks"], "silver_ticks_s", os.path.join(tmpdir_path, "c1"))
    assert out.count() == 1 and build_silver(static).ticks.count() == 1


def test_streaming_bars_equal_batch_inside_watermark(spark, tmpdir_path):
    recs = []
    off = 0
    for m in range(6):
        for s in (5, 20, 40):
            off += 1
            recs.append(("GS", tick_json(off, T + dt.timedelta(minutes=m, seconds=s), bid=100 + off, ask=100.5 + off), off))
    # Two later ticks move the watermark to 10:20 and 10:21; with chained
    # stateful operators Spark drops late rows against the previous batch's
    # watermark, so the 10:01 tick arriving after both is late.
    closer = ("GS", tick_json(1000, T + dt.timedelta(minutes=30)), 901)
    closer2 = ("GS", tick_json(1001, T + dt.timedelta(minutes=31)), 902)
    late = ("GS", tick_json(999, T + dt.timedelta(minutes=1)), 903)
    stream, static = bronze_stream_of(spark, tmpdir_path, [recs, [closer], [closer2], [late]])
    s = stream_silver(stream)
    bars = collect_stream(stream_bars(s["ticks"], s["trades"]), "bars_s", os.path.join(tmpdir_path, "c2"))
    got = {r["minute"]: (r["open"], r["close"], r["tick_count"]) for r in bars.collect()}
    silver = build_silver(static.where(F.col("kafka_offset") <= 18))
    want = {r["minute"]: (r["open"], r["close"], r["tick_count"]) for r in build_ohlcv_1m(silver.ticks, silver.trades).collect()}
    assert got == want  # 10:30 and 10:31 are still open; the late tick is in no bar


def test_late_split_matches_batch_definition(spark, tmpdir_path):
    from tickline.operators.ops import late_events
    from tickline.operators.silver import parse_all
    from tickline.streaming.late_split import start_late_split

    t = [T + dt.timedelta(minutes=m) for m in (0, 30, 5, 31, 12, 40, 29)]
    batches = [[("GS", tick_json(i, ts), i)] for i, ts in enumerate(t)]
    batches[1].append(("MS", tick_json(100, T, symbol="MS"), 100))
    stream, static = bronze_stream_of(spark, tmpdir_path, batches)

    def parsed(df):
        tagged = parse_all(df)
        return tagged.where(F.col("event_type") == "tick").select(
            "symbol", "kafka_offset", F.col("event_ts_parsed").alias("event_ts")
        )

    root = os.path.join(tmpdir_path, "split")
    q = start_late_split(parsed(stream), root, os.path.join(tmpdir_path, "c3"), trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(r["kafka_offset"] for r in spark.read.parquet(os.path.join(root, "late")).collect())
    want = sorted(r["kafka_offset"] for r in late_events(parsed(static)).collect())
    assert got == want == [2, 4, 6]
    on_time = spark.read.parquet(os.path.join(root, "on_time")).count()
    assert on_time + len(got) == static.count()


def test_streaming_silver_job_matches_batch_silver(spark, tmpdir_path):
    """On in-order input (no row later than the watermark) the streamed silver
    tables equal batch silver."""
    from tickline.streaming.incremental import start_silver_stream

    recs = []
    for i in range(40):
        ts = T + dt.timedelta(seconds=20 * i)
        payload = tick_json(i, ts, bid=100.0 + i % 3, ask=100.5 + i % 3) if i % 9 else tick_json(i, ts, bid=None)
        recs.append(("GS", payload, i))
    recs.append(("GS", recs[5][1], 1000))  # redelivered copy, within the watermark
    recs.append(("GS", '{"event_ty', 1001))
    stream, static = bronze_stream_of(spark, tmpdir_path, [recs[:20], recs[20:]])
    lake = os.path.join(tmpdir_path, "lake")
    queries = start_silver_stream(stream, lake, os.path.join(tmpdir_path, "ck"), trigger={"availableNow": True})
    for q in queries.values():
        q.awaitTermination()
    batch = build_silver(static)
    for name in ("ticks", "quarantine_ticks", "quarantine_unparsed"):
        got = spark.read.parquet(os.path.join(lake, "silver", name))
        want = getattr(batch, name)
        assert got.count() == want.count(), name
        assert sorted(r["kafka_offset"] for r in got.collect()) == sorted(r["kafka_offset"] for r in want.collect())


def test_late_split_keeps_every_row(spark, tmpdir_path):
    """NULL symbols and times stay, and a tick and a trade with one offset are two rows."""
    from tickline.streaming.late_split import split_batch

    schema = "event_type string, symbol string, kafka_topic string, kafka_partition int, kafka_offset long, event_ts timestamp"
    t = [T + dt.timedelta(minutes=m) for m in (0, 30, 1)]
    rows = [("tick", "GS", "a", 0, 1, t[0]), ("tick", "GS", "a", 0, 2, t[1]), ("tick", "GS", "a", 0, 3, t[2]),
            ("trade", "GS", "b", 0, 3, t[1]), ("tick", None, "a", 0, 4, t[0]), ("trade", "GS", "b", 0, 5, None)]
    root = os.path.join(tmpdir_path, "split")
    split_batch(spark.createDataFrame(rows, schema), 0, root)
    later = [("tick", "GS", "a", 0, 6, t[0]), ("tick", "MS", "a", 0, 7, t[0])]
    for _ in range(2):  # a retried batch replaces its own rows
        split_batch(spark.createDataFrame(later, schema), 1, root)
    split_batch(spark.createDataFrame([("tick", "GS", "a", 0, 8, t[1])], schema), 2, root)
    late = spark.read.parquet(f"{root}/late").collect()
    on_time = spark.read.parquet(f"{root}/on_time").collect()
    assert sorted((r["event_type"], r["kafka_offset"]) for r in late) == [("tick", 3), ("tick", 6)]
    assert len(late) + len(on_time) == len(rows) + len(later) + 1
    assert sorted(os.listdir(f"{root}/high_water"))[-1] == "batch_id=2" and not os.path.exists(f"{root}/high_water/batch_id=0")


def test_stream_bars_join_lands_even_slices_from_all_tasks(spark, tmp_path, monkeypatch):
    """Two sessions with a night between: every slice has rows and several files, is one micro-batch, and state is cut by rows."""
    from datetime import datetime, timedelta

    from tickline.plans import streams
    from tickline.plans.lineage import Lineage
    from tickline.session import conf_set

    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(seconds=43 * i), i % 30, ["view", "click", "purchase"][i % 3], float(i % 50), f'{{"k": {i % 100}}}') for i in range(4000)]
    rows += [*rows[100:140], (4999, day, 1, "view", 1.0, None), (5000, None, 2, "purchase", 2.0, '{"k": 1}'), (5001, day, 3, "purchase", None, '{"k": 2}')]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    with conf_set(spark, spark__sql__shuffle__partitions="40"):
        got = streams.q_stream_bars_join(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    bars = Lineage(spark, str(tmp_path)).bars.select(*got.columns)
    bars = bars.select([F.round(c, streams.STREAM_ROUND[c]) + F.lit(0.0) if c in streams.STREAM_ROUND else F.col(c) for c in bars.columns]).toDF(*got.columns)
    assert got.count() == bars.count() > 1000
    assert got.exceptAll(bars).isEmpty()

    root = tmp_path / "stream_bars_join"
    assert len(list((root / "bronze").glob("*.parquet"))) >= 4 * streams.SLICES
    assert len([x for x in (root / "checkpoint" / "commits").iterdir() if x.name.isdigit()]) == streams.SLICES + 2
    assert len([x for x in (root / "checkpoint" / "state" / "0").iterdir() if x.name.isdigit()]) <= spark.sparkContext.defaultParallelism
    parts, n = streams.arrival_slices(Lineage(spark, str(tmp_path)).bronze)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == n and min(sizes) > 0.8 * n / streams.SLICES


def test_state_partitions_follow_the_rows(spark):
    from tickline.plans.streams import STATE_ROWS, state_partitions
    from tickline.session import conf_set

    cores = spark.sparkContext.defaultParallelism
    with conf_set(spark, spark__sql__shuffle__partitions="1000"):
        assert state_partitions(spark, 0) == state_partitions(spark, cores * STATE_ROWS) == cores
        assert state_partitions(spark, cores * STATE_ROWS + 1) == cores + 1
        assert state_partitions(spark, 2000 * STATE_ROWS) == 1000
