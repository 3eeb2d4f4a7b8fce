"""Late rows and duplicates on a stream, told apart by keyed state.

One ``transformWithState`` operator keyed by (topic, partition, symbol), in
whose order offsets mean something. It holds

* a value: the highest event time shown so far (the high-water mark), and
* a map from event minute to the digests of the business keys seen in it: the
  copies of a message share their event time, so a copy meets its original in
  the same minute, and a minute's set is bounded by the message rate.

Every row comes out once with a status: ``quarantined`` (a rule rejected it),
``duplicate`` (its business key was seen), ``late`` (more than ``allowed``
behind the mark of earlier offsets) or ``on_time``. State lives in RocksDB and
survives a restart with the checkpoint. A key's timer drops the minutes that
got no row for ``keep_hours`` and, when none is left, the mark. Timers follow
the time at which rows are read, not their event time: a watermark on the
latter would make the operator drop the very rows it is to report. A key's rows
of one micro-batch are held in memory; the source's bound on a trigger bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tickline.operators.ops import LATE_AFTER
from tickline.operators.silver import TICK_KEY, TRADE_KEY, parse_all

STATE_KEY = ["kafka_topic", "kafka_partition", "symbol"]
STATUSES = ("on_time", "late", "duplicate", "quarantined")
KEEP_HOURS = 24
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_OUT = (
    "kafka_topic string, kafka_partition int, symbol string, kafka_offset long, event_type string, raw_value string, "
    "ingested_us long, event_us long, high_water_us long, quarantine_reason string, status string"
)
_MINUTE_US = 60_000_000


def _micros(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1_000_000)


class LateAndDuplicate(StatefulProcessor):
    """Status of each row of a key, in offset order."""

    def __init__(self, allowed_us: int, keep_ms: int):
        self.allowed_us, self.keep_ms = allowed_us, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "high_water_us long, timer_ms long")
        self.seen = handle.getMapState("seen", "minute long", "digests binary, touched_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("kafka_offset", kind="stable", ignore_index=True)
        clean = batch["quarantine_reason"].isna().to_numpy()
        status = np.where(clean, "on_time", "quarantined").astype(object)
        mark = np.full(len(batch), np.nan)
        at = np.flatnonzero(clean)
        if len(at):
            event = batch["event_us"].to_numpy(dtype="int64", na_value=0)[at]
            high, timer = self.mark.get() or (None, None)
            shown = np.maximum.accumulate(np.concatenate(([np.iinfo(np.int64).min if high is None else high], event)))
            before = shown[:-1]
            now = int(batch["seen_ms"].max())
            duplicate = self._duplicates(event // _MINUTE_US, batch["digest"].to_numpy(dtype="int64", na_value=0)[at], now)
            late = (before > np.iinfo(np.int64).min) & (event < before - self.allowed_us) & ~duplicate
            status[at[duplicate]] = "duplicate"
            status[at[late]] = "late"
            mark[at[late]] = before[late]
            if timer is None:
                timer = now + self.keep_ms
                self.handle.registerTimer(timer)
            self.mark.update((int(shown[-1]), timer))
        out = batch.drop(columns=["digest", "seen_ms"]).assign(
            event_us=batch["event_us"].astype("Int64"), high_water_us=pd.array(mark, dtype="Float64").astype("Int64") if len(at) else pd.array([None] * len(batch), dtype="Int64"), status=status
        )
        yield out[["kafka_topic", "kafka_partition", "symbol", "kafka_offset", "event_type", "raw_value", "ingested_us", "event_us", "high_water_us", "quarantine_reason", "status"]]

    def _duplicates(self, minute: np.ndarray, digest: np.ndarray, now: int) -> np.ndarray:
        """Which rows repeat a business key; the others' keys are remembered."""
        out = np.zeros(len(minute), dtype=bool)
        for m in np.unique(minute):
            at = np.flatnonzero(minute == m)
            known = self.seen.getValue((int(m),))
            known = np.frombuffer(known[0], dtype=np.int64) if known else np.zeros(0, dtype=np.int64)
            fresh, first = np.unique(digest[at], return_index=True)
            new = ~np.isin(fresh, known)
            repeated = np.ones(len(at), dtype=bool)
            repeated[first[new]] = False
            out[at] = repeated
            self.seen.updateValue((int(m),), (np.concatenate((known, fresh[new])).tobytes(), now))
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        minutes = [(minute, touched) for (minute,), (_, touched) in self.seen.iterator()]
        silent = [minute for minute, touched in minutes if touched <= due - self.keep_ms]
        for minute in silent:
            self.seen.removeKey((minute,))
        if len(silent) == len(minutes):
            self.mark.clear()
        else:
            again = due + self.keep_ms
            self.handle.registerTimer(again)
            self.mark.update((self.mark.get()[0], again))
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if old is None else spark.conf.set(_PROVIDER, old)


def with_status(bronze: DataFrame, allowed: str = LATE_AFTER, keep_hours: float = KEEP_HOURS) -> DataFrame:
    """Streaming bronze rows with ``status``, ``event_ts`` and, for late rows, ``high_water_ts``."""
    digest = F.when(F.col("event_type") == "tick", F.xxhash64(F.lit("tick"), *TICK_KEY)).otherwise(F.xxhash64(F.lit("trade"), *TRADE_KEY))
    tagged = parse_all(bronze).select(
        *STATE_KEY,
        "kafka_offset",
        "event_type",
        "raw_value",
        F.unix_micros("ingested_at").alias("ingested_us"),
        F.unix_micros("event_ts_parsed").alias("event_us"),
        "quarantine_reason",
        digest.alias("digest"),
        F.current_timestamp().alias("seen_at"),
    )
    # rows of a batch carry the batch's own time, so none is ever behind the watermark
    tagged = tagged.withWatermark("seen_at", "0 seconds").withColumn("seen_ms", F.unix_millis("seen_at")).drop("seen_at")
    processor = LateAndDuplicate(_micros(allowed), int(keep_hours * 3_600_000))
    out = tagged.groupBy(*STATE_KEY).transformWithStateInPandas(processor, _OUT, "Append", "EventTime")
    stamp = {"event_ts": "event_us", "high_water_ts": "high_water_us", "ingested_at": "ingested_us"}
    return out.withColumns({c: F.timestamp_micros(m) for c, m in stamp.items()}).drop(*stamp.values())


def start_status_stream(bronze: DataFrame, path: str, checkpoint: str, allowed: str = LATE_AFTER, keep_hours: float = KEEP_HOURS, trigger: dict | None = None) -> StreamingQuery:
    """Write every row of a bronze stream to ``path``, partitioned by status."""
    with rocksdb_state(bronze.sparkSession):
        writer = with_status(bronze, allowed, keep_hours).writeStream.format("parquet").outputMode("append").partitionBy("status")
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start(path)
