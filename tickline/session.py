"""Session helpers: the settings every job relies on, and the shared scratch root."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results, not only speed: the engine reads and writes
# UTC instants, so minute buckets and trade dates are zone-independent.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Runtime re-planning: coalesce small shuffles, split skewed join partitions.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


class CheckpointDirUnset(RuntimeError):
    """No shared folder is known for stored intermediate tables."""


def build_session(
    app_name: str = "tickline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or fetch a session with UTC and AQE pinned.

    ``master`` and ``shuffle_partitions`` are only set when given, so on a
    cluster the submitter's settings win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        **ADAPTIVE_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Checkpoint files written to cut lineage are removed once unreferenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the result-affecting settings on an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def conf_set(spark: SparkSession, **values: str) -> Iterator[None]:
    """Set configuration keys (``__`` stands for a dot) and put the old values back."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster whoever runs the job sets it, to a path every executor can
    reach; unset, that is an error. Only a local master, whose executors
    share the driver's disk, gets a scratch folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise CheckpointDirUnset(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="tickline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tickline/{name}-{uuid.uuid4().hex[:12]}"
