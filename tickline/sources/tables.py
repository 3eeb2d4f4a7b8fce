"""Lake tables: read / write by layer and name, idempotent per-partition
publish, compaction, and append-only audit tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickline.schemas import DQ_RESULT_SCHEMA
from tickline.session import scratch_path


@dataclass(frozen=True)
class Lake:
    """A lake rooted at ``root`` (any Hadoop path: file:, hdfs:, s3a:, ...)."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, lake: Lake, layer: str, table: str, schema=None) -> DataFrame:
    """Read a lake table. Pass ``schema`` for tables that may be empty: an
    empty partitioned write leaves no data file to infer a schema from."""
    reader = spark.read.format(lake.fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(lake.path(layer, table))


#: What Spark says of a path that isn't there or holds no data file yet.
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if nothing was ever written there.

    Any other failure is raised: taking it for an empty table would let the
    next overwrite delete the stored rows.
    """
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in _ABSENT:
            return None
        raise


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


class StreamedTableError(RuntimeError):
    """The folder belongs to a streaming file sink, whose log alone says which files count."""


def refuse_streamed(spark: SparkSession, path: str) -> None:
    """Raise if readers of ``path`` follow a stream's file log: files written
    beside it are invisible, and files replaced under it break every read."""
    fs, make = _fs(spark, path)
    if fs.exists(make(f"{path.rstrip('/')}/_spark_metadata")):
        raise StreamedTableError(f"{path} is written by a streaming file sink")


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Delete the first-level partitions ``column=value`` of a table."""
    fs, make = _fs(spark, path)
    wanted = {str(v) for v in values}
    if not fs.exists(make(path)):
        return
    for entry in fs.listStatus(make(path)):
        name, _, value = entry.getPath().getName().partition("=")
        if name == column and unquote(value) in wanted:
            fs.delete(entry.getPath(), True)


def _files_of(spark: SparkSession, path: str, column: str, values: list) -> dict[str, frozenset]:
    """Names of the files in each of the first-level partitions ``column=value`` that exist."""
    fs, make = _fs(spark, path)
    wanted, out = {str(v) for v in values}, {}
    if not fs.exists(make(path)):
        return out
    for entry in fs.listStatus(make(path)):
        name, _, value = entry.getPath().getName().partition("=")
        if name == column and unquote(value) in wanted:
            out[unquote(value)] = frozenset(_data_files(spark, entry.getPath().toString()))
    return out


def write_table(
    df: DataFrame,
    lake: Lake,
    layer: str,
    table: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    dynamic: bool = False,
) -> str:
    """Write ``df``; returns the table path.

    With ``dynamic=True`` an overwrite replaces only the partitions present
    in ``df`` (re-running one trade date leaves the others alone).
    """
    path = lake.path(layer, table)
    writer = df.write.format(lake.fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path


# Upper bound on rows per output file when a table is laid out per partition.
ROWS_PER_FILE = 2_000_000


def clustered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Cluster rows by partition value, splitting values that are too big.

    A plain ``repartition(partition columns)`` sends every row of one value
    to one task: a date holding a third of the table would be written by a
    single task. The ``rebalance`` hint hash-partitions on the same columns
    and lets adaptive execution split a skewed partition into tasks of the
    advisory size (and merge tiny ones), measured at runtime with no extra
    pass over the data. The shuffle is by column hash, so a retried task
    after an executor loss reads the same rows.
    """
    return df.hint("rebalance", *partition_by)


def publish(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    fmt: str = "parquet",
    rows_per_file: int = ROWS_PER_FILE,
    only: list | None = None,
    observed: Observation | None = None,
    sort_by: list[str] | None = None,
) -> str:
    """Make the table hold exactly ``df``; loading it twice is loading it once.

    With ``only``, values of the first partition column, exactly those
    partitions are replaced: rows of ``df`` elsewhere are left out, and a
    named partition without rows is emptied. ``observed`` gets the number of
    ``rows`` written, counted above the clustering shuffle. With ``sort_by``
    the rows of each file are in that order.
    """
    spark, column = df.sparkSession, partition_by[0]
    if only is not None:
        df = df.where(F.col(column).isin(*only))
        before = _files_of(spark, path, column, only)
    shaped = clustered(df, partition_by)
    if observed is not None:
        shaped = shaped.observe(observed, F.count(F.lit(1)).alias("rows"))
    if sort_by is not None:
        shaped = shaped.sortWithinPartitions(*partition_by, *sort_by)
    (
        shaped.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if only is None else "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by)
        .save(path)
    )
    if only is not None:
        # a partition that got no rows wasn't written: it still has the files it had
        after = _files_of(spark, path, column, only)
        drop_partitions(spark, path, column, [v for v, names in after.items() if names == before.get(v)])
    return path


#: A partition is worth rewriting while its files hold less than half of this on average.
SMALL_FILE = 8 << 20


class CompactionError(RuntimeError):
    """Spark's commit of a compaction failed; the rows are whole in the copy that the message names."""


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below ``path``, relative to it; hidden folders aren't part of the table."""
    fs, make = _fs(spark, path)
    root = fs.makeQualified(make(path)).toString().rstrip("/")
    out, todo = [], [make(path)]
    while todo:
        for entry in fs.listStatus(todo.pop()):
            if entry.getPath().getName()[0] in "_.":
                continue
            if entry.isDirectory():
                todo.append(entry.getPath())
            else:
                out.append(fs.makeQualified(entry.getPath()).toString()[len(root) + 1 :])
    return out


def _listed(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame | None:
    """Files and bytes of each partition, from a listing that opens no file; None for a table without files."""
    listing = spark.read.format("binaryFile").load(path)
    if not set(partition_by) <= set(listing.columns):
        return None
    return listing.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def fragmented(spark: SparkSession, path: str, partition_by: list[str], rows_per_file: int = ROWS_PER_FILE, fmt: str = "parquet", small_file: int = SMALL_FILE) -> list:
    """Values of the first partition column that have a partition with twice the files it needs, or more.

    What a partition needs follows from its bytes and, where these alone say
    that there are too many files, from its rows. A null value isn't listed.
    What reaches the driver is a row for each partition with small files.
    """
    listed = _listed(spark, path, partition_by)
    if listed is None:
        return []
    listed = listed.withColumn("needed", F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(small_file))))
    found = listed.where(F.col(partition_by[0]).isNotNull() & (F.col("files") >= 2 * F.col("needed"))).collect()
    if not found:
        return []
    stored = spark.read.format(fmt).load(path).where(F.col(partition_by[0]).isin(*{r[0] for r in found}))
    rows = {tuple(r)[:-1]: r["n"] for r in stored.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n")).collect()}
    key = len(partition_by)
    return sorted({r[0] for r in found if r["files"] >= 2 * -(-rows.get(tuple(r)[:key], 0) // rows_per_file)})


def compact(
    spark: SparkSession,
    path: str,
    partition_by: list[str],
    rows_per_file: int = ROWS_PER_FILE,
    fmt: str = "parquet",
    sort_by: list[str] | None = None,
    small_file: int = SMALL_FILE,
) -> dict[str, int]:
    """Rewrite the partitions that hold many small files; others aren't touched.

    Their rows are copied to the shared scratch folder and published from
    there, so Spark's own commit exchanges the files. Partitions whose files
    changed while they were copied are left for the next run; a table has one
    writer a partition while it is compacted. If the commit fails, the copy
    stays and ``CompactionError`` names it. Returns the file counts before and
    after, and how many values of the first partition column were rewritten.
    """
    path = path.rstrip("/")
    refuse_streamed(spark, path)
    column = partition_by[0]
    count = lambda: (lambda t: 0 if t is None else t.agg(F.sum("files")).first()[0] or 0)(_listed(spark, path, partition_by))
    before = count()
    touched = fragmented(spark, path, partition_by, rows_per_file, fmt, small_file)
    if not touched:
        return {"before": before, "after": before, "rewritten": 0}
    files = _files_of(spark, path, column, touched)
    copy = scratch_path(spark, "compact")
    current = spark.read.format(fmt).load(path)
    current.where(F.col(column).isin(*touched)).write.format(fmt).partitionBy(*partition_by).save(copy)
    now = _files_of(spark, path, column, touched)
    steady = [v for v in touched if files.get(str(v)) == now.get(str(v))]
    if steady:
        copied = spark.read.schema(current.schema).format(fmt).load(copy)
        try:
            publish(copied, path, partition_by, fmt, rows_per_file, only=steady, sort_by=sort_by or [])
        except Exception as e:
            raise CompactionError(f"compaction of {path} broke off; the rows of {column} in {steady} are whole in {copy}") from e
    fs, make = _fs(spark, copy)
    fs.delete(make(copy), True)
    return {"before": before, "after": count(), "rewritten": len(steady)}


def file_count(df: DataFrame) -> int:
    """Number of data files behind a file-based DataFrame."""
    return len(df.inputFiles())


def persist_results(results: DataFrame, path: str, run_id: str | None = None, fmt: str = "parquet") -> str:
    """Append check results to the audit table with a run id and a UTC stamp."""
    run_id = run_id or uuid.uuid4().hex[:8]
    stamped = results.select(
        F.lit(run_id).alias("run_id"),
        "dataset",
        "check_name",
        "severity",
        "passed",
        "observed",
        "threshold",
        F.current_timestamp().alias("checked_at"),
    )
    stamped.select([F.col(f.name).cast(f.dataType) for f in DQ_RESULT_SCHEMA.fields]).write.format(fmt).mode(
        "append"
    ).save(path)
    return run_id


def append_ledger(spark: SparkSession, path: str, rows: list[dict], fmt: str = "parquet") -> None:
    """Append run-ledger rows (run_id, job_name, status, rows_in, rows_out,
    started_at, finished_at): a handful of driver-side values per run."""
    schema = "run_id string, job_name string, status string, rows_in bigint, rows_out bigint, started_at timestamp, finished_at timestamp"
    spark.createDataFrame(rows, schema).write.format(fmt).mode("append").save(path)
