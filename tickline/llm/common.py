"""Helpers shared by the operators: shared scratch tables and flat word arrays.

Word arrays are built inside Arrow tasks. A batch's texts are one UTF-8 byte
buffer, so words of many documents are found, hashed and windowed with a few
vectorised passes, chunk by chunk (``CHUNK_BYTES`` bounds a task's memory; a
single text larger than that is a chunk of its own).
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.session import checkpoint_root, conf_set

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 15

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Word separators of the white-space contract: blank and tab to carriage return.
SPACE = bytes([0x20, *range(0x09, 0x0E)])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{checkpoint_root(spark)}/tickline-llm/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage so that it survives lost executors, and lets Spark drop the
    job's shuffle files once the table is written.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with conf_set(spark, **{_CLEANUP.replace(".", "__"): "true"}):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later step reads."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(conf).delete(path, True)


_SHIPPED = "tickline-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once a context, so that tasks can import it."""
    sc = spark.sparkContext
    if any(f.endswith(_SHIPPED) for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tickline-ship-"), _SHIPPED)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith((".py", ".yml")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """64-bit digest of a text; with the id it tells rows of one id apart. Null: 0."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def sampled(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash falls into a ``share`` of all; exact to 2**-62, so a small share of a huge table isn't none."""
    return F.pmod(hashed, F.lit(1 << 62)) < F.lit(int(min(1.0, share) * (1 << 62)))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives freed memory back: worker processes outlive their tasks and stages."""

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # not the GNU C library: nothing to trim
                pass

    return run_and_release


# ---------------------------------------------------------------- word arrays


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))  # an array of its own, so what follows is done in place
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


mix = _mix
_SEED = np.uint64(0x9E3779B97F4A7C15)
_BYTE = _mix((np.arange(1, 257, dtype=np.uint64)) * _SEED)
_POW = np.uint64(0xD6E8FEB86659FD93)
_Q = np.uint64(0xA0761D6478BD642F)


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; a process keeps the longest it needed."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 4096), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if n <= 2 * CHUNK_BYTES:
            _powers[int(base)] = known
    return known[: max(n, 1)]


@dataclass
class Words:
    """Words of a chunk of rows; word ``i`` is ``data[start[i]:end[i]]``.

    ``first[r]:first[r + 1]`` are the words of row ``r``.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not self.n:
            return np.zeros(0, dtype=np.uint64)
        size = self.end - self.start
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(at, size)
        where = inside + np.repeat(self.start, size)
        vals = _BYTE[self.data[where]] * powers(_POW, int(size.max()))[inside]
        return _mix(np.add.reduceat(vals, at) + size.astype(np.uint64) * _SEED)

    def windows(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start positions and hashes of all windows of ``length`` words inside one row."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        pos = np.flatnonzero(np.arange(self.n) + length <= last)
        return pos, window_hash(h, length)[pos] if len(pos) else np.zeros(0, dtype=np.uint64)


def window_hash(h: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of ``h[i:i + length]`` for every i (the last ``length - 1`` are meaningless)."""
    q = _Q if not seed else np.uint64(0xE7037ED1A0B428DB)
    out = np.zeros(len(h), dtype=np.uint64)
    n = len(h) - length + 1
    if n > 0:
        acc = np.zeros(n, dtype=np.uint64)
        for i in range(length):
            acc = acc * q + h[i : i + n]
        out[:n] = _mix(acc + np.uint64(length * int(_SEED) & 0xFFFFFFFFFFFFFFFF))
    return out


def find_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Words:
    """Maximal runs of bytes that aren't separators, split at row bounds."""
    n = len(data)
    offsets = offsets.astype(np.int64)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), dtype=np.int64))
    word = ~separator[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | cut[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def separators(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


SPACE_TABLE = separators(SPACE)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges ``i:j`` of about ``most`` bytes with their bytes and offsets."""
    raw, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, i + CHUNK_ROWS)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def list_column(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Row ``r`` of the list column is ``values[bounds[r]:bounds[r + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
