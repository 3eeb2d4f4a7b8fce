"""Substring dedup by level-wise doubling of repeated windows.

Level 1 looks at windows of ``(length + 1) // 2`` words, and of these only at
the one with the smallest hash in every run that a ``length`` window spans, so
that each long window is represented. Windows repeated at that length alone
are extended to ``length`` words, twice as many (less the shared word when
``length`` is odd). ``extend`` goes on: two adjacent repeated windows form one
of twice the length, until no candidates survive.

Counting runs as hash aggregation with partial sums (each task first reduces
its own chunk); decisions return to the positions by sort-merge joins of
stored tables, whose skewed keys Spark splits. No group is ever collected.

Defined cases: a null or empty text has no words and keeps none; a text shorter
than a window loses nothing; a null id neither removes nor loses words; rows of
one id are one document, so they don't remove each other's words; repeated rows
give one row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_TABLE, Words, as_long, chunks, discard, find_words, materialise, mix, text_key, window_hash


def _minimisers(words: Words, h: np.ndarray, short: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each ``span`` consecutive short windows of a row, the position with the smallest hash.

    Returns, for all start positions of a run, whether the run is inside a row,
    and the position of its minimiser (the leftmost of equal ones).
    """
    w = window_hash(h, short)
    n = words.n
    last = np.repeat(words.first[1:], np.diff(words.first))
    runs = np.flatnonzero(np.arange(n) + short + span - 1 <= last)
    if not len(runs):
        return runs, runs
    best, at = mix(w[runs]), runs.copy()
    for i in range(1, span):
        other = mix(w[runs + i])
        less = other < best
        best = np.where(less, other, best)
        at[less] = runs[less] + i
    return runs, at


def _first_level(short: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in chunks(batch):
                words = find_words(data, offsets, SPACE_TABLE)
                h = words.hashes()
                _, at = _minimisers(words, h, short, span)
                at = np.unique(at)
                row = words.row_of()[at] if len(at) else at
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(window_hash(h, short)[at])),
                        ids.slice(i, j - i).take(pa.array(row)),
                        pa.array((at - words.first[row]).astype(np.int32)),
                    ],
                    names=["h", "doc_id", "pos"],
                )

    return run


def _second_level(short: int, span: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            found = batch.column(batch.schema.get_field_index("found"))
            for i, j, data, offsets in chunks(batch):
                words = find_words(data, offsets, SPACE_TABLE)
                h = words.hashes()
                flags = np.zeros(words.n + 1, dtype=bool)
                own = found.slice(i, j - i)
                flat = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(own.offsets.to_numpy().astype(np.int64))
                at = flat + np.repeat(words.first[:-1], sizes)
                # rows of one id share their candidates; those beyond a shorter text are none
                flags[at[at < np.repeat(words.first[1:], sizes)]] = True
                runs, least = _minimisers(words, h, short, span)
                runs = runs[flags[least]]
                row = words.row_of()[runs] if len(runs) else runs
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i).take(pa.array(row)),
                        keys.slice(i, j - i).take(pa.array(row)),
                        pa.array((runs - words.first[row]).astype(np.int32)),
                        pa.array(as_long(window_hash(h, length)[runs])),
                        pa.array((window_hash(h, length, seed=1)[runs] >> np.uint64(33)).astype(np.int32)),
                    ],
                    names=["doc_id", "text_key", "pos", "h", "h2"],
                )

    return run


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))


def _windows_and_first(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored tables: candidate windows with their positions, and the first id of the repeated ones."""
    short = (length + 1) // 2
    span = length - short + 1
    base = _base(docs, id_col, text_col).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    id_type = base.schema["doc_id"].dataType.simpleString()
    anchors = materialise(base.select("doc_id", "text").mapInArrow(_first_level(short, span), f"h long, doc_id {id_type}, pos int"), "anchors")
    repeated = materialise(anchors.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("h"), "repeated")
    found = materialise(anchors.join(repeated, "h").select("doc_id", "pos"), "found")
    discard(anchors, repeated)
    by_doc = found.groupBy("doc_id").agg(F.collect_list("pos").alias("found"))  # at most a text's own positions
    windows = base.join(by_doc, "doc_id").mapInArrow(_second_level(short, span, length), f"doc_id {id_type}, text_key long, pos int, h long, h2 int")
    windows = materialise(windows, "windows")
    discard(found)
    first = windows.groupBy("h", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("b")).where("first_doc < b").drop("b")
    return windows, materialise(first, "first")


def repeated_windows(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All windows of ``length`` words that occur in two or more documents.

    Returns ``doc_id, text_key, pos, h, h2, first_doc``, a row for each start
    position; ``h, h2`` (96 bits) identify the word sequence and ``first_doc``
    is the smallest id it occurs in.
    """
    windows, first = _windows_and_first(docs, length, id_col, text_col)
    return windows.join(first, ["h", "h2"]).select("doc_id", "text_key", "pos", "h", "h2", "first_doc")


def extend(windows: DataFrame, length: int) -> tuple[DataFrame, int]:
    """Double repeated windows until none survives; the last level that had any, and its length.

    A window of ``2 * length`` words is a candidate only where two repeated
    windows of ``length`` follow each other; its hash is made of theirs.
    """
    level = materialise(windows.select("doc_id", "text_key", "pos", "h", "h2"), f"level-{length}")
    while True:
        right = level.select("doc_id", "text_key", (F.col("pos") - length).alias("pos"), F.col("h").alias("__h"), F.col("h2").alias("__h2"))
        pairs = level.join(right, ["doc_id", "text_key", "pos"]).select(
            "doc_id", "text_key", "pos", F.xxhash64("h", "__h").alias("h"), F.hash("h2", "__h2", "__h").alias("h2")
        )
        pairs = materialise(pairs, f"pairs-{2 * length}")
        again = pairs.groupBy("h", "h2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("h", "h2")
        longer = materialise(pairs.join(materialise(again, "again"), ["h", "h2"]), f"level-{2 * length}").select("doc_id", "text_key", "pos", "h", "h2")
        if longer.isEmpty():
            return level, length
        level, length = longer, 2 * length


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(batch.schema.get_field_index("found"))
            for i, j, data, offsets in chunks(batch):
                words = find_words(data, offsets, SPACE_TABLE)
                own = found.slice(i, j - i)
                if own.null_count:
                    own = own.fill_null([])
                flat = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                at = flat + np.repeat(words.first[:-1], np.diff(own.offsets.to_numpy().astype(np.int64)))
                cover = np.zeros(words.n + 1, dtype=np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                keep = np.cumsum(cover[:-1]) == 0
                texts = _kept(words, keep)
                kept = np.add.reduceat(np.append(keep, False).astype(np.int64), words.first[:-1]) if words.n else np.zeros(j - i, dtype=np.int64)
                n = np.diff(words.first)
                kept = np.where(n > 0, kept, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array(n),
                        pa.array(n - kept),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array([t.decode() for t in texts], type=pa.string()),
                    ],
                    names=["doc_id", "text_key", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def _kept(words: Words, keep: np.ndarray) -> list[bytes]:
    """Kept words of each row, joined by one blank."""
    at = np.flatnonzero(keep)
    size = words.end[at] - words.start[at]
    total = int(size.sum()) + len(at)
    out = np.full(total, 0x20, dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    where = np.arange(int(size.sum())) - np.repeat(np.concatenate(([0], np.cumsum(size)))[:-1], size)
    out[np.repeat(begin[:-1], size) + where] = words.data[np.repeat(words.start[at], size) + where]
    bounds = begin[np.searchsorted(at, words.first)]
    raw = out.tobytes()
    return [raw[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def remove_repeats(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row without the words of windows that also start in a smaller id.

    Returns ``doc_id, text_key, n_words, n_removed, kept_sha256, kept_text``.
    """
    base = _base(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    windows, first = _windows_and_first(docs, length, id_col, text_col)
    later = materialise(windows.join(first, ["h", "h2"]).where("first_doc < doc_id").select("doc_id", "text_key", "pos"), "later")
    discard(windows, first)
    # a row for each text and position: repeated rows give the same position twice
    spans = later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("found"))
    joined = base.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "text", "found")
    return joined.mapInArrow(_cut(length), f"doc_id {id_type}, text_key long, n_words long, n_removed long, kept_sha256 string, kept_text string")
