"""Benchmark decontamination: a broadcast set of test n-grams, scanned and verified.

Benchmark texts are cut into windows of ``n`` normalised words (a shorter item
is one window of its own length). Documents are scanned window by window
against a broadcast hash set; each hit is verified word by word. A document
word inside any occurrence of a window is hit.

The broadcast holds at most ``block_chars`` characters of benchmark text. A
larger benchmark is dealt into blocks of that size, each scanned against all
documents, and the hits are merged: no item is left out.

Defined cases: a null or empty text has no words and is never contaminated; an
item without words is no window; rows of one item id count as one item; repeated document
rows give one row each; a null item id can be hit but isn't listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, find_words, separators, text_key, window_hash

#: Bytes that are no part of a word, after A-Z are lower-cased.
_SEPARATOR = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

SPANS = "array<struct<first:int,last:int>>"


class NgramSet:
    """Windows of one benchmark block, by length and hash; small by construction."""

    def __init__(self, items: list[tuple[object, str]], n: int):
        self.lengths: dict[int, dict[int, dict[tuple[bytes, ...], set[int]]]] = {}
        self.ids = [i for i, _ in items]
        data = [text.encode() for _, text in items]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in data]))).astype(np.int64)
        words = _words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
        h = words.hashes()
        for item in range(len(items)):
            a, b = int(words.first[item]), int(words.first[item + 1])
            if a == b:
                continue
            size = min(n, b - a)
            own = [words.data[words.start[w] : words.end[w]].tobytes() for w in range(a, b)]
            hashed = window_hash(h[a:b], size)
            table = self.lengths.setdefault(size, {})
            for p in range(b - a - size + 1):
                table.setdefault(int(hashed[p]), {}).setdefault(tuple(own[p : p + size]), set()).add(item)
        self.keys = {size: np.sort(np.fromiter(t, dtype=np.uint64)) for size, t in self.lengths.items()}
        self.filters = {}
        for size, keys in self.keys.items():
            bits = max(16, int(len(keys) * 16).bit_length())
            mask = np.uint64((1 << bits) - 1)
            flags = np.zeros(1 << bits, dtype=bool)
            flags[(keys & mask).astype(np.int64)] = True
            self.filters[size] = (mask, flags)


def _words(data: np.ndarray, offsets: np.ndarray):
    return find_words(_LOWER[data] if len(data) else data, offsets, _SEPARATOR)


def _scan(found: NgramSet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch):
                words = _words(data, offsets)
                h = words.hashes()
                cover = np.zeros(words.n + 1, dtype=np.int32)
                items: list[set[int]] = [set() for _ in range(j - i)]
                row_of = words.row_of()
                for size, table in found.lengths.items():
                    pos, w = words.windows(h, size)
                    mask, flags = found.filters[size]
                    maybe = np.flatnonzero(flags[(w & mask).astype(np.int64)])
                    for x in maybe.tolist():
                        texts = table.get(int(w[x]))
                        if texts is None:
                            continue
                        p = int(pos[x])
                        own = tuple(words.data[a:b].tobytes() for a, b in zip(words.start[p : p + size].tolist(), words.end[p : p + size].tolist(), strict=True))
                        if own in texts:
                            cover[p] += 1
                            cover[p + size] -= 1
                            items[row_of[p]] |= texts[own]
                hit = np.cumsum(cover[:-1]) > 0
                spans: list[list[dict[str, int]]] = [[] for _ in range(j - i)]
                if hit.any():
                    first = words.first[:-1]
                    edge = np.zeros(words.n, dtype=bool)
                    edge[first[first < words.n]] = True
                    begin = hit & (edge | ~np.concatenate(([False], hit[:-1])))
                    stop = hit & np.concatenate(((edge | ~hit)[1:], [True]))
                    for a, b in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(stop).tolist(), strict=True):
                        r = int(row_of[a])
                        spans[r].append({"first": a - int(words.first[r]), "last": b - int(words.first[r])})
                own_items = [list(dict.fromkeys(found.ids[x] for x in sorted(s) if found.ids[x] is not None)) for s in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array(np.diff(words.first)),
                        pa.array(spans, type=pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                        pa.array(own_items, type=pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text_key", "n_words", "spans", "items"],
                )

    return run


def _blocks(benchmark: DataFrame, block_chars: int) -> int:
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-int(total) // block_chars))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 13, block_chars: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Hits of ``benchmark`` windows in each row of ``docs``.

    Returns ``doc_id, text_key, n_words, spans, items``: the word spans that are
    hit (first and last word, inclusive, merged) and the distinct item ids as
    strings.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    blocks = _blocks(items, block_chars)
    schema = T.StructType([*base.schema.fields[:2], T.StructField("n_words", T.LongType())])
    ddl = schema.add("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))).add("items", T.ArrayType(T.StringType()))
    parts = []
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        found = NgramSet([(r["item"], r["text"]) for r in own.collect()], n)
        parts.append(base.mapInArrow(_scan(found), ddl))
    if blocks == 1:
        return parts[0]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return _merged(whole, blocks)


def _merged(parts: DataFrame, blocks: int) -> DataFrame:
    """One row per document row from the hits of several blocks; overlapping spans become one."""
    whole = parts.groupBy("doc_id", "text_key", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count(F.lit(1)).alias("seen"),
    )
    whole = whole.withColumn("seen", F.explode(F.sequence(F.lit(1).cast("long"), F.expr(f"seen div {blocks}"))))
    joined = F.expr(
        """aggregate(spans, cast(array() as array<struct<first:int,last:int>>), (acc, s) ->
             case when size(acc) > 0 and s.first <= element_at(acc, -1).last + 1
             then concat(slice(acc, 1, size(acc) - 1),
                         array(named_struct('first', element_at(acc, -1).first, 'last', greatest(element_at(acc, -1).last, s.last))))
             else concat(acc, array(s)) end)"""
    )
    return whole.withColumn("spans", joined).select("doc_id", "text_key", "n_words", "spans", "items")


def verdicts(hits: DataFrame) -> DataFrame:
    """The contamination rule: at least a twentieth of the words are hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return hits.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (all columns) that aren't contaminated.

    Rows with equal id and text share a verdict; the verdict table holds the
    contaminated rows alone, so it is far smaller than the documents.
    """
    bad = verdicts(scan(docs, benchmark, n, id_col=id_col, text_col=text_col)).where("contaminated").select(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")).distinct()
    return docs.join(bad.hint("merge"), F.col(id_col).eqNullSafe(F.col("__llm_id")) & (text_key(F.col(text_col)) == F.col("__llm_key")), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words and the characters between them cut out of the text."""
    hits = scan(docs, benchmark, n, id_col=id_col, text_col=text_col).where(F.size("spans") > 0)
    hits = hits.select(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key"), F.col("spans").alias("__llm_spans")).dropDuplicates(["__llm_id", "__llm_key"])
    joined = docs.join(hits, F.col(id_col).eqNullSafe(F.col("__llm_id")) & (text_key(F.col(text_col)) == F.col("__llm_key")), "left")
    cut = F.pandas_udf(_cut_spans, T.StringType())(F.col(text_col), F.col("__llm_spans"))
    return joined.withColumn(text_col, F.when(F.col("__llm_spans").isNull(), F.col(text_col)).otherwise(cut)).select(*docs.columns)


def _cut_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    def one(x: str | None, own: list | None) -> str | None:
        if x is None or own is None:
            return x
        data = np.frombuffer(x.encode(), dtype=np.uint8)
        words = _words(data, np.array([0, len(data)]))
        keep = np.ones(len(data), dtype=bool)
        for s in own:
            keep[words.start[s["first"]] : words.end[s["last"]]] = False
        return data[keep].tobytes().decode()

    return pd.Series([one(x, s) for x, s in zip(text, spans, strict=True)], dtype=object)
