"""Ranked lexical search by pipelined term partitioning.

Documents are split into blocks, items (queries) into bundles. The terms of the
items are dealt to owners by document frequency, rare ones first. A bundle
visits the owners in turn, once in each block: a stage cogroups the bundle,
which carries its items' terms and its sparse accumulators (item, document,
score so far), with the owner's postings in that block and adds integer
contributions. The last stage selects each item's best in the block, and the
best of all blocks are selected from those.

Accumulators are dropped only when they can't matter: the k-th best score so
far in a block is at most the k-th best final score, so a document whose score
plus the largest contributions of the owners still to come stays below it isn't
among the k best of its own block. The same bound keeps new documents out.

Memory is bounded by a block (``block_docs`` rows' postings of one owner) and a
bundle; hot terms and long documents are spread over blocks. Two scans tokenise
the texts: the first counts N, L and document frequencies, the second writes
the postings of the items' terms, one column pair an owner. Item terms are
looked up as 64-bit hashes, ``term_block`` of them at a time, so what tasks get
by broadcast is bounded whatever the number of items.

Defined cases: a null text has no terms; a row without terms isn't counted; each
row is a document of its own, so a repeated row is listed as often as it occurs;
a null id comes last among equal scores; rows that share an item id are one
item with the union of their terms; an item none of whose terms weighs anything
or occurs has no rows; other columns, whatever their names, are not read. The
documents must be a stored table (both scans number its rows alike).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_long, chunks, find_words, list_column, materialise, separators

#: Everything in ASCII but digits and letters.
TERM_BREAKS = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: An owner holds the terms found in a share of the documents from its bound to the next one's: one in ...
OWNER_BOUNDS = (1000, 100, 10)
OWNERS = len(OWNER_BOUNDS) + 1
MOST_IMPACT = 1_000_000_000


def _terms(data: np.ndarray, offsets: np.ndarray):
    capital = (data >= 65) & (data <= 90)
    words = find_words(np.where(capital, data + np.uint8(32), data), offsets, TERM_BREAKS)
    return words, as_long(words.hashes())


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in chunks(batch):
            words, hashes = _terms(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), list_column(hashes, words.first)], names=["item", "terms"])


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``item, term`` (hash)."""
    own = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    schema = T.StructType([own.schema["item"], T.StructField("terms", T.ArrayType(T.LongType()))])
    return own.mapInArrow(_item_terms, schema).select("item", F.explode("terms").alias("term")).distinct()


def _hits(words, hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, index in ``known`` (sorted) and number of occurrences of each known term of each row."""
    if not len(hashes) or not len(known):
        return (np.zeros(0, dtype=np.int64),) * 3
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[at] == hashes)
    pairs, tf = np.unique(words.row_of()[hit] * len(known) + at[hit], return_counts=True)
    return pairs // len(known), pairs % len(known), tf


def _counting(terms: object, totals: bool) -> Callable:
    """Per task: df, largest tf and least document length of each known term; N and L on a row without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        df, most, least = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64), np.full(len(known), np.iinfo(np.int64).max)
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch):
                words, hashes = _terms(data, offsets)
                n = np.diff(words.first)
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
                row, term, tf = _hits(words, hashes, known)
                np.add.at(df, term, 1)
                np.maximum.at(most, term, tf)
                np.minimum.at(least, term, n[row])
        seen = np.flatnonzero(df)
        columns = [known[seen], df[seen], most[seen], least[seen], np.zeros(len(seen), dtype=np.int64)]
        columns = [pa.array(c) for c in columns]
        if totals:
            last = [None, n_docs, None, None, n_terms]
            columns = [pa.concat_arrays([c, pa.array([v], type=pa.int64())]) for c, v in zip(columns, last, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "df", "most", "least", "n_terms"])

    return run


def _posting(terms: object) -> Callable:
    """Postings of known terms, a column pair (terms, tfs) for each owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, owner = terms.value
        for batch in batches:
            for i, j, data, offsets in chunks(batch):
                words, hashes = _terms(data, offsets)
                row, term, tf = _hits(words, hashes, known)
                columns = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(words.first))]
                for k in range(OWNERS):
                    own = np.flatnonzero(owner[term] == k) if len(term) else np.zeros(0, dtype=np.int64)
                    bounds = np.searchsorted(row[own], np.arange(j - i + 1))
                    columns += [list_column(known[term[own]], bounds), list_column(tf[own].astype(np.int64), bounds)]
                names = ["row", "doc_id", "n", *[f"{c}_{k}" for k in range(OWNERS) for c in ("terms", "tfs")]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (MOST_IMPACT * tf) // (1000 * tf + 8 * m)


class _Bundle:
    """A bundle's row as arrays: the items' terms, and accumulators over its documents."""

    def __init__(self, table: pa.Table):
        row = {name: table.column(name).combine_chunks()[0] for name in table.column_names}

        def arr(name: str) -> np.ndarray:
            return row[name].values.to_numpy(zero_copy_only=False)

        coded = row["q_item"].values.dictionary_encode(null_encoding="encode")
        self.items, self.item = coded.dictionary, coded.indices.to_numpy()
        self.term, self.w, self.bound, self.owner = arr("q_term"), arr("q_w"), arr("q_bound"), arr("q_owner")
        self.rows, self.ids = arr("rows"), row["ids"].values
        self.acc_item, self.acc_doc, self.acc_score = arr("acc_item"), arr("acc_doc"), arr("acc_score")

    def add(self, owner: int, postings: pa.Table, k: int) -> None:
        """Add the contributions of ``owner``'s postings; drop what can't be among the k best here."""
        if not postings.num_rows:  # a side without rows has no columns either
            return
        found = {c: postings.column(c).combine_chunks() for c in postings.column_names}
        new_rows = found["row"].to_numpy()
        every, first, local = np.unique(np.concatenate((self.rows, new_rows)), return_index=True, return_inverse=True)
        ids = pa.concat_arrays([self.ids, found["doc_id"]]).take(pa.array(first))
        old, new = local[: len(self.rows)], local[len(self.rows) :]
        lengths = np.diff(found["terms"].offsets.to_numpy())
        doc = np.repeat(new, lengths)
        impact = _impact(found["tfs"].flatten().to_numpy(), np.repeat(found["m"].to_numpy(), lengths))
        terms = found["terms"].flatten().to_numpy()
        order = np.argsort(terms, kind="stable")
        terms, doc, impact = terms[order], doc[order], impact[order]
        score = np.zeros(len(every), dtype=np.int64)
        item_at = np.searchsorted(self.acc_item, np.arange(len(self.items) + 1))
        out_item, out_doc, out_score = [], [], []
        query_order = np.argsort(self.item, kind="stable")
        query_at = np.searchsorted(self.item[query_order], np.arange(len(self.items) + 1))
        for i in range(len(self.items)):
            own = query_order[query_at[i] : query_at[i + 1]]
            to_come = int(self.bound[own][self.owner[own] > owner].sum())
            here = own[self.owner[own] == owner]
            score[:] = 0
            a, b = item_at[i], item_at[i + 1]
            score[old[self.acc_doc[a:b]]] = self.acc_score[a:b]
            # the k-th best so far bounds what a document without an accumulator must still be able to reach
            shut = b - a >= k and np.partition(self.acc_score[a:b], b - a - k)[b - a - k] > to_come + int(self.bound[here].sum())
            closed = score == 0 if shut else None
            starts, stops = np.searchsorted(terms, self.term[here]), np.searchsorted(terms, self.term[here], side="right")
            for x, s, e in zip(here.tolist(), starts.tolist(), stops.tolist(), strict=True):
                if e > s:
                    score[doc[s:e]] += self.w[x] * impact[s:e]
            if shut:
                score[closed] = 0
            live = np.flatnonzero(score)
            if len(live) > k:
                worth = np.partition(score[live], len(live) - k)[len(live) - k]
                live = live[score[live] + to_come >= worth]
            out_item.append(np.full(len(live), i, dtype=np.int32))
            out_doc.append(live)
            out_score.append(score[live])
        self.acc_item, doc_of, self.acc_score = np.concatenate(out_item), np.concatenate(out_doc), np.concatenate(out_score)
        used, self.acc_doc = np.unique(doc_of, return_inverse=True)
        self.rows, self.ids = every[used], ids.take(pa.array(used))

    def best(self, k: int) -> pa.Table:
        """The k best documents of each item in this block."""
        found = pa.table(
            {"item": self.items.take(pa.array(self.acc_item)), "doc_id": self.ids.take(pa.array(self.acc_doc)), "score": pa.array(self.acc_score), "at": pa.array(self.acc_item)}
        )
        found = found.take(pc.sort_indices(found, sort_keys=[("at", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end"))
        at = found.column("at").to_numpy()
        place = np.arange(len(at)) - np.searchsorted(at, at)
        return found.filter(pa.array(place < k)).select(["item", "doc_id", "score"])


def _list(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], type=pa.int32()), pa.array(values, type=kind))


def _stage(owner: int, k: int, schema: T.StructType) -> Callable:
    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        b = _Bundle(bundle)
        b.add(owner, postings, k)
        if owner == OWNERS - 1:
            return b.best(k)
        carried = {
            "rows": _list(b.rows, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(b.ids)], type=pa.int32()), b.ids),
            "acc_item": _list(b.acc_item, pa.int32()),
            "acc_doc": _list(b.acc_doc, pa.int32()),
            "acc_score": _list(b.acc_score, pa.int64()),
        }
        return pa.table({f.name: carried.get(f.name, bundle.column(f.name)) for f in schema})

    return run


def _with_owner(counts: DataFrame, n_docs: int, n_all: int) -> DataFrame:
    """``term, w, bound, owner`` of the terms that weigh anything."""
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    m = F.lit(10).cast("long") + F.expr(f"(90 * least * {n_docs}L) div {n_all}L")
    owner = sum((F.when(F.col("df") * bound >= n_docs, 1).otherwise(0) for bound in OWNER_BOUNDS), F.lit(0))
    most = F.expr("(1000000000L * most) div (1000 * most + 8 * m)")
    return counts.withColumn("m", m).select("term", w.alias("w"), (w * most).alias("bound"), owner.alias("owner")).where("w > 0")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_docs: int = 4096,
    bundle_terms: int = 1 << 15,
    bundle_items: int = 512,
    term_block: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 of each item."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = materialise(item_terms(items, item_col, item_text_col), "search-items")
    size = wanted.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct(F.struct("item")).alias("items"), F.countDistinct("term").alias("terms")).first()
    n_blocks = max(1, -(-size["terms"] // term_block))

    def known(k: int) -> np.ndarray:
        own = wanted.select("term").distinct().where(F.pmod("term", F.lit(n_blocks)) == k)
        return np.sort(own.toArrow().column(0).to_numpy().astype(np.int64))

    ddl = "term long, df long, most long, least long, n_terms long"
    counted = None
    for b in range(n_blocks):
        part = base.select("text").mapInArrow(_counting(sc.broadcast(known(b)), b == 0), ddl)
        counted = part if counted is None else counted.unionByName(part)
    counts = counted.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"), F.min("least").alias("least"), F.sum("n_terms").alias("n_terms"))
    counts = materialise(counts, "search-counts")
    totals = counts.where("term is null").first()
    n_docs, n_all = (totals["df"], totals["n_terms"]) if totals else (0, 0)
    empty = spark.createDataFrame([], T.StructType([T.StructField("item_id", wanted.schema["item"].dataType), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", base.schema["doc_id"].dataType), T.StructField("score", T.LongType())]))
    if not n_docs:
        return empty
    weights = _with_owner(counts.where("term is not null"), n_docs, n_all)

    # the second scan: postings of the weighing terms, by owner
    pairs = [T.StructField(f"{c}_{o}", T.ArrayType(T.LongType())) for o in range(OWNERS) for c in ("terms", "tfs")]
    schema = T.StructType([base.schema["row"], base.schema["doc_id"], T.StructField("n", T.LongType()), *pairs])
    postings = None
    for b in range(n_blocks):
        own = weights.where(F.pmod("term", F.lit(n_blocks)) == b).select("term", "owner").toArrow().sort_by("term")
        lookup = sc.broadcast((own.column("term").to_numpy(), own.column("owner").to_numpy().astype(np.int8)))
        part = base.mapInArrow(_posting(lookup), schema)
        postings = part if postings is None else postings.unionByName(part)
    blocks = max(1, -(-n_docs // block_docs))
    any_hit = " or ".join(f"size(terms_{o}) > 0" for o in range(OWNERS))
    postings = postings.where(any_hit).withColumn("m", F.expr(f"10 + (90 * n * {n_docs}L) div {n_all}L")).drop("n")
    postings = materialise(postings.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "search-postings")

    # bundles of items, each once a block, with no accumulators yet
    bundles = max(1, -(-size["pairs"] // bundle_terms), -(-size["items"] // bundle_items))
    query = wanted.join(weights, "term").withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    query = query.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item", "term", "w", "bound", "owner"))).alias("q"))
    query = query.select("bundle", *[F.col(f"q.{c}").alias(f"q_{c}") for c in ("item", "term", "w", "bound", "owner")])
    none = {"rows": "array<bigint>", "ids": T.ArrayType(base.schema["doc_id"].dataType).simpleString(), "acc_item": "array<int>", "acc_doc": "array<int>", "acc_score": "array<bigint>"}
    carried = query.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "*", *[F.expr(f"cast(array() as {t})").alias(c) for c, t in none.items()])
    best = T.StructType([T.StructField("item", wanted.schema["item"].dataType), T.StructField("doc_id", base.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    for o in range(OWNERS):
        own = postings.select("block", "row", "doc_id", "m", F.col(f"terms_{o}").alias("terms"), F.col(f"tfs_{o}").alias("tfs")).where("size(terms) > 0")
        own = own.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))
        out = best if o == OWNERS - 1 else carried.schema
        # a bundle hash that no item has leaves postings without a bundle
        carried = carried.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block")).applyInArrow(_only_bundles(_stage(o, k, out), out), out)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = carried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def _only_bundles(stage: Callable, schema: T.StructType) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema

    nothing = to_arrow_schema(schema).empty_table()

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        return stage(bundle, postings) if bundle.num_rows else nothing

    return run
