"""Near-duplicate classes by ProbMinHash over weighted word shingles.

A document is the multiset of its five-word shingles; a shingle's weight is how
often it occurs. Each shingle is a Poisson process with its weight as rate;
arrivals fall on one of ``registers`` registers, which keep the earliest. A
shingle stops once its next arrival is later than every register of the
document. Two registers agree with probability J_P, the probability Jaccard
similarity, so bands of registers find candidates, which are verified with the
exact J_P of the two multisets. For shingles that occur once, J_P is Jaccard.

No bucket is expanded into all pairs. Texts that are equal are one node. In
each bucket the most central member (the one that meets most others in all its
buckets) is compared with the rest, so a bucket costs one comparison a member.
Nodes of a bucket that then still holds several classes are signed again with
more registers and longer bands, whose smaller buckets have centres of their
own. The nodes of first buckets that are divided even then get an exact join:
every two of them in different classes that can be similar share one of their
rarest shingles (see ``_rare_links``); those whose sketches agree are verified. Classes
are the connected components of the verified links. A link is missed only if
its two ends share none of the first buckets, one in 5,000 at similarity 0.8.

Defined cases: a null text is alone; a text without words is like those equal
to it alone; one of under five words is a single shingle; rows of one id are one document,
so its different texts join their classes; a null id has a null class. Equal
texts are told by a 64-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import SPACE_TABLE, chunks, discard, find_words, lean, list_column, materialise, mix, window_hash, Words
from .components import connected_components, merge_labels

SHINGLE = 5
REGISTERS = 64
BAND = 4
#: Registers and band length for nodes of buckets that the first bands leave divided.
FINER = ((384, 8), (1024, 16))
_ID_BITS = np.uint64(48)
_ID_MASK = np.uint64((1 << 48) - 1)
#: A pair of a first or finer bucket is verified if this share of registers agrees; at similarity 0.8 fewer than one in 10**11 pairs has fewer.
_LIKELY = 0.4
#: Registers of the sketch by which nodes that share a rare shingle are compared.
SKETCH = 512
#: A block of the exact join has about so many nodes outside the shingle's largest class, and four times as many of all.
_SALT_ROWS = 512
#: A block that verifies has at most about so many shingles outside the largest class, and four times as many of all.
_SALT_IDS = 1 << 20


def shingles(words: Words, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 48-bit id and weight of each distinct shingle, ordered by row and id."""
    h = words.hashes()
    n = np.diff(words.first)
    pos, w = words.windows(h, length)
    row = words.row_of()
    rows, ids = [row[pos]], [w]
    for short in range(1, length):
        own = np.flatnonzero(n == short)
        if len(own):
            at = words.first[own]
            rows.append(own)
            ids.append(window_hash(h, short)[at] ^ np.uint64(short))
    key = (np.concatenate(rows).astype(np.uint64) << _ID_BITS) | (np.concatenate(ids) & _ID_MASK)
    key.sort()
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    weight = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> _ID_BITS).astype(np.int64), key & _ID_MASK, weight


def signatures(row: np.ndarray, ids: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (the winning shingle's id) of each row; ``n_rows x registers``."""
    best = np.full(n_rows * registers, np.inf)
    seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive = np.arange(len(row))
    at = np.zeros(len(row))
    arrival = 0
    while len(alive):
        arrival += 1
        own = mix(ids[alive] + np.uint64(arrival * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u = ((own >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = at - np.log(u) / weight[alive]
        slot = row[alive] * registers + (mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
        hit = at < best[slot]
        np.minimum.at(best, slot[hit], at[hit])
        seen.append((slot[hit], at[hit], ids[alive][hit]))
        latest = best.reshape(n_rows, registers).max(axis=1)
        go = at < latest[row[alive]]
        alive, at = alive[go], at[go]
    out = np.zeros(n_rows * registers, dtype=np.uint64)
    for slot, t, who in seen:
        won = best[slot] == t
        out[slot[won]] = who[won]
    return out.reshape(n_rows, registers)


def _sign(registers: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch):
                words = find_words(data, offsets, SPACE_TABLE)
                row, ids, weight = shingles(words)
                sig = signatures(row, ids, weight, j - i, registers)
                some = np.diff(words.first) > 0
                acc = _bands(sig, band)
                bands = acc.shape[1]
                bounds = np.concatenate(([0], np.cumsum(some)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(i, j - i) for k in range(2)],
                        list_column(acc[some].view(np.int64).ravel(), bounds * bands),
                        list_column((sig[some] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32).ravel(), bounds * registers),
                    ],
                    names=["doc_id", "k1", "bands", "sig"],
                )

    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in chunks(batch):
            row, ids, weight = shingles(find_words(data, offsets, SPACE_TABLE))
            bounds = np.searchsorted(row, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), list_column(ids.view(np.int64), bounds), list_column(weight.astype(np.int32), bounds)],
                names=["node", "ids", "weights"],
            )


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact J_P of two multisets: sorted ids ``a, b`` with weights ``x, y``."""
    every = np.union1d(a, b)
    if not len(every):
        return 0.0
    p = np.zeros(len(every))
    q = np.zeros(len(every))
    p[np.searchsorted(every, a)] = x
    q[np.searchsorted(every, b)] = y
    both = (p > 0) & (q > 0)
    with np.errstate(divide="ignore"):
        ratio = p / q
    order = np.argsort(ratio, kind="stable")
    below = np.concatenate(([0.0], np.cumsum(q[order])))  # where the ratio is smaller, the second weight counts
    above = np.concatenate((np.cumsum(p[order][::-1])[::-1], [0.0]))
    cut = np.searchsorted(ratio[order], ratio[both], side="left")
    return float((1.0 / (above[cut] / p[both] + below[cut] / q[both])).sum())


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = [batch.column(batch.schema.get_field_index(c)) for c in ("ia", "wa", "ib", "wb")]
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in get]
            offs = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in get]
            keep = []
            for r in range(batch.num_rows):
                own = [f[o[r] : o[r + 1]] for f, o in zip(flat, offs, strict=True)]
                keep.append(probability_jaccard(*own) >= threshold - 1e-12)
            mask = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])

    return run


def _links(pairs: DataFrame, nodes: DataFrame, content: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` whose exact similarity reaches ``threshold``."""
    pairs = materialise(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")
    a = nodes.select(F.col("node").alias("u"), F.col("sig").alias("sa"))
    b = nodes.select(F.col("node").alias("v"), F.col("sig").alias("sb"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    likely = materialise(pairs.join(a, "u").join(b, "v").where(agree >= _LIKELY * F.size("sa")).select("u", "v"), "likely")
    return _verified(likely, content, threshold)


def _verified(pairs: DataFrame, content: DataFrame, threshold: float) -> DataFrame:
    kind = pairs.schema["u"].dataType.simpleString()
    a = content.select(F.col("node").alias("u"), F.col("ids").alias("ia"), F.col("weights").alias("wa"))
    b = content.select(F.col("node").alias("v"), F.col("ids").alias("ib"), F.col("weights").alias("wb"))
    joined = pairs.join(a.hint("merge"), "u").join(b.hint("merge"), "v").select("u", "v", "ia", "wa", "ib", "wb")
    return materialise(joined.mapInArrow(lean(_verify(threshold)), f"u {kind}, v {kind}"), "links")


def _sign_content(registers: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids, weights = part.column(1), part.column(2)
                size = np.diff(ids.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), size)
                flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (ids, weights)]
                sig = signatures(row, flat[0].astype(np.int64).view(np.uint64), flat[1], part.num_rows, registers)
                bands = _bands(sig, band)
                bounds = np.arange(part.num_rows + 1) * bands.shape[1]
                yield pa.RecordBatch.from_arrays([part.column(0), list_column(bands.view(np.int64).ravel(), bounds)], names=["node", "bands"])

    return run


def _bands(sig: np.ndarray, band: int) -> np.ndarray:
    n = sig.shape[1] // band
    acc = np.broadcast_to(mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(band << 32)), (len(sig), n)).copy()
    for k in range(band):
        acc = mix(acc ^ sig[:, k::band][:, :n])
    return acc


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``bucket, node`` rows with the node's class so far."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))


def _star(banded: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that hold several classes, and the pairs of each with its bucket's most central node.

    A node's centrality is the number of nodes it meets in all its buckets.
    """
    rows = _labelled(banded.select("node", F.explode("bands").alias("bucket")), labels)
    sizes = materialise(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket", "size"), "sizes")
    shared = materialise(rows.join(sizes, "bucket"), "shared")
    score = materialise(shared.groupBy("node").agg(F.sum("size").alias("score")), "score")
    ranked = materialise(shared.join(score, "node"), "ranked")
    centre = materialise(ranked.groupBy("bucket").agg(F.max(F.struct("score", "node", "label")).alias("centre")), "centre")
    pairs = ranked.join(centre, "bucket").where("label <> centre.label").select(F.col("node").alias("u"), F.col("centre.node").alias("v"))
    return ranked.select("bucket", "node", "size"), pairs


def _open_nodes(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes of buckets of three or more that still hold several classes."""
    now = _labelled(members.where("size > 2").select("bucket", "node"), labels)
    split = materialise(now.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket"), "split")
    return materialise(members.join(split, "bucket").select("node").distinct(), "open")


def _rare_links(content: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Links ``u, v`` of nodes in different classes, by which all pairs that reach ``threshold`` are joined.

    Shingles that hold the shares ``a`` and ``b`` of two nodes' weights in
    common bound J_P by ``1 / (1 / a + 1 / b - 1)``. In one order of all
    shingles, rarest first, the first common one has at most ``1 - a`` and
    ``1 - b`` of the nodes' weights before it; a pair meets there if these
    shares allow the threshold. The largest class of a shingle's nodes is not
    compared with itself, and the nodes of a frequent shingle are dealt out in
    blocks. A block compares its nodes' sketches in arrays and gives the nodes
    that have a likely partner; these meet once more with their shingles, are
    verified there, and give links. Pairs just below the threshold, whose number
    grows with the square of a group, are never rows.
    """
    rows = content.select("node", F.explode(F.arrays_zip("ids", "weights")).alias("s")).select("node", F.col("s.ids").alias("id"), F.col("s.weights").alias("weight"))
    often = materialise(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    order = Window.partitionBy("node").orderBy("n", "id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.join(often.hint("merge"), "id", "left").withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
    before = F.coalesce(F.sum("weight").over(order), F.lit(0).cast("long"))
    # a sum over the node's rows: as an expression on its array it would be worked out anew for each of them
    total = F.sum("weight").over(Window.partitionBy("node"))
    ranked = ranked.select("id", "node", "n", (total / (total - before)).alias("reach"))
    most = 1 + 1 / threshold + 1e-9
    prefix = ranked.where((F.col("n") > 1) & (F.col("reach") <= most - 1)).select("id", "node", "reach")
    prefix = materialise(prefix.join(labels.hint("merge"), "node", "left").select("id", "node", "reach", F.coalesce("label", "node").alias("label")), "prefix")
    held = prefix.groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = held.groupBy("id").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("held")).where("held > 1")
    few_parts, parts = F.expr(f"cast((size - main.n) div {_SALT_ROWS} as int) + 1"), F.expr(f"cast(size div {4 * _SALT_ROWS} as int) + 1")
    mixed = materialise(mixed.select("id", F.col("main.label").alias("main"), few_parts.alias("few_parts"), parts.alias("parts")), "mixed")
    shared = materialise(prefix.join(mixed.hint("merge"), "id").drop("reach"), "shared_prefix")
    # each node with its own shared prefix and a sketch, so that a task tells likely pairs without their shingles
    sketches = content.mapInArrow(lean(_sketch), f"node {content.schema['node'].dataType.simpleString()}, sketch binary")
    own = shared.groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("own")).join(sketches.hint("merge"), "node")
    rows = materialise(shared.join(own.hint("merge"), "node"), "sketched")
    node = content.schema["node"].dataType
    meeting = T.StructType([T.StructField("id", T.LongType()), T.StructField("node", node), T.StructField("few", T.BooleanType())])
    met = materialise(_blocks(rows.where("label <> main"), _again(rows)).applyInArrow(_meeting_in_block(threshold, meeting), meeting).distinct(), "met")
    # the nodes that met a likely one come with their shingles, and are verified where they meet
    size = met.join(content.select("node", F.size("ids").alias("size")).hint("merge"), "node")
    side = [F.when(F.col("few") == flag, F.col("size")) for flag in (True, False)]
    split = size.groupBy("id").agg(_parts(side[0], 1).alias("few_parts"), _parts(side[1], 4).alias("parts"))
    near = rows.drop("few_parts", "parts").join(met.hint("merge"), ["id", "node"]).join(split.hint("merge"), "id").join(content.hint("merge"), "node")
    near = materialise(near, "near")
    link = T.StructType([T.StructField(c, node) for c in "uv"])
    blocks = _blocks(near.where("few"), _again(near).where("not few"), "ids", "weights")
    return materialise(blocks.applyInArrow(_links_in_block(threshold, link), link).distinct(), "rare_links")


def _again(table: DataFrame) -> DataFrame:
    """A stored table read apart, so that the two sides of a grouping don't share column identities."""
    return table.sparkSession.read.schema(table.schema).parquet(table.scratch_path)


def _parts(size: Column, more: int) -> Column:
    """How many parts one side of a block is dealt into, by its rows and their shingles; ``size`` is null for others."""
    ids = F.coalesce(F.sum(size), F.lit(0).cast("long"))
    return F.greatest(F.floor(F.count(size) / (more * _SALT_ROWS)), F.floor(ids / (more * _SALT_IDS))).cast("int") + 1


def _blocks(few: DataFrame, every: DataFrame, *more: str):
    """A shingle's nodes outside its largest class (``few``) and ``every`` node of it, grouped together block by block."""
    few = few.withColumn("few_part", F.pmod(F.hash("node"), F.col("few_parts"))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    every = every.withColumn("part", F.pmod(F.hash("node"), F.col("parts"))).withColumn("few_part", F.explode(F.sequence(F.lit(0), F.col("few_parts") - 1)))
    columns = ["id", "few_part", "part", "node", "label", "main", "own", "sketch", *more]
    return few.select(columns).groupBy("id", "few_part", "part").cogroup(every.select(columns).groupBy("id", "few_part", "part"))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each of ``SKETCH`` registers."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            ids, weights = part.column(1), part.column(2)
            row = np.repeat(np.arange(part.num_rows), np.diff(ids.offsets.to_numpy()))
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (ids, weights)]
            sig = signatures(row, flat[0].astype(np.int64).view(np.uint64), flat[1], part.num_rows, SKETCH).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in sig], type=pa.binary())], names=["node", "sketch"])


class _Block:
    """Both sides of a block, and the pairs in different classes whose sketches agree as those of similar nodes do.

    At the threshold, the share of equal registers is below the cut (six
    standard deviations less) for one pair in 10**9. A pair that shares
    several shingles is given by the smallest of them alone.
    """

    def __init__(self, few: pa.Table, every: pa.Table, threshold: float):
        self.cut = (threshold - 6 * (threshold * (1 - threshold) / SKETCH) ** 0.5) * SKETCH
        self.few, self.every = few, every
        self.shingle = few.column("id")[0].as_py()
        self.u, self.v = few.column("node").combine_chunks(), every.column("node").combine_chunks()
        self.label_u, self.label_v = few.column("label").to_pylist(), every.column("label").to_pylist()

    def alike(self) -> Iterator[tuple[int, list[int]]]:
        """The places of each node of ``few`` and of its likely partners in ``every``."""
        sketch = np.frombuffer(b"".join(self.every.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(self.v), SKETCH)
        of_main = [x == y for x, y in zip(self.label_v, self.every.column("main").to_pylist(), strict=True)]
        own_u, own_v = self.few.column("own").combine_chunks(), self.every.column("own").combine_chunks()
        nodes_u, nodes_v = self.u.to_pylist(), self.v.to_pylist()
        for i, mine in enumerate(self.few.column("sketch").to_pylist()):
            likely = np.flatnonzero((sketch == np.frombuffer(mine, dtype=np.uint8)).sum(axis=1) >= self.cut).tolist()
            # two nodes outside the main class meet twice: once is enough
            likely = [j for j in likely if self.label_v[j] != self.label_u[i] and (of_main[j] or nodes_u[i] < nodes_v[j])]
            if likely:
                own = own_u[i].values.to_numpy()
                yield i, [j for j in likely if np.intersect1d(own, own_v[j].values.to_numpy(), assume_unique=True)[0] == self.shingle]


def _meeting_in_block(threshold: float, kind: T.StructType):
    """The nodes of a block that have a likely partner in it, for each side; rows at most as many as the block's."""
    schema = to_arrow_schema(kind)

    def run(few: pa.Table, every: pa.Table) -> pa.Table:
        # a side without rows has no columns either
        if not few.num_rows or not every.num_rows:
            return schema.empty_table()
        block = _Block(few, every, threshold)
        left, right = [], set()
        for i, partners in block.alike():
            if partners:
                left.append(i)
                right.update(partners)
        nodes = pa.concat_arrays([block.u.take(pa.array(left, type=pa.int64())), block.v.take(pa.array(sorted(right), type=pa.int64()))])
        return pa.table([pa.array([block.shingle] * len(nodes), type=pa.int64()), nodes, pa.array([True] * len(left) + [False] * len(right), type=pa.bool_())], schema=schema)

    return run


def _links_in_block(threshold: float, kind: T.StructType):
    """Pairs of a block whose exact similarity reaches the threshold, but none between nodes that the block's pairs join already."""
    schema = to_arrow_schema(kind)

    def run(few: pa.Table, every: pa.Table) -> pa.Table:
        if not few.num_rows or not every.num_rows:
            return schema.empty_table()
        block = _Block(few, every, threshold)
        ids_u, weights_u, ids_v, weights_v = (_lists(t.column(c)) for t in (few, every) for c in ("ids", "weights"))
        joined: dict = {}

        def top(label):
            while label in joined:
                label = joined[label]
            return label

        picked_u: list[int] = []
        picked_v: list[int] = []
        for i, partners in block.alike():
            for j in partners:
                a, b = top(block.label_u[i]), top(block.label_v[j])
                if a != b and probability_jaccard(ids_u[i], weights_u[i], ids_v[j], weights_v[j]) >= threshold - 1e-12:
                    joined[max(a, b)] = min(a, b)
                    picked_u.append(i)
                    picked_v.append(j)
        return pa.table([block.u.take(pa.array(picked_u, type=pa.int64())), block.v.take(pa.array(picked_v, type=pa.int64()))], schema=schema)

    return run


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The values of each row of a list column."""
    flat, offsets = [], [0]
    for chunk in column.chunks:
        flat.append(chunk.flatten().to_numpy(zero_copy_only=False))
        offsets.extend((np.diff(chunk.offsets.to_numpy()).cumsum() + offsets[-1]).tolist())
    whole = np.concatenate(flat)
    return [whole[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def classes(docs: DataFrame, threshold: float = 0.8, registers: int = REGISTERS, band: int = BAND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id``: the smallest id of the document's near-duplicate class; a row for each row of ``docs``."""
    text: Column = F.col(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.when(text.isNotNull(), F.xxhash64(text)).alias("k1"), text.alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    signed = materialise(base.mapInArrow(lean(_sign(registers, band)), f"doc_id {kind}, k1 long, bands array<long>, sig array<int>"), "signed")

    # a node is a distinct text, known by its digest; ``first`` is the smallest id that has it
    present = signed.where(F.col("doc_id").isNotNull() & F.col("k1").isNotNull())
    equal = materialise(present.groupBy(F.col("k1").alias("node")).agg(F.min("doc_id").alias("first")), "equal")
    own = materialise(present.select("doc_id", F.col("k1").alias("node")).join(equal, "node").select("doc_id", "node", "first").distinct(), "own")
    of_first = (F.col("doc_id") == F.col("first")) & (F.col("k1") == F.col("node"))
    nodes = materialise(signed.join(equal.hint("merge"), of_first).select("node", "bands", "sig").dropDuplicates(["node"]), "nodes")
    discard(signed)

    members, pairs = _star(nodes, None)
    first = members
    used = members.select("node").distinct().join(equal, "node")
    content = base.select("doc_id", "k1", "text").join(used.hint("merge"), of_first).select("node", "text").dropDuplicates(["node"])
    content = materialise(content.mapInArrow(lean(_shingle_rows), "node long, ids array<long>, weights array<int>"), "content")
    labels = connected_components(_links(pairs, nodes, content, threshold))
    for finer_registers, finer_band in FINER:
        left = _open_nodes(members, labels)
        if left.isEmpty():
            break
        finer = content.join(left, "node", "left_semi").mapInArrow(lean(_sign_content(finer_registers, finer_band)), "node long, bands array<long>")
        members, pairs = _star(materialise(finer, "finer"), labels)
        links = _links(pairs, nodes, content, threshold)
        if not links.isEmpty():
            labels = merge_labels(labels, links)
    left = _open_nodes(first, labels)
    if not left.isEmpty():
        rest = materialise(content.join(left.hint("merge"), "node", "left_semi"), "rest")
        links = _rare_links(rest, labels, threshold)
        if not links.isEmpty():
            labels = merge_labels(labels, links)

    # rows of one id are one document, so its texts are in one class
    several = materialise(own.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v <> most").select("doc_id", "v"), "several")
    if not several.isEmpty():
        labels = merge_labels(labels, own.join(several.hint("merge"), "doc_id").where("node <> v").select(F.col("node").alias("u"), "v"))
    named = labels.join(equal.hint("merge"), "node").select("node", "label", "first")
    least = materialise(named.groupBy("label").agg(F.min("first").alias("class_id")), "least")
    by_node = materialise(labels.join(least.hint("merge"), "label").select("node", "class_id"), "by_node")
    full = own.join(by_node.hint("merge"), "node", "left").select("doc_id", F.coalesce("class_id", "first").alias("class_id"))
    full = materialise(full.groupBy("doc_id").agg(F.min("class_id").alias("class_id")), "classes")
    discard(equal, own, nodes, content, several, least, by_node)
    return docs.select(F.col(id_col).alias("doc_id")).join(full, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (all columns) whose id is the smallest of its class; null ids stay."""
    gone = classes(docs, threshold, id_col=id_col, text_col=text_col).where("doc_id <> class_id").select(F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(gone.hint("merge"), F.col(id_col) == F.col("__llm_id"), "left_anti")
