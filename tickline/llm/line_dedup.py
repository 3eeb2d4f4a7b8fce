"""Line dedup by a segment-partition edit join.

Equal lines are one entry. An entry of ``l`` characters may differ from a line
at most as long as it by ``min(max_edits, l // chars_per_edit)`` edits, where
``l`` is the shorter length; shorter lines match exactly only. The shorter line
is split into threshold-plus-one even segments, of which one must survive any
allowed edits. The longer line probes with the substrings of its own that can
align with a segment of a line 0, 1, ... edits shorter: the key holds segment
number, line length and content, so only fitting lengths meet. Lines that meet
are candidates if the parities of their character pairs differ in as few bits
as the allowed edits can flip. Candidates are verified with banded bit-parallel edit distance: the band's vertical deltas are
bits of one word, and all pairs of a batch advance column by column together.

A line is removed when the same text, or one linked to it, occurs earlier, by
document id and line number; decisions look at the input, not at what is left.
A line is trimmed of blanks and tabs before it is compared. Lines without a
word stay.

Defined cases: a null text has no lines and stays null; a null id neither
removes nor loses lines; rows of one id are one document, so the same line at
the same place of two such rows counts once; repeated rows give one row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, discard, lean, materialise, mix, powers, text_key

MAX_EDITS = 2
CHARS_PER_EDIT = 20
_BLANKS = " \t\n\x0b\x0c\r"
_STEP = np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)))


class _Chars:
    """Code points of a chunk of lines, with hashes of any substring."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        self.start = starts[offsets[:-1]]
        self.size = np.diff(starts[offsets])
        vals = mix(self.codes.astype(np.uint64) + np.uint64(0x51ED27)) * powers(_STEP, len(self.codes))[: len(self.codes)]
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(vals, dtype=np.uint64)))
        self.back = powers(_BACK, len(self.codes) + 1)

    def bigram_parities(self) -> np.ndarray:
        """64 bits a line: of each hashed class of character pairs, whether their number is odd.

        A substitution changes two pairs into two others, an insertion or
        deletion changes three at most, so an edit flips at most four bits.
        """
        out = np.zeros(len(self.start), dtype=np.uint64)
        if len(self.codes) < 2:
            return out
        pair = self.codes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ self.codes[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        bits = np.uint64(1) << ((pair * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(58))
        some = np.flatnonzero(self.size > 0)
        last = self.start[some] + self.size[some] - 1
        bits = np.append(bits, np.uint64(0))
        bits[last] = 0  # no pair across lines
        out[some] = np.bitwise_xor.reduceat(bits, self.start[some])
        return out

    def substring(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]


def _allowed(length: np.ndarray, max_edits: int, chars_per_edit: int) -> np.ndarray:
    return np.minimum(max_edits, length // chars_per_edit)


def _segment(length: np.ndarray, edits: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment ``i`` of ``edits + 1`` even ones; the last ones are longer by one."""
    base, extra = length // (edits + 1), length % (edits + 1)
    short = edits + 1 - extra
    return i * base + np.maximum(0, i - short), base + (i >= short)


def _key(content: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    return mix(content ^ mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(i + 1)))


def _keys(probe: bool, max_edits: int, chars_per_edit: int):
    """Index keys of the lines' own segments, or probe keys for lines that may be shorter."""

    def emit(chars: _Chars) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for shorter in range(max_edits + 1) if probe else (0,):
            length = chars.size - shorter
            allowed = _allowed(length, max_edits, chars_per_edit)
            for edits in range(max(shorter, 1), max_edits + 1):
                own = np.flatnonzero(allowed == edits)
                if not len(own):
                    continue
                for i in range(edits + 1):
                    at, size = _segment(length[own], edits, i)
                    low, high = (max(-i, shorter - (edits - i)), min(i, shorter + edits - i)) if probe else (0, 0)
                    for move in range(low, high + 1):
                        where = at + move
                        fits = (where >= 0) & (where + size <= chars.size[own])
                        who = own[fits]
                        content = chars.substring(chars.start[who] + where[fits], size[fits])
                        yield who, _key(content, length[who], i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch, "line"):
                chars = _Chars(data, offsets)
                found = list(emit(chars))
                if not found:
                    continue
                who = np.concatenate([w for w, _ in found])
                key = np.concatenate([k for _, k in found])
                ids = batch.column(0).slice(i, j - i)
                parity = chars.bigram_parities()[who].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids.take(pa.array(who)), pa.array(parity)], names=["key", "probe_id", "probe_parity"] if probe else ["key", "line_id", "parity"])

    return run


def banded_distance(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], most: int) -> np.ndarray:
    """Edit distances of pairs, all at once; over ``most`` they are only known to be larger.

    ``a`` and ``b`` are code points, starts and sizes; in each pair ``a`` is at
    most as long as ``b`` and at most ``most`` shorter. Bit ``c`` of a word is
    row ``column - most + c`` of the distance matrix.
    """
    (s, s0, m), (t, t0, n) = a, b
    width = 2 * most + 1
    full = np.uint64((1 << width) - 1)
    one = np.uint64(1)
    out = np.full(len(m), most + 1, dtype=np.int64)
    live = np.arange(len(m))
    vp = np.full(len(m), ((1 << (most + 1)) - 1) << most, dtype=np.uint64)
    vn = np.zeros(len(m), dtype=np.uint64)
    score = np.full(len(m), most, dtype=np.int64)  # of the band's lowest row, then of the last row
    # a pattern shorter than the band starts at its last row
    score = np.minimum(score, m)
    column = 0
    done = n == 0
    out[done] = m[done]
    keep = ~done
    while True:
        live, vp, vn, score = live[keep], vp[keep], vn[keep], score[keep]
        if not len(live):
            return out
        column += 1
        lm, ln = m[live], n[live]
        char = t[t0[live] + column - 1]
        match = np.zeros(len(live), dtype=np.uint64)
        for c in range(width):
            row = column - most + c  # 1-based
            inside = (row >= 1) & (row <= lm)
            at = np.where(inside, s0[live] + row - 1, 0)
            match |= (inside & (s[at] == char)).astype(np.uint64) << np.uint64(c)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        diagonal = column + most <= lm
        bit = np.clip(lm - column + most, 0, width - 1).astype(np.uint64)
        flat = ((hp >> bit) & one).astype(np.int64) - ((hn >> bit) & one).astype(np.int64)
        slope = 1 - ((d0 >> np.uint64(2 * most)) & one).astype(np.int64)
        score = score + np.where(diagonal, slope, flat)
        x = d0 >> one
        vp = (hn | ~(x | hp)) & full
        vn = hp & x
        done = column == ln
        out[live[done]] = np.minimum(score[done], most + 1)
        # along a diagonal distances don't fall, and the last cell's is at most 2 * most away
        keep = ~done & (score <= 3 * most)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = column.to_pylist()
    size = np.array([len(x) for x in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return (codes if len(codes) else np.zeros(1, dtype=np.uint32)), np.concatenate(([0], np.cumsum(size)[:-1])), size


def _verify(max_edits: int, chars_per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                a, b = _codes(part.column(2)), _codes(part.column(3))
                distance = banded_distance(a, b, max_edits)
                ok = pa.array(distance <= _allowed(a[2], max_edits, chars_per_edit))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(ok), part.column(1).filter(ok), pa.array(distance.astype(np.int32)).filter(ok)], names=["a", "b", "distance"])

    return run


def edit_join(lines: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Links ``a, b, distance`` between different lines of ``lines`` (``line_id`` long, ``line``, both distinct).

    Each link comes once, the shorter line first (of equal ones the smaller id).
    """
    narrow = lines.select("line_id", "line").where(F.length("line") >= chars_per_edit)
    index = narrow.mapInArrow(lean(_keys(False, max_edits, chars_per_edit)), "key long, line_id long, parity long")
    probe = narrow.mapInArrow(lean(_keys(True, max_edits, chars_per_edit)), "key long, probe_id long, probe_parity long")
    near = F.bit_count(F.col("parity").bitwiseXOR(F.col("probe_parity"))) <= 4 * max_edits
    pairs = index.join(probe, (index["key"] == probe["key"]) & (F.col("line_id") != F.col("probe_id")) & near)
    pairs = materialise(pairs.select(F.least("line_id", "probe_id").alias("a"), F.greatest("line_id", "probe_id").alias("b")).distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("line_id")).unionByName(pairs.select(F.col("b").alias("line_id"))).distinct()
    used = materialise(narrow.join(ids.hint("merge"), "line_id", "left_semi"), "used")
    left = used.select(F.col("line_id").alias("a"), F.col("line").alias("la"))
    right = used.select(F.col("line_id").alias("b"), F.col("line").alias("lb"))
    both = pairs.join(left, "a").join(right, "b")
    turn = F.length("la") > F.length("lb")
    both = both.where(F.abs(F.length("la") - F.length("lb")) <= max_edits)
    both = both.select(
        F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.when(turn, F.col("lb")).otherwise(F.col("la")).alias("la"),
        F.when(turn, F.col("la")).otherwise(F.col("lb")).alias("lb"),
    )
    links = materialise(both.mapInArrow(lean(_verify(max_edits, chars_per_edit)), "a long, b long, distance int"), "links")
    discard(pairs, used)
    return links


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, _, _ in chunks(batch):
            part = batch.slice(i, j - i)
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            gone = part.column(part.schema.get_field_index("gone")).to_pylist()
            n, kept = [], []
            for text, own in zip(texts, gone, strict=True):
                lines = [] if text is None else text.split("\n")
                n.append(sum(1 for x in lines if x.strip(_BLANKS)))
                if own:
                    out = set(own)
                    text = "\n".join(x for k, x in enumerate(lines) if k not in out)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(n, type=pa.int64()),
                    pa.array([len(x or ()) for x in gone], type=pa.int64()),
                    pa.array([hashlib.sha256((x or "").encode()).hexdigest() for x in kept]),
                    pa.array(kept, type=pa.string()),
                ],
                names=["doc_id", "text_key", "n_lines", "n_removed", "kept_sha256", "kept_text"],
            )


def _line_rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    text = F.col(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))
    rows = base.where(F.col("doc_id").isNotNull()).select("doc_id", "text_key", F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
    return base, rows.where("line <> ''")


def removed_lines(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stored tables of the lines to remove (``doc_id, text_key, line_no``) and of link counts by document.

    A document's links are those of the distinct lines that first occur in it.
    """
    _, rows = _line_rows(docs, id_col, text_col)
    first = rows.groupBy("line").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("n"))
    lines = materialise(first.select(F.monotonically_increasing_id().alias("line_id"), "line", "first", "n"), "lines")
    links = edit_join(lines, max_edits, chars_per_edit)
    ends = links.select(F.col("a").alias("line_id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("line_id"), F.col("a").alias("other")))
    small = lines.select("line_id", "first")
    linked = materialise(links.select(F.col("a").alias("line_id")).unionByName(links.select(F.col("b").alias("line_id"))).distinct(), "linked")
    firsts = materialise(small.join(linked.hint("merge"), "line_id"), "firsts")
    other = firsts.select(F.col("line_id").alias("other"), F.col("first").alias("other_first"))
    joined = materialise(ends.join(firsts, "line_id").join(other, "other").select("line_id", "first", "other_first"), "ends")
    by_line = materialise(joined.groupBy("line_id").agg(F.min("other_first").alias("least"), F.count(F.lit(1)).alias("n_links")), "by_line")
    flags = lines.join(by_line.hint("merge"), "line_id", "left").where("n > 1 or n_links > 0")
    flags = materialise(flags.select(F.xxhash64("line").alias("h"), F.hash("line").alias("h2"), "first", F.coalesce(F.col("least") < F.col("first"), F.lit(False)).alias("later"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "flags")
    discard(lines, links, linked, firsts, joined, by_line)
    n_links = materialise(flags.where("n_links > 0").groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.sum("n_links").alias("n_links")), "n_links")
    places = rows.select("doc_id", "text_key", "line_no", F.xxhash64("line").alias("h"), F.hash("line").alias("h2"))
    gone = places.join(flags.hint("merge"), ["h", "h2"]).where(F.col("later") | (F.struct("doc_id", "line_no") != F.col("first")))
    return materialise(gone.select("doc_id", "text_key", "line_no"), "gone"), n_links


def dedup(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's ``doc_id, text_key, n_lines, n_removed, n_links, kept_sha256, kept_text``."""
    base, _ = _line_rows(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    gone, n_links = removed_lines(docs, max_edits, chars_per_edit, id_col, text_col)
    spans = gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))  # a text's own lines
    joined = base.join(spans.hint("merge"), ["doc_id", "text_key"], "left").select("doc_id", "text_key", "text", "gone")
    out = joined.mapInArrow(lean(_drop_lines), f"doc_id {kind}, text_key long, n_lines long, n_removed long, kept_sha256 string, kept_text string")
    return out.join(n_links, "doc_id", "left").select("doc_id", "text_key", "n_lines", "n_removed", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "kept_sha256", "kept_text")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with removed lines cut out of the text; rows that lose nothing are as they were."""
    gone, _ = removed_lines(docs, id_col=id_col, text_col=text_col)
    spans = gone.groupBy(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")).agg(F.collect_set("line_no").alias("__llm_gone"))
    joined = docs.join(spans.hint("merge"), (F.col(id_col) == F.col("__llm_id")) & (text_key(F.col(text_col)) == F.col("__llm_key")), "left")
    lines = F.split(F.col(text_col), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__llm_lines") - 1), F.col("__llm_gone"))
    joined = joined.withColumn("__llm_lines", lines).withColumn("__llm_stay", stay)
    kept = F.array_join(F.transform("__llm_stay", lambda i: F.get(F.col("__llm_lines"), i)), "\n")
    return joined.withColumn(text_col, F.when(F.col("__llm_gone").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)
