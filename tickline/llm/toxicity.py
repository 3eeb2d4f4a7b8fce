"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding look-alikes.

Folding lower-cases, maps homoglyphs (Cyrillic, Greek, full-width) and digits
to Latin letters, maps ``@ $ !`` before a letter, and turns every run of other
characters into one blank. Entries begin at a word's start; they are whole words
or word beginnings. One automaton finds entries and exception phrases; an entry
inside an exception phrase doesn't count, and of entries at one place the
heaviest counts. The weights found are summed and normalised by the number of
words; a logistic curve over both turns them into a score from 0 to 1.

The lexicon starts from ``SEEDS`` and is learnt from labelled documents: the
log-odds of a word or word beginning between toxic and other documents. It is
fitted on at most about ``sample`` labelled documents (chosen by a hash of the
id) and has at most ``entries`` entries, so what is broadcast has a fixed bound;
every document is scored whole.

Defined cases: null and empty texts have no words and get the curve's value for
none; without labels of both kinds the seeds and ``DEFAULT_CURVE`` are used;
repeated documents or labels count as often as they occur; labels of null are
left out; a null id is never held out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled

# Seed words and weights, exception phrases, look-alikes.
SEEDS = {"idiot": 2.0, "stupid": 1.5, "moron": 2.0, "scum": 2.0, "loser": 1.5, "trash": 1.0, "disgusting": 1.5, "worthless": 1.5, "pathetic": 1.5, "clown": 1.0, "imbecile": 2.0, "bastard": 2.0}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof", "pond scum", "loser bracket", "not stupid", "no idiot")
HOMOGLYPHS = dict(zip("авеёкмнорстухіјѕԁɡαβεικνορτυχаｏ", "abeekmhopctyxijsdgabeikvoptuxao", strict=True))
DIGITS = dict(zip("0134578", "oieastb", strict=True))
SYMBOLS = {"@": "a", "$": "s", "!": "i"}
DEFAULT_CURVE = (-3.0, 2.0, 10.0)

_TABLE = str.maketrans({**HOMOGLYPHS, **DIGITS, **{chr(0xFF21 + i): chr(0x61 + i) for i in range(26)}, **{chr(0xFF41 + i): chr(0x61 + i) for i in range(26)}})
_SYMBOL = re.compile(r"[@$!](?=[^\W_])")
_OTHER = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded words, each between single blanks; ``" "`` if there is none."""
    if not text:
        return " "
    text = _SYMBOL.sub(lambda m: SYMBOLS[m[0]], text.lower().translate(_TABLE))
    words = _OTHER.sub(" ", text).strip()
    return f" {words} " if words else " "


class Lexicon:
    """The automaton of entries (with weights) and exception phrases."""

    def __init__(self, entries: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in entries.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in EXCEPTIONS:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        self.automaton.make_automaton()

    def features(self, text: str | None) -> tuple[float, int, int]:
        """Sum of weights, matches, words."""
        folded = fold(text)
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end + 1 - size
            if weight == 0.0:
                free.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if free and best:
            # of the exceptions that begin at or before a match, the farthest end tells whether one covers it
            free.sort()
            begin, reach = [a for a, _ in free], list(accumulate((b for _, b in free), max))
            best = {s: w for s, w in best.items() if s < begin[0] or reach[bisect_right(begin, s) - 1] <= s}
        return sum(best.values()), len(best), max(0, folded.count(" ") - 1)


def _curve_input(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), total / np.maximum(words, 20)], axis=1)


def _scores(lexicon: Lexicon, curve: tuple[float, float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.features(x.as_py()) for x in batch.column(1)]
            total, matches, words = (np.array(x, dtype=np.float64) for x in zip(*found, strict=True)) if found else (np.zeros(0),) * 3
            score = 1 / (1 + np.exp(-np.clip(_curve_input(total, words) @ np.array(curve), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(score), pa.array(total), pa.array(matches.astype(np.int64)), pa.array(words.astype(np.int64))], names=[batch.schema.names[0], *batch.schema.names[2:], "score", "weight", "n_matches", "n_words"])

    return run


_PREFIXES = (4, 5, 6, 8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each kind that hold a word or word beginning, summed by task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            words = {f" {w} " for w in fold(text.as_py()).split()}
            words |= {w[: n + 1] for w in words for n in _PREFIXES if len(w) > n + 2}
            counts[label.as_py()].update(words)
    keys = list(counts[0].keys() | counts[1].keys())
    for a in range(0, len(keys), 50_000):
        own = keys[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(own, type=pa.string()), pa.array([counts[1][k] for k in own], type=pa.int64()), pa.array([counts[0][k] for k in own], type=pa.int64())], names=["entry", "toxic", "other"])


def _fit_curve(total: np.ndarray, words: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a small ridge."""
    x, w = _curve_input(total, words), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * len(x) / 1000 * np.eye(3)
        w = w + np.linalg.solve(hessian, x.T @ (label - p) - 0.01 * len(x) / 1000 * w)
    return tuple(float(v) for v in w)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``text, label`` of about ``sample`` labelled documents; ``labels`` are ``id, label`` rows."""
    labels = labels.toDF("__id", "__label").where(F.col("__id").isNotNull() & F.col("__label").isNotNull())
    total = labels.count()
    share = 1.0 if total <= sample else sample / total
    chosen = labels.where(sampled(F.xxhash64("__id", F.lit(seed)), share))
    # bounded by ``sample``, so it may be broadcast and the texts aren't shuffled
    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id").select("text", F.col("__label").cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, entries: int = 2_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], tuple[float, float, float]]:
    """Entries with weights and the curve, from ``labels`` (``id, label`` with 1 for toxic)."""
    known = labelled_sample(docs, labels, sample, 101, id_col, text_col)
    kinds = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    seeds = {f" {w}": v for w, v in SEEDS.items()}
    n1, n0 = kinds.get(1, 0), kinds.get(0, 0)
    if not n1 or not n0:
        return seeds, DEFAULT_CURVE
    counted = known.mapInArrow(_count, "entry string, toxic long, other long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    weight = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("other") + 0.5) / (n0 + 1))
    least = max(3, math.ceil(0.002 * n1))
    top = counted.withColumn("weight", weight).where((F.col("toxic") >= least) & (F.col("weight") >= 2.0)).orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "entry").limit(entries)
    learnt = {r["entry"]: r["weight"] for r in top.collect()}
    lexicon = seeds | learnt
    fitted = known.select("label", "text").mapInArrow(_scores(Lexicon(lexicon), DEFAULT_CURVE), "label int, score double, weight double, n_matches long, n_words long").select("label", "weight", "n_words").toPandas()
    return lexicon, _fit_curve(fitted["weight"].to_numpy(), fitted["n_words"].to_numpy(dtype=float), fitted["label"].to_numpy(dtype=float))


def score(docs: DataFrame, lexicon: dict[str, float], curve: tuple[float, float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, weight, n_matches, n_words`` for each row."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_scores(Lexicon(lexicon), curve), f"doc_id {kind}, score double, weight double, n_matches long, n_words long")
