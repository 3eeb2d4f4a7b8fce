"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it sees. The class prior is
estimated first: a model tells positives from unlabelled text, and the prior is
the ratio of unlabelled to positive share above the best cut of its scores (on
rows kept out of that fit). Then a network with one hidden layer
minimises the non-negative unbiased risk

    prior * R+(f) + max(0, R-(f on unlabelled) - prior * R-(f on positives))

by Adam; where the second part falls below 0, its gradient is reversed. The
score is the network's estimate of the probability of being good.

Fitted on about ``sample`` positives and as many unlabelled rows (chosen by a
hash of the id), whose features alone, ``len(FEATURES)`` numbers a row, come to
the driver; every document is scored whole.

Defined cases: null and empty texts have all-zero counts and are scored as
such; without positives or unlabelled rows every score is the prior's
default 0.5; repeated rows count as often as they occur; null ids are
unlabelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_TABLE, chunks, find_words, sampled

FEATURES = (
    "log_words", "word_length", "long_words", "distinct", "top_word", "repeated_pairs", "upper", "digits", "marks",
    "symbols", "bars", "exclamations", "stops", "commas", "non_ascii", "line_words", "odd_ends", "capital_words", "same_word",
)
_HIDDEN = 16


def _classes() -> dict[str, np.ndarray]:
    def table(chars: str) -> np.ndarray:
        out = np.zeros(256, dtype=bool)
        out[[ord(c) for c in chars]] = True
        return out

    kinds = {k: table(v) for k, v in {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "marks": "'\"()[]{}:;?-_/", "symbols": "#*$%&<>=+~^@\\", "bars": "|", "exclamations": "!", "stops": ".", "commas": ","}.items()}
    kinds["non_ascii"] = np.arange(256) >= 0x80
    return kinds


_KINDS = _classes()
_LETTER = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    rows = len(offsets) - 1
    w = find_words(data, offsets, SPACE_TABLE)
    n = np.diff(w.first).astype(np.float64)
    out = np.zeros((rows, len(FEATURES)))
    if not w.n:
        return out
    per_word, size = 1 / np.maximum(n, 1), w.end - w.start

    def by_row(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
        return total[w.first[1:]] - total[w.first[:-1]]

    bytes_ = np.maximum(by_row(size), 1)
    h = w.hashes() & np.uint64((1 << 40) - 1)
    row = w.row_of().astype(np.uint64) << np.uint64(40)

    def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.sort(keys)
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        much = np.diff(np.append(new, len(keys)))
        own = (keys[new] >> np.uint64(40)).astype(np.int64)
        return own, much, new

    own, much, _ = runs(row | h)
    distinct = np.bincount(own, minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, own, much)
    pos, pair = w.windows(w.hashes(), 2)
    again = np.zeros(rows)
    if len(pos):
        own, much, _ = runs((w.row_of()[pos].astype(np.uint64) << np.uint64(40)) | (pair & np.uint64((1 << 40) - 1)))
        again = np.bincount(own, weights=np.where(much > 1, much, 0), minlength=rows)
    same = np.zeros(w.n)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    lines = np.concatenate(([0], np.cumsum(data == 0x0A)))
    n_lines = lines[offsets[1:]] - lines[offsets[:-1]] + 1
    cols = {
        "log_words": np.log1p(n),
        "word_length": bytes_ * per_word,
        "long_words": by_row(size > 15) * per_word,
        "distinct": distinct * per_word,
        "top_word": top * per_word,
        "repeated_pairs": again * per_word,
        "line_words": np.log1p(n / n_lines),
        "odd_ends": by_row(~_LETTER[data[w.end - 1]]) * per_word,
        "capital_words": by_row(_KINDS["upper"][data[w.start]]) * per_word,
        "same_word": by_row(same) * per_word,
    }
    for name, kind in _KINDS.items():
        total = np.concatenate(([0], np.cumsum(kind[data])))
        cols[name] = (total[offsets[1:]] - total[offsets[:-1]]) / bytes_
    for k, name in enumerate(FEATURES):
        out[:, k] = np.where(n > 0, cols[name], 0.0)
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in chunks(batch):
            x = features(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *[pa.array(x[:, k]) for k in range(x.shape[1])]], names=["positive", *FEATURES])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from both kinds' scores.

    The ratio of the kinds' shares above a cut, at the cut where the ratio's
    upper confidence bound is smallest.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.quantile(p, np.linspace(0.0, 0.9, 91))
    above_p = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    error = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    best = np.argmin((above_u + error) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


class Network:
    """Standardised features, one hidden layer, a logit."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = [rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), _HIDDEN)), np.zeros(_HIDDEN), rng.normal(0, 0.25, _HIDDEN), np.zeros(1)]

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return z, np.tanh(z @ self.p[0] + self.p[1])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.p[2] + self.p[3][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))

    def gradient(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        z, h = self.hidden(x)
        back = slope[:, None] * self.p[2] * (1 - h * h)
        return [z.T @ back, back.sum(axis=0), h.T @ slope, np.array([slope.sum()])]

    def train(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 60, rate: float = 0.01, seed: int = 9) -> None:
        """Minimise the non-negative risk; without a prior, the plain risk of positive against unlabelled."""
        rng = np.random.default_rng(seed)
        m, v, step = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        for _ in range(epochs):
            ps, us = np.array_split(rng.permutation(len(positive)), 20), np.array_split(rng.permutation(len(unlabelled)), 20)
            for pi, ui in zip(ps, us, strict=True):
                if not len(pi) or not len(ui):
                    continue
                xp, xu = positive[pi], unlabelled[ui]
                fp, fu = self.logit(xp), self.logit(xu)
                sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
                # logistic loss: its slope is s - 1 for a positive, s for a negative
                if prior is None:
                    grads = self._sum(self.gradient(xp, (sp - 1) / len(pi)), self.gradient(xu, su / len(ui)))
                else:
                    negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
                    part = self._sum(self.gradient(xu, su / len(ui)), self.gradient(xp, -prior * sp / len(pi)))
                    if negative >= 0:
                        grads = self._sum(part, self.gradient(xp, prior * (sp - 1) / len(pi)))
                    else:
                        grads = [-g for g in part]
                step += 1
                for k, g in enumerate(grads):
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _sum(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        return [x + y for x, y in zip(a, b, strict=True)]


def fit(docs: DataFrame, positives: DataFrame, unlabelled_out: DataFrame | None = None, sample: int = 15_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[Network | None, float]:
    """The trained network and the estimated prior.

    ``positives`` is a column of trusted ids. Every other document is unlabelled
    but for the ids of ``unlabelled_out``.
    """
    good = positives.toDF("__id").where(F.col("__id").isNotNull()).distinct()
    total_good, total = good.count(), docs.count()
    if not total_good or total <= total_good:
        return None, 0.5
    good_sample = good.where(sampled(F.xxhash64("__id", F.lit(7)), sample / total_good)).withColumn("__p", F.lit(True))
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # a candidate for the unlabelled sample is chosen by its id before any join; both are bounded by ``sample``
    others = base.where(sampled(F.xxhash64("__id", F.lit(8)), sample / total))
    ids = others.select("__id").join(good.hint("merge"), "__id", "left_anti")
    if unlabelled_out is not None:
        ids = ids.join(unlabelled_out.toDF("__id").hint("merge"), "__id", "left_anti")
    wanted = good_sample.unionByName(ids.distinct().withColumn("__p", F.lit(False)))
    known = base.join(F.broadcast(wanted), "__id").select("__p", "text")
    schema = "positive boolean, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = known.mapInArrow(_feature_rows, schema).orderBy(*FEATURES, "positive").toPandas()
    x, is_p = rows[list(FEATURES)].to_numpy(dtype=float), rows["positive"].to_numpy(dtype=bool)
    if is_p.all() or not is_p.any():
        return None, 0.5
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    p, u = x[is_p], x[~is_p]
    rng = np.random.default_rng(3)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    teller = Network(mean, scale)
    teller.train(p[::2], u[::2], None, epochs=15)
    prior = estimate_prior(teller.logit(p[1::2]) if len(p) > 1 else teller.logit(p), teller.logit(u[1::2]) if len(u) > 1 else teller.logit(u))
    net = Network(mean, scale)
    net.train(p, u, prior)
    return net, prior


def _scores(net: Network | None, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch):
                p = np.full(j - i, prior) if net is None else net.probability(features(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(p)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, net: Network | None, prior: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_scores(net, prior), f"doc_id {kind}, score double")
