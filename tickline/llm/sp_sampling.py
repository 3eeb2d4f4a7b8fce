"""SentencePiece segmentations sampled without replacement, and decoding.

A text's lattice has a node before each character and an edge for each piece;
a segmentation's probability is the normalised product of its pieces' weights.
The k segmentations with the largest Gumbel-perturbed log-probabilities are a
sample of k without replacement. They are found by a perturbed A-star search: a
priority queue holds regions, sets of segmentations that share a prefix and
avoid some next edges, keyed by the largest perturbed value inside. The top
region is popped, its best segmentation is drawn along the lattice and emitted,
and what is left of the region is divided by the place of departure from it;
each part's value is a Gumbel of the part's mass, truncated at the popped one.
No region that can't be among the next k is kept, so the search is exact.

No piece goes on after a blank mark that follows other characters, so the
lattice is a chain of independent units (words); equal ends of units share their
nodes, also between chunks. Draws are hashes of the row key, the draw's number and the
character position, so a row's samples don't depend on batches or partitions.

Weights: a BPE model's scores are merge ranks, no log-probabilities; a piece of
rank r weighs 1 / (r + 2) (Zipf). A character without a piece is spelt in byte
pieces. ``scores="model"`` takes a unigram model's own log-probabilities.

Defined cases: a null, empty text has one segmentation, without pieces; a text
with fewer than k segmentations gives all of them; U+2581 in a text is a blank;
repeated rows of one key give the same samples; a null key is a key too.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, mix, powers

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = 0x2581
_SHORT = 48
_TILT = 3.0
_LONG = 1 << 40
_CHUNK = 1 << 18
#: A worker's lattice is begun anew once it has this many edges, of about 60 bytes each with their nodes.
_EDGES = 500_000


class Vocabulary:
    """Pieces of a SentencePiece model as arrays; ``model`` is the model file's bytes."""

    def __init__(self, model: bytes, scores: str = "rank"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.n)]
        normal = [i for i in range(self.n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) and names[i]]
        self.bytes_id = np.full(256, sp.unk_id(), dtype=np.int32)
        raw = [b""] * self.n
        for i in range(self.n):
            if sp.is_byte(i):
                value = int(names[i][3:5], 16)
                self.bytes_id[value] = i
                raw[i] = bytes([value])
        for i in normal:
            raw[i] = names[i].encode()
        raw = [x.replace(b"\xe2\x96\x81", b" ") for x in raw]
        self.raw = pa.array(raw, type=pa.large_binary())
        given = np.array([sp.get_score(i) for i in normal])
        if scores == "rank":
            order = np.argsort(-given, kind="stable")
            rank = np.empty(len(order))
            rank[order] = np.arange(len(order))
            given = -np.log(rank + 2.0)
        self.unknown = float(given.min()) - 10.0
        by_length: dict[int, list[tuple[int, float]]] = {}
        shared = set()
        for i, weight in zip(normal, given.tolist(), strict=True):
            if len(names[i]) > 1:
                shared.update(map(ord, names[i]))
            by_length.setdefault(len(names[i]), []).append((i, weight))
            if "▁" in names[i].lstrip("▁"):
                raise ValueError(f"piece {names[i]!r} goes on after a blank mark; its lattice isn't a chain of words")
        self.longest = max(by_length)
        self.prefix = {}
        for length in range(1, self.longest + 1):
            heads = {names[i][:length] for i in normal if len(names[i]) > length}
            codes = np.frombuffer("".join(sorted(heads)).encode("utf-32-le"), dtype=np.uint32)
            self.prefix[length] = _flags(_spans(codes)[0](np.arange(len(heads)) * length, length))
        self.table = {}
        for length, own in by_length.items():
            codes = np.frombuffer("".join(names[i] for i, _ in own).encode("utf-32-le"), dtype=np.uint32)
            keys = _spans(codes)[0](np.arange(len(own)) * length, length)
            self.table[length] = (_Keys(keys), np.array([i for i, _ in own], dtype=np.int32), np.array([w for _, w in own]))
        #: by code point: whether it stands in no piece with others
        self.lone = np.ones(0x110000, dtype=bool)
        self.lone[sorted(shared)] = False
        self.lattice: Lattice | None = None

    def nodes(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[Lattice, np.ndarray]:
        """The nodes of the units that ``codes`` is made of, in a lattice that is kept until it has ``_EDGES`` edges."""
        if self.lattice is None or self.lattice.n_edges >= _EDGES:
            self.lattice = Lattice(self)
        while True:
            try:
                return self.lattice, self.lattice.nodes(codes, start, size)
            except _Clash:
                self.lattice = Lattice(self, self.lattice.salt + 1)


_LOW = np.uint64((1 << 18) - 1)


@functools.lru_cache(maxsize=2)
def vocabulary(model: bytes, scores: str = "rank") -> Vocabulary:
    """The model's arrays, built once in a worker process."""
    return Vocabulary(model, scores)


def _flags(keys: np.ndarray) -> np.ndarray:
    """Which low bits occur among ``keys``; a cheap test before the exact one."""
    out = np.zeros(1 << 18, dtype=bool)
    out[(keys & _LOW).astype(np.int64)] = True
    return out


class _Keys:
    """Places of 64-bit keys, addressed by their low bits; the few that share these stand in further layers."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.layers = []
        left = np.arange(len(keys))
        while len(left):
            low, first = np.unique((keys[left] & _LOW).astype(np.int64), return_index=True)
            layer = np.full(1 << 18, -1, dtype=np.int32)
            layer[low] = left[first]
            self.layers.append(layer)
            left = np.delete(left, first)

    def find(self, wanted: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``wanted`` (``low``: their low bits) are keys, and the keys' places."""
        found, places = [], []
        ask = None
        for layer in self.layers:
            place = layer[low if ask is None else low[ask]]
            some = np.flatnonzero(place >= 0)
            ask, place = some if ask is None else ask[some], place[some]
            hit = self.keys[place] == wanted[ask]
            found.append(ask[hit])
            places.append(place[hit])
            ask = ask[~hit]
        return np.concatenate(found), np.concatenate(places)


def _spans(codes: np.ndarray):
    """A function that hashes ``codes[at:at + length]`` for many places, and one for the next length."""
    vals = mix(codes.astype(np.uint64) + np.uint64(0x1F123BB5))

    def whole(at: np.ndarray, length: int) -> np.ndarray:
        acc = np.zeros(len(at), dtype=np.uint64)
        for i in range(length):
            acc = follow(acc, at, i)
        return acc

    def follow(acc: np.ndarray, at: np.ndarray, i: int) -> np.ndarray:
        return mix(acc * np.uint64(0xD6E8FEB86659FD93) + vals[at + i])

    return whole, follow


class _Clash(Exception):
    """Two different ends of units have one hash."""


def _grown(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``a``, whose first ``used`` places are taken, with ``more`` behind these; room at least doubles."""
    need = used + len(more)
    if need > len(a):
        wider = np.empty(max(need, 2 * len(a)), dtype=a.dtype)
        wider[:used] = a[:used]
        a = wider
    a[used:need] = more
    return a


class _Numbers:
    """Numbers of distinct 64-bit hashes in the order they were added; a table with open addressing."""

    def __init__(self):
        self.n = 0
        self.keys = np.empty(1 << 12, dtype=np.uint64)
        self.slot = np.full(1 << 13, -1, dtype=np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The number of each of ``wanted``, -1 where it has none."""
        last = len(self.slot) - 1
        at = (wanted & np.uint64(last)).astype(np.int64)
        out = self.slot[at]
        ask = np.flatnonzero((out >= 0) & (self.keys[out] != wanted))
        while len(ask):
            at[ask] = spot = (at[ask] + 1) & last
            out[ask] = got = self.slot[spot]
            ask = ask[(got >= 0) & (self.keys[got] != wanted[ask])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number ``keys``, which are distinct and have no number yet."""
        self.keys = _grown(self.keys, self.n, keys)
        left = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        if 2 * self.n > len(self.slot):
            self.slot = np.full(1 << (3 * self.n).bit_length(), -1, dtype=np.int32)
            left = np.arange(self.n, dtype=np.int32)
        last = len(self.slot) - 1
        at = (self.keys[left] & np.uint64(last)).astype(np.int64)
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]
            go = np.flatnonzero(self.slot[at] != left)  # one that found its slot taken, or lost it to another
            left, at = left[go], (at[go] + 1) & last


def _hashes(codes: np.ndarray, kind: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each character and its kind; the sum of those from a place on tells a unit's end."""
    x = kind.astype(np.uint64)
    x <<= np.uint64(21)
    x |= codes
    x += np.uint64((0x2545F4914F6CDD1D + salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x *= np.uint64(0xA24BAED4963EE407)
    return mix(x)


class Lattice:
    """Edges of the units met so far, with forward-sampling probabilities.

    A node stands for what is left of a unit from a character on, so units
    share the nodes of equal ends; node 0 is the end itself. ``first[v]:first[v
    + 1]`` are the edges of node ``v``. A node's values come from its own end
    alone, whatever was met before. Ends are found by their hashes and compared
    character by character.
    """

    def __init__(self, vocabulary: Vocabulary, salt: int = 0):
        self.vocabulary, self.salt = vocabulary, salt
        self.numbers = _Numbers()
        self.numbers.add(np.zeros(1, dtype=np.uint64))
        self.n_edges = self.n_kept = 0
        #: characters of the units that were added
        self.kept = np.empty(0, dtype=np.uint32)
        # by node: an example's place in ``kept``, the kind, the node one character on, the mass, the first edge
        self.at = np.zeros(1, dtype=np.int64)
        self.kind = np.zeros(1, dtype=np.int64)
        self.next = np.zeros(1, dtype=np.int32)
        self.mass = np.ones(1)
        self.first = np.zeros(2, dtype=np.int32)
        # by edge: its node, the node that it leads to (0: the unit's end), the shares' logs,
        # the sum of the shares before it at its node, the log of the other shares' sum
        self.node = np.empty(0, dtype=np.int32)
        self.to = np.empty(0, dtype=np.int32)
        self.length = np.empty(0, dtype=np.int16)
        self.piece = np.empty(0, dtype=np.int32)
        self.logq = np.empty(0)
        self.below = np.empty(0, dtype=np.uint64)
        self.others = np.empty(0)

    @staticmethod
    def _kinds(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many characters are left of each character's unit, marked in long units."""
        kind = np.repeat(start + size + np.where(size > _SHORT, _LONG, 0), size)
        kind -= np.arange(len(kind))
        return kind

    def nodes(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The nodes of the units that ``codes`` is made of; those not met before are added."""
        kind = self._kinds(start, size)
        whole = np.add.reduceat(_hashes(codes, kind, self.salt), start)
        node = self.numbers.find(whole)
        new = np.flatnonzero(node < 0)
        if len(new):
            _, example, same = np.unique(whole[new], return_index=True, return_inverse=True)
            example = new[example]
            own = size[example]
            before = np.cumsum(own) - own
            node[new] = self._add(codes[np.repeat(start[example] - before, own) + np.arange(int(own.sum()))], before, own)[same]
        if (self.kind[node] != kind[start]).any():
            raise _Clash
        place = np.repeat(self.at[node] - start, size)
        place += np.arange(len(codes))
        if (self.kept[place] != codes).any():
            raise _Clash
        return node

    def _add(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Add the ends that are new among those of the given units; returns the units' nodes."""
        kind = self._kinds(start, size)
        run = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(_hashes(codes, kind, self.salt), out=run[1:])
        ends = np.repeat(run[start + size], size) - run[:-1]
        node = self.numbers.find(ends)
        new = np.flatnonzero(node < 0)
        keys, example, same = np.unique(ends[new], return_index=True, return_inverse=True)
        example = new[example]
        # new nodes in the order in which their masses can be told: shorter ends first
        order = np.argsort(kind[example], kind="stable")
        example = example[order]
        n = self.numbers.n
        number = np.empty(len(order), dtype=np.int32)
        number[order] = np.arange(n, n + len(order), dtype=np.int32)
        node[new] = number[same]
        self.numbers.add(keys[order])
        after = np.append(node[1:], np.int32(0))
        after[start + size - 1] = 0
        self.kept = _grown(self.kept, self.n_kept, codes)
        self.at = _grown(self.at, n, self.n_kept + example)
        self.kind = _grown(self.kind, n, kind[example])
        self.next = _grown(self.next, n, after[example])
        self.n_kept += len(codes)
        if (self.kind[node] != kind).any() or (self.kept[self.at[node]] != codes).any() or (self.next[node] != after).any():
            raise _Clash
        self._edges(codes, node, example, kind[example], n)
        return node[start]

    def _edges(self, codes: np.ndarray, nodes: np.ndarray, example: np.ndarray, kind: np.ndarray, n: int) -> None:
        """Edges of the new nodes from ``n`` on, which begin at ``codes[example]``."""
        v = self.vocabulary
        rest = kind & (_LONG - 1)
        _, follow = _spans(codes)
        own, at = np.arange(len(example)), example
        acc = np.zeros(len(at), dtype=np.uint64)
        found = []
        count = np.zeros(len(at), dtype=np.int64)
        for length in range(1, v.longest + 1):
            if not len(at):
                break
            acc = follow(acc, at, length - 1)
            low = (acc & _LOW).astype(np.int64)
            if length in v.table:
                keys, own_ids, own_weights = v.table[length]
                hit, place = keys.find(acc, low)
                found.append((length, own[hit], own_ids[place], own_weights[place]))
                count[own[hit]] += 1
            if length == 1:
                spelt = np.flatnonzero(count == 0)
                found.append((1, spelt, np.full(len(spelt), -1, dtype=np.int32), np.full(len(spelt), v.unknown)))
                count[spelt] += 1
            go = np.flatnonzero((rest[own] > length) & v.prefix[length][low])
            own, at, acc = own[go], at[go], acc[go]
        # edges in the order of their nodes, shorter ones first
        first = np.concatenate(([0], np.cumsum(count)))
        total = int(first[-1])
        own = np.repeat(np.arange(len(count)), count)
        lengths = np.empty(total, dtype=np.int16)
        piece = np.empty(total, dtype=np.int32)
        weight = np.empty(total)
        free = first[:-1].copy()
        for length, node, own_ids, own_weights in found:
            spot = free[node]
            lengths[spot], piece[spot], weight[spot] = length, own_ids, own_weights
            free[node] += 1
        final = rest[own] == lengths
        to = nodes[np.minimum(example[own] + lengths, len(codes) - 1)]
        to[final] = 0
        self.mass = _grown(self.mass, n, np.zeros(len(count)))
        q = self._shares(kind, first, count, weight, lengths, to, n)
        e = self.n_edges
        self.first = _grown(self.first, n + 1, e + first[1:])
        self.node = _grown(self.node, e, n + own)
        self.to = _grown(self.to, e, to)
        self.length = _grown(self.length, e, lengths)
        self.piece = _grown(self.piece, e, piece)
        with np.errstate(divide="ignore"):
            self.logq = _grown(self.logq, e, np.log(q))
        # sums of integers: exact, so the edges of other nodes leave them alone
        share = (q * 2.0**53).astype(np.uint64)
        run = np.cumsum(share)
        run -= share
        self.below = _grown(self.below, e, run - np.repeat(run[first[:-1]], count))
        # log of the mass of the other edges of an edge's node
        np.minimum(q, 1.0, out=q)
        np.negative(q, out=q)
        with np.errstate(divide="ignore"):
            others = np.log1p(q, out=q)
        others[first[:-1][count == 1]] = -np.inf
        self.others = _grown(self.others, e, others)
        self.n_edges += total

    def _shares(self, kind: np.ndarray, first: np.ndarray, count: np.ndarray, weight: np.ndarray, lengths: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
        """Each edge's share of its node's mass, the mass of all ways to the unit's end, from the ends backwards."""
        # a tilt by length leaves shares as they are, and short units' masses inside the range of a double
        tilted = _TILT * lengths
        tilted += weight
        np.exp(tilted, out=tilted)
        share = np.empty(len(weight))
        steps = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1], [True])))
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            i, j = int(first[a]), int(first[b])
            heads, much = first[a:b] - i, count[a:b]
            if kind[a] < _LONG:
                s = tilted[i:j] * self.mass[to[i:j]]
                mass = np.add.reduceat(s, heads)
                share[i:j] = s / np.repeat(mass, much)
            else:  # masses of long units are kept as logs
                s = weight[i:j] + np.where(to[i:j] == 0, 0.0, self.mass[to[i:j]])
                top = np.maximum.reduceat(s, heads)
                mass = top + np.log(np.add.reduceat(np.exp(s - np.repeat(top, much)), heads))
                share[i:j] = np.exp(s - np.repeat(mass, much))
            self.mass[n + a : n + b] = mass
        return share

    def draw(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        """An edge of each node, by the edges' shares; nodes have few edges, so these are tried in turn from the longest."""
        edge = self.first[node + 1]
        edge -= 1
        open_ = np.flatnonzero(self.below[edge] > x)
        x = x[open_]
        while len(open_):
            edge[open_] = down = edge[open_] - 1
            go = np.flatnonzero(self.below[down] > x)
            open_, x = open_[go], x[go]
        return edge


def _numbered(seed: np.ndarray, number: int) -> np.ndarray:
    return mix(seed + np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def _bits(numbered: np.ndarray, place: np.ndarray) -> np.ndarray:
    """53 random bits."""
    h = mix(numbered ^ place.view(np.uint64))
    h >>= np.uint64(11)
    return h


def _drawn(numbered: np.ndarray, place: np.ndarray) -> np.ndarray:
    u = _bits(numbered, place).astype(np.float64)
    u += 0.5
    u *= 2.0**-53
    return u


def _uniform(seed: np.ndarray, number: int, place: np.ndarray) -> np.ndarray:
    return _drawn(_numbered(seed, number), place)


class _Chunk:
    """The texts of a chunk as units over the vocabulary's lattice, and their sampled paths.

    Places are characters of the whole chunk; each text begins with the blank
    mark that SentencePiece puts before it.
    """

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        codes = np.frombuffer("".join("▁" + x if x else "" for x in texts).encode("utf-32-le"), dtype=np.uint32).copy()
        codes[codes == 0x20] = _MARK
        size = np.array([len(x) + 1 if x else 0 for x in texts], dtype=np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(size)))
        self.codes, self.seeds, self.n = codes, seeds, len(codes)
        self.row = np.repeat(np.arange(len(texts)), size)
        if not self.n:
            return
        blank = codes == _MARK
        lone = vocabulary.lone[codes]
        before = np.concatenate(([False], blank[:-1]))
        begin = (blank & ~before) | lone | np.concatenate(([True], lone[:-1]))
        begin[self.bounds[:-1][size > 0]] = True
        self.unit = np.flatnonzero(begin)
        self.unit_size = np.diff(np.append(self.unit, self.n))
        self.unit_row = self.row[self.unit]
        self.lattice, self.unit_node = vocabulary.nodes(codes, self.unit, self.unit_size)

    def sample(self, number: int, place: np.ndarray, node: np.ndarray, row: np.ndarray, edges: np.ndarray) -> None:
        """Draw on from each of ``place`` to its unit's end, and write the edges at their places."""
        lattice = self.lattice
        seed, begin = _numbered(self.seeds, number)[row], self.bounds[row]
        while len(place):
            edge = lattice.draw(node, _bits(seed, place - begin))
            edges[place] = edge
            to = lattice.to[edge]
            go = np.flatnonzero(to)
            place, node = place[go] + lattice.length[edge[go]], to[go]
            seed, begin = seed[go], begin[go]


def _log_later(parent: float | np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Log arrival time of a region of log-mass ``mass`` after time ``parent``; the Gumbel value is its negative."""
    return np.logaddexp(parent, np.log(-np.log(u)) - mass)


#: Log of the smallest exponential draw, and the log-mass below which parts are first left aside.
_EARLIEST = float(np.log(-np.log1p(-(2.0**-54))))
_FAR = -60.0


def _smallest(value: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest finite values of each row; ``row`` is ascending."""
    out = [np.zeros(0, dtype=np.int64)]
    value = value.copy()
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
    for _ in range(k if len(row) else 0):
        least = np.minimum.reduceat(value, heads)
        at = np.flatnonzero((value == np.repeat(least, np.diff(np.append(heads, len(value))))) & np.isfinite(value))
        if not len(at):
            break
        out.append(at)
        value[at] = np.inf
    return np.concatenate(out)


def _search(c: _Chunk, k: int) -> tuple[list[tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]], np.ndarray]:
    """The emitted paths, best first, and each row's largest perturbed value that is left.

    A path is given for all rows that have one more: the rows, the places and
    the edges there, and the rows' log-probabilities and perturbed values.
    """
    rows = len(c.bounds) - 1
    lattice = c.lattice
    some = np.flatnonzero(np.diff(c.bounds) > 0)
    out = []
    heaps: list[list] = [[] for _ in range(rows)]
    paths: list[np.ndarray] = []
    edges = np.full(c.n, -1, dtype=np.int32)
    c.sample(0, c.unit, c.unit_node, c.unit_row, edges)
    time = np.full(rows, np.inf)
    time[some] = np.log(-np.log(_uniform(c.seeds[some], 1, np.zeros(len(some), dtype=np.int64))))
    cut = c.bounds[:-1].copy()  # paths depart from their parents here
    mass_at = np.zeros(rows)  # log-mass of the prefix before it
    live = some
    for emitted in range(k):
        paths.append(edges)
        place = np.flatnonzero(edges >= 0)
        row = c.row[place]
        edge = edges[place]
        logq = lattice.logq[edge]
        inside = place >= cut[row]
        tail = np.where(inside, logq, 0.0)
        prefix = np.empty(len(place))
        heads = np.searchsorted(row, live)
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(place)], strict=True):  # a row's sums are its own
            np.cumsum(tail[a:b], out=prefix[a:b])
        prefix -= tail
        prefix += mass_at[row]
        total = np.add.reduceat(logq, heads)
        out.append((live, (place, edge), total, -time[live]))
        # parts of the popped regions: by the place where a segmentation leaves the emitted one
        parts = inside if emitted == 0 else place > cut[row]
        lacking = np.zeros(rows, dtype=bool)
        lacking[live] = True
        for floor in (_FAR, -np.inf):
            near = np.flatnonzero(parts & (prefix > floor))  # a part weighs no more than its prefix
            near = near[lacking[row[near]]]
            mass = prefix[near] + lattice.others[edge[near]]
            some = np.flatnonzero(mass > floor)
            near, mass = near[some], mass[some]
            own_row = row[near]
            value = _log_later(time[own_row], mass, _drawn(_numbered(c.seeds, 3 * emitted + 2)[own_row], place[near] - c.bounds[own_row]))
            best = _smallest(value, own_row, k - emitted)
            # a part below the floor comes later than this for any draw, so it isn't among the next ones
            if floor > -np.inf:
                early = value[best] < _EARLIEST - _FAR
                lacking &= np.bincount(own_row[best[early]], minlength=rows) < k - emitted
                best = best[~lacking[own_row[best]]]
            for x, t in zip(near[best].tolist(), value[best].tolist(), strict=True):
                heapq.heappush(heaps[int(row[x])], (t, int(place[x]), (int(edge[x]),), float(prefix[x]), emitted))
            if not lacking.any():
                break
        if emitted + 1 == k:
            break
        live = np.array([r for r in live.tolist() if heaps[r]], dtype=np.int64)
        if not len(live):
            break
        popped = [heapq.heappop(heaps[r]) for r in live.tolist()]
        start = np.array([x[1] for x in popped], dtype=np.int64)
        inside = start - c.bounds[live]
        node = lattice.node[[x[2][0] for x in popped]]
        first, last = lattice.first[node].tolist(), lattice.first[node + 1].tolist()
        u = _uniform(c.seeds[live], 3 * emitted + 3, inside).tolist()
        v = _uniform(c.seeds[live], 3 * emitted + 4, inside + (1 << 40))
        much = lattice.first[node + 1] - lattice.first[node]
        ends = np.cumsum(much)
        q = np.exp(lattice.logq[np.repeat(lattice.first[node] - (ends - much), much) + np.arange(int(ends[-1]))]).tolist()
        chosen = np.empty(len(live), dtype=np.int64)
        rest = np.full(len(live), -np.inf)
        spared = np.zeros(len(live))
        for x, ((_, _, without, _, _), end) in enumerate(zip(popped, ends.tolist(), strict=True)):
            left = [e for e in range(first[x], last[x]) if e not in without]
            upto, total = [], 0.0
            for e in left:
                total += q[end - last[x] + e]
                upto.append(total)
            pick = min(bisect_right(upto, u[x] * total), len(left) - 1)
            chosen[x] = left[pick]
            if len(left) > 1:  # what is left at the place of departure itself
                spared[x] = total - q[end - last[x] + left[pick]] + 1e-300
        more = np.flatnonzero(spared)
        rest[more] = np.array([x[3] for x in popped])[more] + np.log(spared[more])
        time[live], cut[live], mass_at[live] = [x[0] for x in popped], start, [x[3] for x in popped]
        later = _log_later(time[live], rest, v).tolist()
        edges = np.full(c.n, -1, dtype=np.int32)
        begin = c.bounds[live].tolist()
        for x, (r, (_, p, without, before, parent)) in enumerate(zip(live.tolist(), popped, strict=True)):
            if rest[x] > -np.inf:
                heapq.heappush(heaps[r], (later[x], p, (*without, int(chosen[x])), before, emitted + 1))
            edges[begin[x] : p] = paths[parent][begin[x] : p]
        spot = np.full(rows, np.iinfo(np.int64).max)
        spot[live] = start
        edges[start] = chosen
        to = lattice.to[chosen]
        go = np.flatnonzero(to)
        after = np.flatnonzero(c.unit > spot[c.unit_row])
        c.sample(
            10 + emitted,
            np.concatenate(((start + lattice.length[chosen])[go], c.unit[after])),
            np.concatenate((to[go], c.unit_node[after])),
            np.concatenate((live[go], c.unit_row[after])),
            edges,
        )
    return out, np.array([-h[0][0] if h else -np.inf for h in heaps])


def _ids(v: Vocabulary, c: _Chunk, path: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows' paths and the rows' bounds; characters without a piece become byte pieces."""
    place, edge = path
    piece = c.lattice.piece[edge]
    spelt = np.flatnonzero(piece < 0)
    if not len(spelt):
        return piece, np.searchsorted(place, c.bounds)
    codes = c.codes[place[spelt]]
    much = np.ones(len(place), dtype=np.int64)
    much[spelt] = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    begin = np.concatenate(([0], np.cumsum(much)))
    ids = np.empty(int(begin[-1]), dtype=np.int32)
    ids[begin[:-1]] = piece
    for code in np.unique(codes).tolist():
        at = begin[spelt[codes == code]]
        for i, byte in enumerate(chr(code).encode()):
            ids[at + i] = v.bytes_id[byte]
    return ids, begin[np.searchsorted(place, c.bounds)]


def decode_ids(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """UTF-8 bytes of piece sequences ``ids[bounds[r]:bounds[r + 1]]``, without the blank before each text."""
    if not len(ids):
        return [b""] * (len(bounds) - 1)
    _, begin, raw = v.raw.take(pa.array(ids)).buffers()
    begin, raw = np.frombuffer(begin, dtype=np.int64), raw.to_pybytes()
    cut = begin[bounds].tolist()
    return [raw[a + (raw[a : a + 1] == b" ") : b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _sampler(model: bytes, k: int, scores: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model, scores)
        try:
            for batch in batches:
                seeds = batch.column(batch.schema.get_field_index("seed")).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for i, j, data, offsets in chunks(batch, most=_CHUNK):
                    keys = batch.column(0).slice(i, j - i)
                    yield _emitted(v, _Chunk(v, data, offsets, seeds[i:j]), keys, data, offsets, k, digest)
        finally:
            v.lattice = None  # a worker outlives its tasks, and more workers than cores may wait for the next one

    return lean(run)


def _emitted(v: Vocabulary, c: _Chunk, keys: pa.Array, data: np.ndarray, offsets: np.ndarray, k: int, digest: bool) -> pa.RecordBatch:
    raw = data.tobytes()
    texts = [raw[a:b].replace(b"\xe2\x96\x81", b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    empty = np.flatnonzero(np.diff(c.bounds) == 0)
    paths, left = _search(c, k) if c.n else ([], np.zeros(0))
    rows, numbers, sizes, log_probs, gumbels, inclusions, same, ids, digests = [empty], [np.ones(len(empty), dtype=np.int32)], [np.zeros(len(empty), dtype=np.int64)], [np.zeros(len(empty))], [np.zeros(len(empty))], [np.zeros(len(empty))], [True] * len(empty), [np.zeros(0, dtype=np.int32)], [hashlib.sha256(b"").hexdigest()] * len(empty)
    for number, (live, edges, log_prob, gumbel) in enumerate(paths, 1):
        own, bounds = _ids(v, c, edges)
        decoded = decode_ids(v, own, bounds)
        little = own.astype("<i4")
        rows.append(live)
        numbers.append(np.full(len(live), number, dtype=np.int32))
        sizes.append(np.diff(bounds)[live])
        log_probs.append(log_prob)
        gumbels.append(gumbel)
        # the chance that a perturbed value is above the first one left out
        gap = np.minimum(log_prob - left[live], 50.0)
        with np.errstate(under="ignore", divide="ignore"):
            inclusions.append(np.where(gap > -30, np.log(-np.expm1(-np.exp(gap))), gap))
        same += [decoded[r] == texts[r] for r in live.tolist()]
        ids.append(own)  # rows that aren't live have none
        if digest:
            digests += [hashlib.sha256(little[bounds[r] : bounds[r + 1]]).hexdigest() for r in live.tolist()]
    size = np.concatenate(sizes)
    names = ["doc_id", "sample", "n_pieces", "log_prob", "gumbel", "log_inclusion", "round_trip", "ids", "ids_sha256"]
    total = len(size)
    return pa.RecordBatch.from_arrays(
        [
            keys.take(pa.array(np.concatenate(rows))),
            pa.array(np.concatenate(numbers)),
            pa.array(size),
            *[pa.array(np.concatenate(x)) for x in (log_probs, gumbels, inclusions)],
            pa.array(same, type=pa.bool_()),
            pa.nulls(total, pa.list_(pa.int32())) if digest else pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(np.concatenate(ids))),
            pa.array(digests, type=pa.string()) if digest else pa.nulls(total, pa.string()),
        ],
        names=names,
    )


def sample_segmentations(docs: DataFrame, k: int = 3, seed: int = 17, model_path: str = DEFAULT_MODEL, scores: str = "rank", digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k`` distinct segmentations of each row's text, in the order of their perturbed values.

    Returns ``doc_id, sample`` (from 1), ``n_pieces, log_prob, gumbel,
    log_inclusion, round_trip`` (decoding gives the text back), ``ids`` and
    ``ids_sha256`` (of the ids as little-endian int32); with ``digest`` the ids
    stay in the task and only their digest is returned, else the digest is null.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("seed"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(
        _sampler(model, k, scores, digest),
        f"doc_id {kind}, sample int, n_pieces long, log_prob double, gumbel double, log_inclusion double, round_trip boolean, ids array<int>, ids_sha256 string",
    )


def decode(encoded: DataFrame, model_path: str = DEFAULT_MODEL, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the decoded ``text`` of its piece ids; null ids give null."""
    with open(model_path, "rb") as f:
        model = f.read()
    schema = encoded.drop("text").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            sizes = np.array([len(x) if x.is_valid else 0 for x in column], dtype=np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            decoded = decode_ids(v, flat, np.concatenate(([0], np.cumsum(sizes))))
            texts = [x.decode(errors="replace") if own else None for x, own in zip(decoded, column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=[*batch.schema.names, "text"])

    return encoded.drop("text").mapInArrow(run, schema)
