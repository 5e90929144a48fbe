"""SentencePiece encoding and decoding by Gumbel top-k sampling without replacement.

A text is a lattice of vocabulary pieces. Backward sums give every lattice node the
exact probability of its completions, so a prefix can be given the Gumbel value of its
best completion. A-star search over prefixes ordered by that value emits distinct
segmentations in the order of a perturbed ranking: a sample without replacement.

The search is written with arrival times t = exp(-Gumbel): the completions of a prefix
with log-probability phi arrive first after an exponential time of rate exp(phi), and
splitting a prefix leaves one child with the arrival time while the others start anew
from it. So one emission is a descent that follows the earliest child, and every step
leaves the region of its other children on the frontier with an arrival time of its own.

No piece crosses two bytes that no piece has side by side, so the lattice is a chain of
units between such places (mostly words); units that recur are solved once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh
from tidewater.llm.textarrays import Texts, mix64, range_hasher, range_hashes, slices, texts

#: The vocabulary file; a parameter everywhere, never copied.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Zipf-Mandelbrot offset and exponent that turn a piece's rank into its probability.
OFFSET, EXPONENT = 2.7, 1.0
#: Bytes of text sampled at once.
SLICE_BYTES = 1024 * 1024
#: Lattice nodes of distinct units that a task remembers before it starts over.
MAX_NODES = 1_000_000


class Vocabulary(NamedTuple):
    """Pieces as bytes (the space mark as one space) with ids and log-probabilities."""

    pieces: list[bytes]
    ids: np.ndarray
    logp: np.ndarray
    byte_ids: np.ndarray  # id of every byte's own piece
    byte_logp: float
    spelling: list[bytes]  # by id: what the piece decodes to


def load_vocabulary(path: str = MODEL, offset: float = OFFSET, exponent: float = EXPONENT) -> Vocabulary:
    """Read the model on the driver. A piece's score is minus its rank; its probability is proportional to
    (rank + offset) ** -exponent. Byte pieces, for characters that no piece has, come last in rank.
    Pieces that the model itself never produces (control, unknown, unreachable) take no part."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    mark, n = "▁", m.get_piece_size()
    pieces, ids, rank, byte_ids = [], [], [], np.full(256, -1, dtype=np.int64)
    spelling = [b""] * n
    for i in range(n):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            spelling[i] = bytes([int(piece[1:-1], 16)])
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            spelling[i] = piece.replace(mark, " ").encode()
            if m.get_score(i) > -1e8:
                pieces.append(spelling[i]), ids.append(i), rank.append(-m.get_score(i))
    weight = -exponent * np.log(np.append(rank, n) + offset)
    weight -= np.log(np.exp(weight[:-1]).sum() + 256 * np.exp(weight[-1]))
    return Vocabulary(pieces, np.array(ids), weight[:-1], byte_ids, float(weight[-1]), spelling)


class Lattices:
    """Solved lattices of distinct units, as flat arrays that grow as units are met.

    Node b of a unit is byte b of it; ``edge[node]`` is its first edge and ``fan[node]`` their number.
    An edge has its node ``src``, a byte ``length``, a ``piece``, the probability ``prob`` that a segmentation
    from its node begins with it, and ``below``, the sum of those of the node's earlier edges.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        starts = {p[:k]: -1 for p in v.pieces for k in range(1, len(p))}
        of = {p: i for i, p in enumerate(v.pieces)}
        strings = list(starts | of)
        blob = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum([len(x) for x in strings])
        keys = range_hashes(blob, ends - [len(x) for x in strings], ends)
        self.table = _HashTable(keys, np.array([of.get(x, -1) for x in strings]), np.array([x in starts for x in strings]))
        # bytes that stand side by side in some piece; between others every segmentation has a cut
        self.inside = np.zeros(65536, bool)
        for p in v.pieces:
            raw = np.frombuffer(p, np.uint8).astype(np.int64)
            self.inside[raw[:-1] * 256 + raw[1:]] = True
        self.inside[(np.arange(65536) & 0xC0) == 0x80] = True  # never inside a character
        self.clear()

    def clear(self) -> None:
        self.known, self.known_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.edge, self.fan = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.src, self.length, self.piece = (np.zeros(0, np.int32) for _ in range(3))
        self.below, self.prob = np.zeros(0, np.float64), np.zeros(0, np.float64)

    def look_up(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First node of every unit, solving the units not met before."""
        keys, first, back = np.unique(range_hashes(data, begin, end), return_index=True, return_inverse=True)
        if len(self.edge) > MAX_NODES:
            self.clear()
        at = np.minimum(np.searchsorted(self.known, keys), max(0, len(self.known) - 1))
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            start = self._solve(data, begin[first[new]], end[first[new]])
            known = np.concatenate([self.known, keys[new]])
            order = np.argsort(known)
            self.known, self.known_at = known[order], np.concatenate([self.known_at, start])[order]
            at = np.searchsorted(self.known, keys)
        return self.known_at[at][back]

    def _solve(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - begin
        start = np.cumsum(size) - size
        total = int(size.sum())
        own = np.repeat(np.arange(len(size)), size)
        pos = np.arange(total) - start[own]
        text = data[begin[own] + pos]
        left = size[own] - pos
        # all pieces that match at every byte, growing while some piece has the bytes so far as a prefix
        src, length, piece = [], [], []
        live, k = np.flatnonzero((text & 0xC0) != 0x80), 1
        hashes = range_hasher(text)
        while len(live):
            found, longer = self.table.look_up(hashes(live, live + k))
            hit = found >= 0
            src.append(live[hit]), length.append(np.full(int(hit.sum()), k, np.int64)), piece.append(found[hit])
            k += 1
            live = live[longer & (left[live] >= k)]
        level = [len(x) for x in src]
        src, length, piece = (np.concatenate(x) for x in (src, length, piece))
        ids, logp = self.v.ids[piece], self.v.logp[piece]
        # bytes of characters that have no piece of their own
        lead = (text & 0xC0) != 0x80
        char = np.cumsum(lead) - 1
        char_bytes = np.bincount(char, minlength=1)
        whole = np.zeros(len(char_bytes), dtype=bool)
        whole[char[src[length == char_bytes[char[src]]]]] = True
        lone = np.zeros(0, np.int64) if whole.all() else np.flatnonzero(~whole[char])
        src = np.concatenate([src, lone])
        length = np.concatenate([length, np.ones(len(lone), np.int64)])
        ids = np.concatenate([ids, self.v.byte_ids[text[lone]]])
        logp = np.concatenate([logp, np.full(len(lone), self.v.byte_logp)])
        # backward sums, from each unit's end; edges in order of their source
        fan = np.bincount(src, minlength=total)
        edge = np.cumsum(fan) - fan
        by, filled, at = np.empty(len(src), np.int64), edge.copy(), 0
        for many in [*level, len(lone)]:  # a node has one edge of a level at most
            part = src[at : at + many]
            by[filled[part]] = np.arange(at, at + many)
            filled[part] += 1
            at += many
        src, length, ids, logp = src[by], length[by], ids[by], logp[by]
        beta = np.full(total + 1, -np.inf)
        by_left = np.argsort(left, kind="stable")
        by_left = by_left[fan[by_left] > 0]
        bounds = np.flatnonzero(np.diff(left[by_left], prepend=-1, append=-1))
        stops = length == left[src]
        for a, b in zip(bounds[:-1], bounds[1:]):
            nodes = by_left[a:b]
            count = fan[nodes]
            rows = np.repeat(edge[nodes] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            ahead = np.where(stops[rows], 0.0, beta[src[rows] + length[rows]])
            beta[nodes] = np.logaddexp.reduceat(logp[rows] + ahead, np.cumsum(count) - count)
        ahead = np.where(stops, 0.0, beta[src + length])
        prob = np.exp(logp + ahead - beta[src])
        keep = prob > 0  # an edge that leads nowhere
        src, length, ids, prob = src[keep], length[keep], ids[keep], prob[keep]
        fan = np.bincount(src, minlength=total)
        edge = np.cumsum(fan) - fan
        run = np.cumsum(prob)
        below = run - prob - (run[edge[src]] - prob[edge[src]])
        base, edge_base = len(self.edge), len(self.length)
        self.edge = np.concatenate([self.edge, edge + edge_base])
        self.fan = np.concatenate([self.fan, fan])
        self.src = np.concatenate([self.src, (src + base).astype(np.int32)])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        self.piece = np.concatenate([self.piece, ids.astype(np.int32)])
        self.below, self.prob = np.concatenate([self.below, np.maximum(0, below)]), np.concatenate([self.prob, prob])
        return start + base


class _HashTable:
    """Values by 64-bit hashes that are known to be well mixed: slots by their top bits, collisions in further levels."""

    BITS = 18

    def __init__(self, keys: np.ndarray, value: np.ndarray, flag: np.ndarray):
        self.levels = []
        todo, shift = np.arange(len(keys)), 64 - self.BITS
        while len(todo):
            slot = ((keys[todo] >> np.uint64(shift)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key, val, flg = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32), np.zeros(1 << self.BITS, bool)
            mine = todo[first]
            key[slot[first]], val[slot[first]], flg[slot[first]] = keys[mine], value[mine], flag[mine]
            self.levels.append((shift, key, val, flg))
            todo, shift = np.delete(todo, first), (shift - self.BITS) % (64 - self.BITS)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value and flag of every hash; -1 and False for those not in the table."""
        value, flag, todo = np.full(len(h), -1, np.int64), np.zeros(len(h), bool), np.arange(len(h))
        for shift, key, val, flg in self.levels:
            slot = ((h[todo] >> np.uint64(shift)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)
            same = key[slot] == h[todo]
            value[todo[same]], flag[todo[same]] = val[slot[same]], flg[slot[same]]
            todo = todo[~same & (key[slot] != 0)]  # an empty slot: no key of these bits
        return value, flag


def units(t: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the units, and ``first[i]``..``first[i + 1]``: those of text i. A unit ends between two
    bytes that no piece has side by side."""
    n = len(t.data)
    cut = np.zeros(n, dtype=bool)
    if n:
        cut[1:] = ~inside[t.data[:-1].astype(np.int64) * 256 + t.data[1:]]
        cut[t.start[:-1][np.diff(t.start) > 0]] = True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], n) if n else begin
    return begin, end, np.searchsorted(begin, t.start)


def uniform(seed: np.ndarray, counter: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from a row's seed and a counter within the row."""
    bits = mix64(seed + counter.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix64(np.array([salt], np.uint64)))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Path(NamedTuple):
    """The d-th segmentations of a slice: per piece its place (byte of the slice), its edge and the
    log-probability before it; ``lo[x]``: where those of text x begin."""

    place: np.ndarray
    edge: np.ndarray
    before: np.ndarray
    lo: np.ndarray


class Head(NamedTuple):
    """A kept prefix: the unit and place where the descent goes on, and the prefix's places and edges."""

    unit: int
    place: int
    places: np.ndarray
    edges: np.ndarray


def _descend(lat: Lattices, node: np.ndarray, place: np.ndarray, stop: np.ndarray, seed: np.ndarray, origin: np.ndarray, salt: int) -> list[tuple[np.ndarray, ...]]:
    """Follow the earliest child from every (node, place) to the byte ``stop`` of its unit, all units in step."""
    out, live = [], np.arange(len(node))
    node, place = node.copy(), place.copy()
    while len(live):
        chosen, fan = lat.edge[node[live]], lat.fan[node[live]]
        more = np.flatnonzero(fan > 1)
        who = live[more]
        u, last = uniform(seed[who], place[who] - origin[who], salt), chosen[more] + fan[more] - 1
        while len(more):
            ahead = chosen[more] + 1
            up = np.flatnonzero(u >= lat.below[ahead])
            more, u, last, ahead = more[up], u[up], last[up], ahead[up]
            chosen[more] = ahead
            up = np.flatnonzero(ahead < last)
            more, u, last = more[up], u[up], last[up]
        out.append((live, place[live], chosen))
        width = lat.length[chosen]
        node[live] += width
        place[live] += width
        live = live[place[live] < stop[live]]
    return out


def _assemble(found: list[tuple[np.ndarray, ...]], many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of all units put in order: unit, place and edge of every piece."""
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    count = np.zeros(many, np.int64)
    for live, _, _ in found:
        count[live] += 1
    start = np.cumsum(count) - count
    total = int(count.sum())
    unit, place, edge = (np.empty(total, np.int64) for _ in range(3))
    for k, (live, p, e) in enumerate(found):
        spot = start[live] + k
        unit[spot], place[spot], edge[spot] = live, p, e
    return unit, place, edge


class Sample(NamedTuple):
    """The d-th segmentations: ``text`` (ascending), ``first``: each one's bounds in ``ids``."""

    text: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    log_prob: np.ndarray  # under the lattice's own distribution over segmentations
    log_time: np.ndarray  # log arrival time: minus the perturbed log-probability


def sample(lat: Lattices, t: Texts, seeds: np.ndarray, k: int) -> tuple[list[Sample], np.ndarray]:
    """The first k arrivals of every text and the log arrival time of the next one (infinite where none is left)."""
    begin, end, first_unit = units(t, lat.inside)
    node = lat.look_up(t.data, begin, end) if len(begin) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(t.n), np.diff(first_unit))
    origin = t.start[:-1]
    out: list[Sample] = []
    paths: list[Path] = []
    frontier: list[list[tuple]] = [[] for _ in range(t.n)]  # per text: (log time, descent, step, edges used up)
    heads: dict[int, Head] = {}
    now = np.arange(t.n)
    log_time = np.log(-np.log(uniform(seeds, np.zeros(t.n, np.int64), 0)))
    for d in range(k):
        place, edge, bounds, new = _segment(lat, now, heads, begin, end, node, first_unit, owner, origin, seeds, 2 * d + 1)
        log_p = np.log(lat.prob[edge])
        run = np.concatenate([[0.0], np.cumsum(log_p)])
        before = run[:-1] - np.repeat(run[bounds[:-1]], np.diff(bounds))
        total = run[bounds[1:]] - run[bounds[:-1]]
        out.append(Sample(now, bounds, lat.piece[edge], total, log_time[now].copy()))
        lo = np.zeros(t.n, np.int64)
        lo[now] = bounds[:-1]
        paths.append(Path(place, edge, before, lo))
        # The other children of each new step start from this arrival. A text needs at most k - d of these regions.
        text = np.repeat(now, np.diff(bounds))
        rest = 1.0 - lat.prob[edge]
        open_ = np.flatnonzero(new & (rest > 1e-12) & (lat.fan[lat.src[edge]] > 1))
        wait = np.full(len(edge), np.inf)
        u = uniform(seeds[text[open_]], place[open_] - origin[text[open_]], 2 * d + 2)
        wait[open_] = np.log(-np.log(u)) - before[open_] - np.log(rest[open_])
        for _ in range(k - d):
            low = _least(wait, bounds)
            rows = np.flatnonzero(low >= 0)
            for x, s, w in zip(now[rows].tolist(), low[rows].tolist(), wait[low[rows]].tolist()):
                frontier[x].append((float(np.logaddexp(log_time[x], w)), d, s, (int(edge[s]),)))
            wait[low[rows]] = np.inf
        if d + 1 == k:
            break
        going = [x for x in now.tolist() if frontier[x]]
        heads = _pop(lat, frontier, going, paths, seeds, origin, begin, log_time, d)
        now = np.array(sorted(heads), dtype=np.int64)
        if not len(now):
            break
    return out, np.array([min((f[0] for f in fs), default=np.inf) for fs in frontier])


def _segment(lat, now, heads, begin, end, node, first_unit, owner, origin, seeds, salt):
    """Places and edges of the segmentations of the texts ``now``, their bounds, and which steps are new:
    all units from each text's head on are sampled in step, the head's prefix is kept."""
    unit_from = first_unit[now].copy()
    for row, x in enumerate(now.tolist()):
        if x in heads:
            unit_from[row] = heads[x].unit
    counts = first_unit[now + 1] - unit_from
    row_first = np.cumsum(counts) - counts
    rows = np.repeat(unit_from - row_first, counts) + np.arange(counts.sum())
    nodes, places = node[rows], begin[rows].copy()
    for row, x in enumerate(now.tolist()):
        if x in heads:
            nodes[row_first[row]] += heads[x].place - begin[heads[x].unit]
            places[row_first[row]] = heads[x].place
    go = places < end[rows]
    rows, nodes, places = rows[go], nodes[go], places[go]
    who = owner[rows]
    found = _descend(lat, nodes, places, end[rows], seeds[who], origin[who], salt)
    unit, place, edge = _assemble(found, len(rows))
    text, new = who[unit], np.ones(len(unit), bool)
    if heads:
        kept = [heads[x] for x in now.tolist() if x in heads]
        text = np.concatenate([text, np.repeat([x for x in now.tolist() if x in heads], [len(h.places) for h in kept])])
        place = np.concatenate([place, *[h.places for h in kept]])
        edge = np.concatenate([edge, *[h.edges for h in kept]])
        new = np.concatenate([new, np.zeros(len(text) - len(new), bool)])
        by = np.argsort(place, kind="stable")  # places ascend with the texts of the slice
        text, place, edge, new = text[by], place[by], edge[by], new[by]
    return place, edge, np.append(np.searchsorted(text, now), len(text)), new


def _pop(lat: Lattices, frontier: list, going: list[int], paths: list[Path], seeds, origin, begin, log_time, d: int) -> dict[int, Head]:
    """Take each text's earliest region off its frontier, pick the region's earliest child, and put back what is left."""
    taken = [frontier[x].pop(min(range(len(frontier[x])), key=frontier[x].__getitem__)) for x in going]
    place = np.array([paths[at].place[s] for _, at, s, _ in taken], np.int64)
    before = [float(paths[at].before[s]) for _, at, s, _ in taken]
    src = lat.src[np.array([paths[at].edge[s] for _, at, s, _ in taken], np.int64)]
    unit = np.searchsorted(begin, place, side="right") - 1
    who = np.array(going, np.int64)
    u1, u2 = (uniform(seeds[who], place - origin[who], salt + 2 * d).tolist() for salt in (1_000_000, 1_000_001))
    heads = {}
    rows = zip(going, taken, place.tolist(), lat.edge[src].tolist(), lat.fan[src].tolist(), unit.tolist(), before, u1, u2)
    for x, (log_t, at, s, used), p, edge, fan, n, lead, one, two in rows:
        edges = [e for e in range(edge, edge + fan) if e not in used]
        probs = [float(lat.prob[e]) for e in edges]
        total, run = sum(probs), 0.0
        chosen = edges[-1]
        for e, q in zip(edges, probs):
            run += q
            if one * total < run:
                chosen = e
                break
        left = total - float(lat.prob[chosen])
        if len(edges) > 1 and left > 1e-12:
            wait = math.log(-math.log(two)) - lead - math.log(left)
            frontier[x].append((float(np.logaddexp(log_t, wait)), at, s, (*used, chosen)))
        path, lo = paths[at], int(paths[at].lo[x])
        heads[x] = Head(n, p + int(lat.length[chosen]), path.place[lo : s + 1], np.append(path.edge[lo:s], chosen))
        log_time[x] = log_t
    return heads


def _least(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the least value between every two bounds, -1 where none is finite."""
    out = np.full(len(first) - 1, -1, dtype=np.int64)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        low = np.minimum.reduceat(values, first[:-1][full])
        hit = np.flatnonzero(values == np.repeat(low, np.diff(first)[full]))
        hit = hit[np.isfinite(values[hit])][::-1]
        out[np.searchsorted(first, hit, side="right") - 1] = hit
    return out


def log_inclusion(log_prob: np.ndarray, log_next: np.ndarray) -> np.ndarray:
    """Log of the probability that a segmentation arrives before the first one left out: log(1 - exp(-p * t))."""
    z = log_prob + log_next
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(z < -20, z, np.log(-np.expm1(-np.exp(np.minimum(z, 700.0)))))


def with_prefix(t: Texts) -> Texts:
    """The texts with the space that SentencePiece puts before each non-empty one."""
    size = np.diff(t.start)
    full = (size > 0).astype(np.int64)
    data = np.insert(t.data, t.start[:-1][full > 0], 0x20)
    return Texts(data, np.concatenate([[0], np.cumsum(size + full)]), t.null)


def spell(ids: np.ndarray, first: np.ndarray, spelling: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the id sequences, each with its leading space, and their bounds."""
    blob = np.frombuffer(b"".join(spelling), np.uint8)
    size = np.array([len(x) for x in spelling], np.int64)
    at = np.cumsum(size) - size
    width = size[ids]
    run = np.concatenate([[0], np.cumsum(width)])
    return blob[np.repeat(at[ids] - run[:-1], width) + np.arange(run[-1])], run[first]


FIELDS = (
    T.StructField("sample", T.IntegerType()),
    T.StructField("pieces", T.ArrayType(T.IntegerType())),
    T.StructField("n_pieces", T.LongType()),
    T.StructField("log_prob", T.DoubleType()),
    T.StructField("perturbed", T.DoubleType()),
    T.StructField("log_inclusion", T.DoubleType()),
    T.StructField("round_trip", T.BooleanType()),
)


def encode_samples(
    df: DataFrame,
    k: int = 2,
    text_col: str = "text",
    key_col: str = "doc_id",
    model_file: str = MODEL,
    seed: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """Up to ``k`` distinct segmentations of every whole text, sampled without replacement: a row each.

    Added to the ``keep`` columns (all but the text by default): ``sample`` (0 first), ``pieces``
    (ids), ``n_pieces``, ``log_prob`` (of the segmentation given the text), ``perturbed`` (its Gumbel-perturbed
    log-probability, descending in ``sample``), ``log_inclusion`` (log of its inclusion probability given the
    first value left out: importance weights are exp(log_prob - log_inclusion)) and ``round_trip`` (the pieces
    decode to the text, byte for byte). The draw depends on ``seed`` and the row's key alone, so equal keys with
    equal texts sample alike; a null key is a key like others. An empty text has one segmentation, without
    pieces; a null text has one row with null results. Texts with fewer than k segmentations give all they
    have. An empty table gives an empty result. Input columns named like a result are left out.
    """
    added = {f.name for f in FIELDS}
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text_col]) if c.lower() not in added]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64(F.lit(seed), F.col(f"`{key_col}`")).alias(fresh("__seed", keep)), F.col(f"`{text_col}`").alias(fresh("__text", keep)))
    vocabulary = load_vocabulary(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattices(vocabulary)
        for batch in batches:
            seeds = mix64(batch.column(len(keep)).to_numpy().view(np.uint64))
            column = batch.column(len(keep) + 1)
            held = batch.select(list(range(len(keep))))
            for at, to in slices(column, SLICE_BYTES):
                t = with_prefix(texts(column[at:to]))
                found, following = sample(lat, t, seeds[at:to], k)
                for d, s in enumerate(found):
                    yield _result(held.slice(at, to - at), t, d, s, following, vocabulary.spelling)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-2], *FIELDS]))


def _result(held: pa.RecordBatch, t: Texts, d: int, s: Sample, following: np.ndarray, spelling: list[bytes]) -> pa.RecordBatch:
    """The d-th segmentations as rows; ``t``: the texts with their leading space."""
    data, bounds = spell(s.ids, s.first, spelling)
    if len(s.text) == t.n and np.array_equal(bounds, t.start) and np.array_equal(data, t.data):
        round_trip = np.ones(t.n, bool)
    else:
        own = zip(bounds[:-1], bounds[1:], s.text.tolist())
        round_trip = np.array([np.array_equal(data[a:b], t.data[t.start[x] : t.start[x + 1]]) for a, b, x in own], bool)
    gone = t.null[s.text]
    mask = pa.array(gone)
    columns = [
        pa.array(np.full(len(s.text), d, np.int32)),
        pa.ListArray.from_arrays(pa.array(s.first.astype(np.int32)), pa.array(s.ids.astype(np.int32)), mask=mask),
        pa.array(np.diff(s.first), mask=gone),
        pa.array(s.log_prob, mask=gone),
        pa.array(-s.log_time, mask=gone),
        pa.array(log_inclusion(s.log_prob, following[s.text]), mask=gone),
        pa.array(round_trip, mask=gone),
    ]
    kept = held.take(pa.array(s.text))
    return pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, *[f.name for f in FIELDS]])


def decode_pieces(df: DataFrame, pieces_col: str = "pieces", out_col: str = "decoded", model_file: str = MODEL) -> DataFrame:
    """Append the text that each row's piece ids spell. Null ids give null; ids of control pieces or outside the
    vocabulary spell nothing; bytes that are no UTF-8 become U+FFFD. A column of that name is replaced."""
    names = [c for c in df.columns if c.lower() != out_col.lower()]
    rows = df.select(*[F.col(f"`{c}`") for c in names])
    spelling = load_vocabulary(model_file).spelling
    at = names.index(pieces_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            out = []
            for ids in column:
                if not ids.is_valid:
                    out.append(None)
                    continue
                known = [i for i in (ids.as_py() or ()) if i is not None and 0 <= i < len(spelling)]
                raw = b"".join(spelling[i] for i in known)
                out.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, out_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))
