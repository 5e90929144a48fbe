"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in vectorised batches; a bounded sample of
labelled rows trains the trees, which are flattened into arrays (a complete binary
tree each) that numpy walks for all rows and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.textarrays import SPACE, Texts, mix64, range_hashes, slices, sums_by_text, texts, words

#: Labelled rows that train the trees at most (those with the smallest hash of their id).
MAX_LABELLED = 20_000
BINS, ROUNDS, DEPTH, RATE, RIDGE, LEAST_LEAF = 64, 80, 4, 0.15, 1.0, 20

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "longest_word", "letters", "upper", "digits", "symbols", "stops", "other_punct",
    "lines_per_word", "symbol_words", "bar_words", "caps_words", "shout_words", "digit_words", "unique_words", "top_word", "same_next",
    "unique_pairs", "top_pair", "unique_fives", "byte_kinds",
)


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER = _set(bytes(range(65, 91)))
_LETTER = _UPPER | _set(bytes(range(97, 123))) | _set(bytes(range(128, 256)))
_DIGIT = _set(b"0123456789")
_SYMBOL = _set(b"#*$%&|<>")
_STOP = _set(b".,;:?!")
_OTHER = ~(_LETTER | _DIGIT | _SYMBOL | _STOP | SPACE)


def statistics(t: Texts) -> np.ndarray:
    """FEATURES of every text, as a float matrix; null and empty texts have zeros."""
    w = words(t)
    n_bytes, n_words = np.diff(t.start).astype(float), np.diff(w.first).astype(float)
    per_byte, per_word = 1.0 / np.maximum(1, n_bytes), 1.0 / np.maximum(1, n_words)
    share = lambda table: sums_by_text(table[t.data].astype(np.int64), t.start) * per_byte
    length = (w.end - w.begin).astype(float)
    mean = sums_by_text(length, w.first) * per_word
    spread = np.sqrt(np.maximum(0, sums_by_text(length * length, w.first) * per_word - mean * mean))
    longest = np.zeros(t.n)
    np.maximum.at(longest, w.text, length)
    last = t.data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    head = t.data[w.begin] if len(w.end) else np.zeros(0, np.uint8)
    of_words = lambda flags: sums_by_text(flags.astype(np.int64), w.first) * per_word
    upper_before = np.concatenate([[0], np.cumsum(_UPPER[t.data])])
    shout = (upper_before[w.end] - upper_before[w.begin] >= 2) if len(w.end) else np.zeros(0, bool)
    hashes = range_hashes(t.data, w.begin, w.end, lower=True)
    unique1, top1 = _distinct(hashes, w.text, t.n)
    pairs, pair_text = _windows(hashes, w.text, 2)
    unique2, top2 = _distinct(pairs, pair_text, t.n)
    fives, five_text = _windows(hashes, w.text, 5)
    unique5, _ = _distinct(fives, five_text, t.n)
    same = (hashes[1:] == hashes[:-1]) & (w.text[1:] == w.text[:-1])
    seen = np.zeros((t.n, 256), dtype=bool)
    seen[np.repeat(np.arange(t.n), np.diff(t.start)), t.data] = True
    return np.column_stack(
        [
            np.log1p(n_bytes), np.log1p(n_words), mean, spread, longest, share(_LETTER), share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_STOP), share(_OTHER),
            sums_by_text((t.data == 0x0A).astype(np.int64), t.start) * per_word, of_words(_SYMBOL[last]), of_words(head == 0x7C), of_words(_UPPER[head]), of_words(shout), of_words(_DIGIT[head]),
            unique1, top1, np.bincount(w.text[1:][same], minlength=t.n) * per_word, unique2, top2, unique5, seen.sum(axis=1).astype(float),
        ]
    )


def _windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` words that lie within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return hashes[:0], text[:0]
    h = hashes[:n]
    for k in range(1, size):
        h = mix64(h * np.uint64(3) + hashes[k : n + k])
    inside = text[:n] == text[size - 1 :]
    return h[inside], text[:n][inside]


def _distinct(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct values, and the commonest value's occurrences, as fractions of all."""
    total = np.maximum(1, np.bincount(text, minlength=n))
    key, first, counts = np.unique(mix64(hashes + mix64(text.astype(np.uint64))), return_index=True, return_counts=True)
    owner = text[first]
    most = np.zeros(n)
    np.maximum.at(most, owner, counts)
    return np.bincount(owner, minlength=n) / total, most / total


class Trees(NamedTuple):
    """Complete trees in heap order: inner node i has children 2i+1 (value <= threshold) and 2i+2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        node = np.zeros((len(x), trees), dtype=np.int64)
        row, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, node - inner].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost logistic loss on histograms of BINS quantile bins. With no rows, or one label only, the base rate answers."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(rate / (1 - rate)))
    inner, leaves, width = 2**DEPTH - 1, 2**DEPTH, x.shape[1]
    if len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    bins = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)])
    cell = bins + np.arange(width) * BINS
    margin = np.full(len(y), base)
    feature, threshold, leaf = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        f_tree, t_tree = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, many = 2**depth - 1, 2**depth
            size = many * width * BINS
            spot = ((node - first)[:, None] * (width * BINS) + cell).ravel()
            shape = (many, width, BINS)
            sums = [np.bincount(spot, weights=np.repeat(v, width), minlength=size).reshape(shape).cumsum(axis=2) for v in (g, h, np.ones(len(y)))]
            gl, hl, nl = sums
            gt, ht, nt = (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain[(nl < LEAST_LEAF) | (nt - nl < LEAST_LEAF)] = -1.0
            flat = gain.reshape(many, -1)
            best = flat.argmax(axis=1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if flat[k, best[k]] > 1e-6 and b < len(edges[f]):
                    f_tree[first + k], t_tree[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), f_tree[node]] > t_tree[node])
        slot = node - inner
        value = -RATE * np.bincount(slot, weights=g, minlength=leaves) / (np.bincount(slot, weights=h, minlength=leaves) + RIDGE)
        margin += value[slot]
        feature.append(f_tree), threshold.append(t_tree), leaf.append(value)
    return Trees(base, np.array(feature), np.array(threshold), np.array(leaf))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_LABELLED) -> Trees:
    """Train on the documents of at most ``max_rows`` labelled ids, chosen by the hash of the id; null labels teach nothing."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id", "__label").limit(max_rows)  # max_rows narrow rows
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).join(F.broadcast(chosen), "__id").select("__label", "__text", "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for at, to in slices(column):
                x = statistics(texts(column[at:to]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], batch.column(2)[at:to].cast(pa.string()), *map(pa.array, x.T)], names=["label", "id", *FEATURES])

    schema = ", ".join(["label double", "id string", *[f"{n} double" for n in FEATURES]])
    rows = rows.mapInArrow(run, schema).orderBy("id", "label", *FEATURES).limit(max_rows)  # repeated documents cannot pass the bound
    table = rows.toArrow()
    x = np.column_stack([table.column(n).to_numpy() for n in FEATURES]) if table.num_rows else np.zeros((0, len(FEATURES)))
    return fit_trees(x, table.column("label").to_numpy())


def score(df: DataFrame, model: Trees, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """``keep`` columns (all but the text by default; add it to keep it) with the score in [0, 1] of each whole text.

    Null and empty texts are scored from zero statistics. Rows are independent, so repeated
    rows score alike; an empty table gives an empty result. An input column named like the score is left out.
    """
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text_col]) if c.lower() != score_col.lower()]
    sent = keep if text_col in keep else [*keep, text_col]
    rows = df.select(*[F.col(f"`{c}`") for c in sent])
    at_text = sent.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at_text)
            for at, to in slices(column):
                found = model.score(statistics(texts(column[at:to])))
                yield pa.RecordBatch.from_arrays([*[batch.column(i)[at:to] for i in range(len(keep))], pa.array(found)], names=[*keep, score_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[: len(keep)], T.StructField(score_col, T.DoubleType())]))
