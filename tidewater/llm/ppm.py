"""Language identification by prediction by partial matching over bytes.

Training counts, for every language, each byte with the three bytes before it; these
counts are the order-3 context tree, and its shorter contexts are their sums. Scoring
charges every byte of a text the exact code length of PPM with escape method C and
full exclusion under the frozen counts; the language with the shortest total code wins.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh, materialize
from tidewater.llm.textarrays import Texts, slices, texts

ORDER = 3
#: Most order-3 nodes of all languages that are handled at once; larger trees are cut into parts and no node is lost.
MAX_NODES = 500_000
#: Values of the two bytes before a byte; parts are ranges of them.
PAIRS = 1 << 16
UNDETERMINED = "und"


def grams(t: Texts) -> np.ndarray:
    """For each byte the four bytes ending there as one uint32; zeros stand before a text's start."""
    n = len(t.data)
    out = t.data.astype(np.uint32)
    place = np.arange(n) - np.repeat(t.start[:-1], np.diff(t.start))
    for back in range(1, ORDER + 1):
        if n > back:
            shifted = t.data[:-back].astype(np.uint32) << np.uint32(8 * back)
            out[back:] |= np.where(place[back:] >= back, shifted, np.uint32(0))
    return out


def count_grams(rows: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all rows; counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.asarray(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                column = batch.column(0).filter(pa.array(langs == lang))
                for at, to in slices(column):
                    keys, n = np.unique(grams(texts(column[at:to])), return_counts=True)
                    if lang in held:
                        keys, back = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                        n = np.bincount(back, weights=np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = keys, n
                    if len(keys) > 2_000_000:  # hand on what has gathered; the sums are made after the shuffle
                        yield _counted(lang, *held.pop(lang))
        for lang, (keys, n) in held.items():
            yield _counted(lang, keys, n)

    picked = rows.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).dropna()
    return picked.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(lang: str, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


class Tree:
    """One language's frozen counts: for order k the sorted (k+1)-byte nodes, their counts, and per k-byte
    context its total, its distinct bytes, and the same of its shorter context without the bytes seen here.
    ``low``: the two-byte nodes of the whole language, where ``keys`` are those of one part."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.nodes: list[tuple[np.ndarray, np.ndarray]] = []
        for order in range(ORDER + 1):
            long, times = low if low is not None and order < 2 else (keys, n)
            short = long & np.uint32((1 << (8 * (order + 1))) - 1 & 0xFFFFFFFF)
            node, back = np.unique(short, return_inverse=True)
            self.nodes.append((node, np.bincount(back, weights=times) if len(times) else np.zeros(0)))
        self.contexts = []
        for order in range(ORDER + 1):
            node, count = self.nodes[order]
            ctx, back = np.unique(node >> np.uint32(8), return_inverse=True)
            total = np.bincount(back, weights=count, minlength=len(ctx))
            distinct = np.bincount(back, minlength=len(ctx)).astype(float)
            if order:  # mass that the shorter context gives to the bytes seen in this one
                lower = self._find(order - 1, node & np.uint32((1 << (8 * order)) - 1))
                hidden = np.bincount(back, weights=self.nodes[order - 1][1][lower], minlength=len(ctx))
            else:
                hidden = np.zeros(len(ctx))
            self.contexts.append((ctx, total, distinct, hidden))

    def _find(self, order: int, key: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.nodes[order][0], key)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code length in bits of the last byte of each four-byte key after the three before it."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        hidden, gone = np.zeros(len(keys)), np.zeros(len(keys))  # excluded mass and bytes at this order
        for order in range(ORDER, -1, -1):
            key = keys[todo] & np.uint32((1 << (8 * (order + 1))) - 1 & 0xFFFFFFFF)
            ctx, total, distinct, below = self.contexts[order]
            at = np.minimum(np.searchsorted(ctx, key >> np.uint32(8)), max(0, len(ctx) - 1))
            known = ctx[at] == key >> np.uint32(8) if len(ctx) else np.zeros(len(key), bool)
            node, count = self.nodes[order]
            spot = np.minimum(np.searchsorted(node, key), max(0, len(node) - 1))
            seen = node[spot] == key if len(node) else np.zeros(len(key), bool)
            mass = np.where(known, total[at] - hidden[todo], 0.0) if len(ctx) else np.zeros(len(key))
            kinds = np.where(known, distinct[at] - gone[todo], 0.0) if len(ctx) else np.zeros(len(key))
            whole = np.maximum(mass + kinds, 1e-300)
            hit = np.flatnonzero(seen)
            out[todo[hit]] -= np.log2(count[spot[hit]] / whole[hit])
            miss = np.flatnonzero(~seen)
            cost = np.where(known & (kinds > 0), -np.log2(np.maximum(kinds, 1e-300) / whole), 0.0)
            out[todo[miss]] += cost[miss]
            step = miss[known[miss]]
            hidden[todo[step]], gone[todo[step]] = below[at[step]] if order else 0.0, distinct[at[step]]
            todo = todo[miss]
            if not len(todo):
                return out
        # order -1: the bytes never seen in this language are equally likely
        out[todo] += np.log2(np.maximum(1.0, 256.0 - gone[todo]))
        return out


Counts = dict[str, tuple[np.ndarray, np.ndarray]]


class Model:
    """The trees of all languages and, for each key any of them has, its code lengths; or the part of
    them that codes the bytes after two bytes in the range ``pairs``, with the two-byte nodes ``low`` of all."""

    def __init__(self, counts: Counts, low: Counts | None = None, pairs: tuple[int, int] = (0, PAIRS)):
        self.langs, self.pairs = sorted(counts if low is None else low), pairs
        none = np.zeros(0, np.uint32), np.zeros(0)
        typed = lambda pair: (pair[0].astype(np.uint32), pair[1].astype(float))
        self.trees = [Tree(*typed(counts.get(x, none)), typed(low[x]) if low is not None else None) for x in self.langs]
        self.keys = np.unique(np.concatenate([t.nodes[ORDER][0] for t in self.trees])) if self.trees else np.zeros(0, np.uint32)
        self.table = [t.bits(self.keys) for t in self.trees]

    def code_lengths(self, t: Texts) -> np.ndarray:
        """Total bits of every text (rows) in every language (columns), of this part's bytes."""
        keys = grams(t)
        total = np.zeros((t.n, len(self.langs)))
        if not len(keys) or not self.langs:
            return total
        mine = slice(None)
        if self.pairs != (0, PAIRS):
            pair = (keys >> np.uint32(8)) & np.uint32(PAIRS - 1)
            mine = np.flatnonzero((pair >= self.pairs[0]) & (pair < self.pairs[1]))
            keys = keys[mine]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        rare = np.flatnonzero(self.keys[at] != keys)
        distinct, back = np.unique(keys[rare], return_inverse=True)
        full = np.flatnonzero(np.diff(t.start) > 0)
        every = np.zeros(len(t.data))
        for i, tree in enumerate(self.trees):
            bits = self.table[i][at]
            bits[rare] = tree.bits(distinct)[back]
            every[mine] = bits
            total[full, i] = np.add.reduceat(every, t.start[:-1][full])
        return total


class Parts(NamedTuple):
    """A model in parts that together are all trees; each is sent to the executors on its own."""

    langs: list[str]
    parts: list[Broadcast]


def _load(part: Broadcast) -> Model:
    """One part, read from the executor's disk; the worker does not hold it for the next time."""
    model = pickle.loads(part.value)
    if hasattr(part, "_path"):
        vars(part).pop("_value", None)
    return model


def _by_lang(rows: pa.Table) -> Counts:
    coded = rows.column("lang").combine_chunks().dictionary_encode()
    code, keys, n = coded.indices.to_numpy(), rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    return {lang: (keys[code == i], n[code == i]) for i, lang in enumerate(coded.dictionary.to_pylist())}


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_nodes: int = MAX_NODES) -> Parts:
    """Counts over all labelled rows (null texts and languages teach nothing); every node of every language
    stays. The counts are a written table, cut by the two bytes before each byte into parts of about
    ``max_nodes`` nodes (fewer beside many languages), which bounds what the driver and a worker hold;
    a byte's code length needs the nodes of one part and the two-byte nodes, which every part has."""
    counts = count_grams(labelled, text_col, lang_col).withColumn("pair", F.shiftright("gram", 8).bitwiseAND(F.lit(PAIRS - 1)))
    nodes = materialize(counts.sortWithinPartitions("pair"), "ppm-nodes")
    low = _by_lang(nodes.groupBy("lang", F.col("gram").bitwiseAND(F.lit(PAIRS - 1)).alias("gram")).agg(F.sum("n").alias("n")).toArrow())
    if not low:
        return Parts([], [])
    most = max_nodes * 8 // max(8, len(low))
    cuts, held = [0], 0
    for pair, size in nodes.groupBy("pair").count().orderBy("pair").collect():
        if held and held + size > most:
            cuts.append(pair)
            held = 0
        held += size
    parts = []
    for pairs in zip(cuts, [*cuts[1:], PAIRS]):
        rows = nodes.where((F.col("pair") >= pairs[0]) & (F.col("pair") < pairs[1])).select("lang", "gram", "n").toArrow()
        parts.append(labelled.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Model(_by_lang(rows), low, pairs))))
    return Parts(sorted(low), parts)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(df: DataFrame, model: Parts, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but the text by default) with ``lang_pred``, ``score`` and ``bits_per_byte`` of the whole text.

    ``score`` is the predicted language's share of the probabilities 2**-bits of all languages.
    Texts that are null or have no letter are ``und`` with score 0, as is everything when no language
    was learned; equal code lengths go to the language that sorts first. Rows are independent; an
    empty table gives an empty result. Input columns named like a result are left out.
    """
    added = {"lang_pred", "score", "bits_per_byte"}
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text_col]) if c.lower() not in added]
    text = F.col(f"`{text_col}`")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.when(has_letter(text), text).alias(fresh("__text", keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, parts = model
        names = np.asarray([*langs, UNDETERMINED], dtype=object)
        only = _load(parts[0]) if len(parts) == 1 else None
        for batch in batches:
            column = batch.column(len(keep))
            cuts = list(slices(column))
            sums = [np.zeros((to - at, len(langs))) for at, to in cuts]
            for part in parts:
                m = only or _load(part)
                for total, (at, to) in zip(sums, cuts):
                    total += m.code_lengths(texts(column[at:to]))
            for bits, (at, to) in zip(sums, cuts):
                t = texts(column[at:to])
                lens = np.maximum(1, np.diff(t.start))
                if langs:
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(t.n), best]
                    share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                else:
                    best, least, share = np.zeros(t.n, np.int64), np.zeros(t.n), np.zeros(t.n)
                lost = t.null | (len(langs) == 0)
                best = np.where(lost, len(langs), best)
                out = [pa.array(names[best], pa.string()), pa.array(np.where(lost, 0.0, share)), pa.array(np.where(lost, 0.0, least / lens))]
                held = [batch.column(i)[at:to] for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*held, *out], names=[*keep, "lang_pred", "score", "bits_per_byte"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    return rows.mapInArrow(run, schema)
