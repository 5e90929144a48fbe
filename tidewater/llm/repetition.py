"""Quality rules by suffix-array repetition.

Every text is a sequence of words. A suffix array over the words (prefix doubling)
with its longest-common-prefix values gives the LCP intervals; an interval's value is
the length of a maximal repeated substring and its suffixes are the occurrences. The
spans of all repeats of at least ``min_words`` words are united per text; a text whose
covered fraction or longest repeat passes a limit is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh
from tidewater.llm.textarrays import SPACE, Texts, Words, mix64, range_hashes, slices, sums_by_text, texts, words

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Words in a window of the base rule.
BASE_WINDOW = 5
#: Shortest repeat that counts as covered, the covered fraction and the longest repeat that pass.
MIN_WORDS, MAX_COVERED, MAX_LONGEST = 10, 0.1, 50

SCHEMA = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "covered_words")],
        T.StructField("repeat_spans", T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("words", T.LongType())]))),
    ]
)


def longest_repeats(tokens: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For every token the length of the longest repeat (within its text) that starts there.

    ``tokens``: 64-bit token hashes of consecutive texts; ``text``: the text of each.
    Prefix doubling: a rank counts the positions that sort before the first of a class, and
    after a round two positions share a class when their next ``width`` tokens agree. Only
    positions whose class still has two members go on, so the work shrinks with the repeats.
    Ranks end as the suffix array of the repeated positions. The LCP of two neighbours in it
    is read from the kept classes, largest power first; the innermost LCP interval that a
    suffix lies in has the larger LCP of its two neighbours.
    """
    n = len(tokens)
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    _, inverse, counts = np.unique(mix64(tokens + mix64(text.astype(np.uint64))), return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    repeated = np.flatnonzero(counts[inverse] > 1)
    if not len(repeated):
        return best
    level = np.full(n, -1, dtype=np.int64)
    level[repeated] = rank[repeated]
    levels, alive, width = [level], repeated, 1
    while len(alive):
        ahead = alive + width
        follow = np.zeros(len(alive), dtype=np.int64)  # 0: the text ends here
        inside = np.flatnonzero(ahead < n)
        inside = inside[text[ahead[inside]] == text[alive[inside]]]
        follow[inside] = rank[ahead[inside]] + 1
        by = np.lexsort((follow, rank[alive]))
        at, follow, old = alive[by], follow[by], rank[alive[by]]
        place = np.arange(len(at))
        first_of_class = np.append(True, old[1:] != old[:-1])
        first_of_group = first_of_class | np.append(True, follow[1:] != follow[:-1])
        group_place = np.maximum.accumulate(np.where(first_of_group, place, 0))
        rank[at] = old + group_place - np.maximum.accumulate(np.where(first_of_class, place, 0))
        last_of_group = np.append(first_of_group[1:], True)
        tied = at[~(first_of_group & last_of_group)]
        if len(tied):
            level = np.full(n, -1, dtype=np.int64)
            level[tied] = rank[tied]
            levels.append(level)
        alive, width = np.sort(tied), width * 2
    order = repeated[np.argsort(rank[repeated], kind="stable")]
    i, j = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(i), dtype=np.int64)
    for r in range(len(levels) - 1, -1, -1):
        ok = np.flatnonzero((i < n) & (j < n))
        ci, cj = levels[r][i[ok]], levels[r][j[ok]]
        same = ok[(ci >= 0) & (ci == cj)]
        for x in (i, j, lcp):
            x[same] += 1 << r
    np.maximum.at(best, order[:-1], lcp)
    np.maximum.at(best, order[1:], lcp)
    return best


def covered(best: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in the union of the spans ``[p, p + best[p])`` with ``best[p] >= least``."""
    n = len(best)
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(best >= least)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + best[at], -1)
    return np.cumsum(edge[:-1]) > 0


def line_repeats(t: Texts, w: Words) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(t.data == 0x0A)
    begin = np.unique(np.concatenate([t.start[:-1][np.diff(t.start) > 0], breaks + 1]))
    begin = begin[begin < len(t.data)]
    if not len(begin):
        return np.zeros(t.n, np.int64)
    text = np.searchsorted(t.start, begin, side="right") - 1
    next_break = np.append(breaks, len(t.data))[np.searchsorted(breaks, begin)]
    end = np.minimum(next_break, t.start[text + 1])
    has_word = np.searchsorted(w.begin, end) > np.searchsorted(w.begin, begin)
    begin, end, text = begin[has_word], end[has_word], text[has_word]
    key = mix64(range_hashes(t.data, begin, end) + mix64(text.astype(np.uint64) + np.uint64(1)))
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[earliest] = False
    return np.bincount(text[again], minlength=t.n)


def measure(t: Texts, min_words: int) -> dict[str, np.ndarray | pa.Array]:
    """The columns of SCHEMA for a slice of texts."""
    w = words(t)
    character = ((t.data & 0xC0) != 0x80) & ~SPACE[t.data]
    best = longest_repeats(range_hashes(t.data, w.begin, w.end), w.text)
    mask = covered(best, min_words)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    opens, closes = _split_at_texts(edge[0::2], edge[1::2], w.first)
    span_text = np.searchsorted(w.first, opens, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(opens - w.first[span_text]), pa.array(closes - opens)], names=["word", "words"])
    longest = np.zeros(t.n, np.int64)
    np.maximum.at(longest, w.text, best)
    return {
        "n_words": np.diff(w.first).astype(np.int64),
        "word_chars": sums_by_text(character.astype(np.int64), t.start),
        "n_symbols": sums_by_text(_SYMBOL[t.data].astype(np.int64), t.start),
        "n_dup_lines": line_repeats(t, w),
        "n_repeat_words": sums_by_text(covered(best, BASE_WINDOW).astype(np.int64), w.first),
        "longest_repeat": longest,
        "covered_words": sums_by_text(mask.astype(np.int64), w.first),
        "repeat_spans": pa.ListArray.from_arrays(pa.array(np.searchsorted(span_text, np.arange(t.n + 1)).astype(np.int32)), spans),
    }


def _split_at_texts(opens: np.ndarray, closes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covered runs of neighbouring texts can touch; cut them where a text begins."""
    cuts = first[1:-1]
    run = np.searchsorted(opens, cuts, side="right") - 1
    inside = (run >= 0) & (len(opens) > 0)
    cuts, run = cuts[inside], run[inside]
    cuts = np.unique(cuts[(cuts > opens[run]) & (cuts < closes[run])]) if len(cuts) else cuts
    return np.sort(np.concatenate([opens, cuts])), np.sort(np.concatenate([closes, cuts]))


def repetition(
    df: DataFrame,
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (all but the text by default) with the repetition measures and verdicts of each whole text.

    Added: the columns of SCHEMA, ``base_failed`` (fewer than 10 words, or more than 20 % of the
    words in repeated 5-word windows) and ``kept`` (base passed, at most ``max_covered`` of the words
    inside repeats of ``min_words`` words or more, no repeat longer than ``max_longest`` words).
    Null and empty texts have no words: all measures 0, base failed. Rows are independent, so
    repeated rows get equal results and there is no shuffle; an empty table gives an empty result.
    Input columns named like a measure are left out.
    """
    added = {f.name.lower() for f in SCHEMA.fields} | {"base_failed", "kept"}
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text_col]) if c.lower() not in added]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(fresh("__text", keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            for at, to in slices(column):
                found = measure(texts(column[at:to]), min_words)
                held = [batch.column(i)[at:to] for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*held, *[x if isinstance(x, pa.Array) else pa.array(x) for x in found.values()]], names=[*keep, *found])

    schema = T.StructType([*rows.schema.fields[:-1], *SCHEMA.fields])
    out = rows.mapInArrow(run, schema)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    passed = (F.col("covered_words") <= F.col("n_words") * F.lit(float(max_covered))) & (F.col("longest_repeat") <= max_longest)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)
