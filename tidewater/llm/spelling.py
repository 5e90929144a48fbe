"""Spelling variants: words one edit apart, by reduced-alphabet neighbourhood generation.

Letters are hashed to a few symbols. Two words one edit apart have reduced words at most one edit apart, so the
full one-edit neighbourhood of every reduced word is generated over the few symbols and joined with
the reduced vocabulary; what meets is verified on the words themselves.

Reduced words are 64-bit polynomial hashes, so a neighbour costs a few operations on prefix and suffix sums.
Neighbours that no reduced word can equal are dropped by a bit table of fixed size before the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bit_table, materialize, table_bits
from tidewater.llm.textarrays import mix64

LETTERS = "a-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Neighbours generated at once.
SLICE = 1 << 20

_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31) -> DataFrame:
    """``word``, ``n``: the words of at least ``least`` code points and how often they occur.

    A word is a maximal run of letters with A-Z lower-cased. Where ``every`` divides the crc32 of ``<id>:<run>``, the
    run loses its code point at crc32 mod length, like a typing error. A null id counts as the text
    ``null``. Null and empty texts have no words. Occurrences are summed per task before the shuffle."""
    text = F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    size = F.length("run")
    cut = F.pmod("h", size).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, size))
    word = F.when(F.pmod("h", F.lit(every)) == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def symbols_for(n: int, least: int = 7) -> int:
    """Symbols for a vocabulary of ``n`` words of at least ``least`` letters: the words of that length then have about as
    many reduced forms as there are words, so a neighbour meets few words at any size of the vocabulary."""
    return int(np.clip(np.ceil(1.1 * max(n, 1) ** (1 / least)), 4, 64))


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each word starts."""
    flat = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    size = np.fromiter((len(w) for w in column.to_pylist()), dtype=np.int64, count=len(column))
    return flat, np.concatenate([[0], np.cumsum(size)])


def _reduced(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols 1..``symbols``."""
    return mix64(codes.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def reduced_keys(column: pa.Array, symbols: int) -> np.ndarray:
    """The hash of every reduced word: symbol i times base ** i, summed modulo 2**64."""
    codes, start = _codes(column)
    size = np.diff(start)
    place = np.arange(len(codes)) - np.repeat(start[:-1], size)
    terms = _reduced(codes, symbols) * _powers(int(size.max(initial=0)) + 1)[place]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mix64(total[start[1:]] - total[start[:-1]])


def neighbours(sym: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of the reduced words of equal length in ``sym`` and of everything one edit from each, every distinct one once."""
    n, size = sym.shape
    power = _powers(size + 2)
    terms = sym * power[:size]
    before = np.zeros((n, size + 1), np.uint64)  # sum of the terms before a place
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    yield np.arange(n), mix64(whole[:, 0])
    step = max(1, SLICE // max(1, n * (2 * symbols + 1)))
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    for a in range(0, size + 1, step):
        p = np.arange(a, min(a + step, size))
        here = sym[:, p]
        # deletions: of a run of equal symbols only the first
        runs = np.ones(here.shape, bool)
        runs[:, p > 0] = here[:, p > 0] != sym[:, p[p > 0] - 1]
        gone = before[:, p] + (whole - before[:, p + 1]) * _BASE_INVERSE
        yield np.nonzero(runs)[0], mix64(gone[runs])
        # replacements by every other symbol
        other = letters[None, None] != here[:, :, None]
        new = whole[:, :, None] + (letters[None, None] - here[:, :, None]) * power[p][None, :, None]
        yield np.nonzero(other)[0], mix64(new[other])
        # insertions before a place of every symbol but the one there, and at the end of every symbol
        p = np.arange(a, min(a + step, size + 1))
        room = np.ones((n, len(p), symbols), bool)
        inside = p < size
        room[:, inside] = letters[None, None] != sym[:, p[inside]][:, :, None]
        new = before[:, p][:, :, None] + letters[None, None] * power[p][None, :, None] + ((whole - before[:, p]) * _BASE)[:, :, None]
        yield np.nonzero(room)[0], mix64(new[room])


def _keyed(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = reduced_keys(batch.column(0), symbols).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*batch.schema.names, "key"])

    return run


def _expand(symbols: int, table: np.ndarray):
    """(key, word) for every neighbour of every reduced word that the bit table lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            codes, start = _codes(column)
            sym, size = _reduced(codes, symbols), np.diff(start)
            for length in np.unique(size):
                rows = np.flatnonzero(size == length)
                step = max(1, SLICE // int((2 * symbols + 1) * (length + 1)))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    for row, key in neighbours(sym[start[some][:, None] + np.arange(length)], symbols):
                        bit = key & np.uint64(8 * len(table) - 1)
                        hit = (table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        if hit.any():
                            yield pa.RecordBatch.from_arrays([pa.array(key[hit].view(np.int64)), column.take(pa.array(some[row[hit]]))], names=["key", "word"])

    return run


def _bits(keyed: DataFrame, n: int) -> np.ndarray:
    """The bit table of the reduced words' hashes as bytes."""
    found = bit_table(keyed, "key", n).toArrow()  # bounded rows
    table = np.zeros(table_bits(n) // 64, np.int64)
    table[found.column("__at").to_numpy()] = found.column("__bits").to_numpy()
    return table.view(np.uint8)


def variants(vocabulary: DataFrame, times: int = 10, symbols: int | None = None) -> DataFrame:
    """Every word of ``vocabulary`` (``word``, ``n``; distinct, not null) with its group.

    Words are near if one inserted, deleted or replaced code point tells them apart. ``n_near`` counts a word's near words
    and ``form`` is the one with the largest n (ties: first in code-point order) if that n is at least ``times``
    the word's, else null; ``form_n`` is its n. ``root`` follows forms to the last; a word without form is its own root.
    An empty vocabulary gives an empty result.

    A candidate pair is met once from either end, and the verification is part of the join's condition, so no
    unverified pair leaves a task; a reduced word that many words share is split by the adaptive join.
    """
    vocabulary = materialize(vocabulary.select("word", "n"), "variants-vocabulary")
    n = vocabulary.count()
    symbols = symbols or symbols_for(n)
    keyed = materialize(vocabulary.mapInArrow(_keyed(symbols), "word string, n bigint, key bigint"), "variants-reduced")
    around = vocabulary.select("word").mapInArrow(_expand(symbols, _bits(keyed, n)), "key bigint, word string")
    others = keyed.select("key", F.col("word").alias("other"), F.col("n").alias("m"))
    met = around.join(others, (around["key"] == others["key"]) & (F.levenshtein(F.col("word"), F.col("other"), 1) == 1))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("word")))
    near = materialize(met.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "variants-near")
    has = -F.col("best.m") >= times * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n")
    )
    rows = materialize(rows, "variants-forms")
    roots = _roots(rows.where("form is not null").select("word", F.col("form").alias("root")))
    root: Column = F.coalesce("root", "word")
    return rows.join(roots, "word", "left").select("word", "form", root.alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follow links to their ends by doubling; a form is ``times`` as frequent as its word, so there are no circles and few steps."""
    links = materialize(links, "variants-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = materialize(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")
