"""Token sequences of fixed length packed by the sum-of-squares rule.

A piece goes where the sum, over all residual gaps, of the squared number of open sequences with that gap becomes
smallest: into an open sequence, or into a new one. Pieces come longest first. Sequences that are left
with too large a gap are dissolved and their pieces packed again, in groups of pieces that the tasks
handle independently; what a group cannot close well goes on to the next level, where the
groups' leftovers meet, until one group is left.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh, materialize

#: Pieces that a group holds, about: bounds a task's memory (some 10 MB) and its time.
GROUP_PIECES = 65_536
#: A sequence with a gap of at most this part of the capacity stays as it is.
GOOD_GAP = 1 / 128
#: Characters of a long text that are tokenized at once.
SEGMENT = 1 << 20

#: The split pattern of the vocabulary file's byte-level tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The ids by byte string and the special tokens of a byte-level BPE file, read on the driver.

    In such a vocabulary ids grow with the order of the merges, so they serve as ranks; anything else is refused."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocab = data["model"]["vocab"]
    ids = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in data["model"]["merges"]]
    if data["pre_tokenizer"]["type"] != "ByteLevel" or data.get("normalizer") or data["pre_tokenizer"].get("add_prefix_space") or any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError(f"{path} is not a byte-level BPE whose ids follow its merges")
    return {bytes(letter[c] for c in token): i for token, i in vocab.items() if token not in special}, special


def _segments(text: str) -> Iterator[str]:
    """``text`` cut before single spaces between other characters, where a new word starts in any case."""
    import re

    place, at = re.compile(r"(?<=\S) (?=\S)"), 0
    while len(text) - at > SEGMENT:
        found = place.search(text, at + SEGMENT)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def cut_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens: the id, ``piece`` (from 0), ``start`` (the document's tokens before
    it), ``length``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) and, if asked for, ``ids``.

    A document is its text's ids by the tokenizer file at ``path``, special tokens' strings as their ids, then ``end_id``.
    Only longer ones are cut: the first piece takes what the whole pieces after it leave. A null or empty text is the
    end id alone. Null and repeated ids are documents like others. Row-local; the text stays in its task."""
    ranks, special = load_ranks(path)
    kind = docs.schema[id_col].dataType
    fields = [T.StructField("id", kind), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    schema = T.StructType([*fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        for batch in batches:
            rows, piece, start, length, crc, parts = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                found = [np.array(bpe.encode(s, allowed_special="all"), dtype="<u4") for s in _segments(text.as_py() or "")]
                tokens = np.concatenate([*found, np.array([end_id], dtype="<u4")])
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(first, len(tokens) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(tokens[a:b].tobytes()))
                    if ids:
                        parts.append(tokens[a:b].astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(parts, pa.list_(pa.int32()))] if ids else [])], names=schema.names)

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence of every piece, where in it the piece starts, and every sequence's gap; pieces are placed in the order given.

    Moving a sequence from gap g to g - s changes the sum of squares by 2 (open[g - s] - open[g] + 1), filling
    it by 1 - 2 open[s], a new one by 2 open[capacity - s] + 1; of equal changes the smallest gap wins, a new sequence last."""
    count = np.zeros(capacity + 1)
    count[0] = -0.5  # makes a filled sequence's change fit the common form
    shut = np.full(capacity + 1, np.inf)  # gaps that no open sequence has
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, begin, gaps = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for i, s in enumerate(sizes.tolist()):
        change = count[: capacity - s] - count[s:capacity] + shut[s:capacity]
        new = count[capacity - s] + 0.5 if s < capacity else -1.0
        left = int(change.argmin()) if s < capacity else 0
        if s < capacity and change[left] + 1 <= new:
            gap = left + s
            to = open_[gap].pop()
            count[gap] -= 1
            if not open_[gap]:
                shut[gap] = np.inf
        else:
            gap, left, to = capacity, capacity - s, len(gaps)
            gaps.append(capacity)
        where[i], begin[i], gaps[to] = to, capacity - gap, left
        if left:
            open_[left].append(to)
            count[left] += 1
            shut[left] = 0.0
    return where, begin, np.array(gaps, dtype=np.int64)


def pack_group(sizes: np.ndarray, capacity: int, good: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (-1: not placed) and offset of every piece of one group, pieces longest first.

    Sequences with gaps of at most ``good`` are kept, the pieces of the others packed again as long as that saves a
    sequence. What is still badly filled then is kept only if ``last``."""
    to, begin = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
    full = np.flatnonzero(sizes == capacity)
    to[full] = np.arange(len(full))
    used, rest, kept = len(full), np.flatnonzero(sizes < capacity), None
    while len(rest):
        where, at, gaps = sum_of_squares(sizes[rest], capacity)
        if kept is not None and len(gaps) >= kept[3]:
            break
        close = gaps <= good
        number = np.cumsum(close) - 1 + used
        done = close[where]
        to[rest[done]], begin[rest[done]] = number[where[done]], at[done]
        used += int(close.sum())
        again = np.cumsum(~close) - 1
        kept = (rest[~done], again[where[~done]], at[~done], int((~close).sum()))
        rest = kept[0]
        if not close.any():
            break
    if last and kept is not None and len(kept[0]):
        rest, where, at, _ = kept
        to[rest], begin[rest] = where + used, at
    return to, begin


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = 1024, group_pieces: int = GROUP_PIECES, good_gap: float = GOOD_GAP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every sequence holds pieces of at most ``capacity`` tokens together, gapless from 0.

    Pieces must be between 1 and ``capacity`` long. They are dealt evenly into groups of about ``group_pieces`` by their
    place in the written input, so that neither copies nor equal lengths gather in one. Each level shuffles
    only the pieces that the level before could not place well, a few in a hundred; when they are one group, or when a level placed less
    than half, the next level is the last. All columns ride along; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    place, group, seq, off = (fresh(c, pieces.columns) for c in ("__place", "__group", "sequence_id", "offset"))
    rest = materialize(pieces.withColumn(place, F.monotonically_increasing_id()), "packing-pieces")
    n, level, out = rest.count(), 0, None
    last = False
    while out is None or n:
        groups = max(1, -(-n // group_pieces))
        last = last or groups == 1
        run = _pack_table(rest.columns.index(length_col), place, group, capacity, int(capacity * good_gap), last, level, (seq, off))
        schema = T.StructType([*rest.schema.fields, T.StructField(seq, T.LongType()), T.StructField(off, T.LongType())])
        dealt = rest.withColumn(group, F.pmod(F.xxhash64(F.lit(level), place), F.lit(groups)))
        done = materialize(dealt.groupBy(group).applyInArrow(run, schema), "packing-level")
        good = done.where(F.col(seq).isNotNull()).drop(place)
        out = good if out is None else out.unionAll(good)
        if last:
            break
        before, rest = n, done.where(F.col(seq).isNull()).drop(seq, off)
        n, level = rest.count(), level + 1
        last = 2 * n > before
    return out


def _pack_table(length_at: int, place: str, group_col: str, capacity: int, good: int, last: bool, level: int, names: tuple[str, str]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.select([c for c in table.column_names if c != group_col])
        size = table.column(length_at).to_numpy()
        order = np.lexsort((table.column(place).to_numpy(), -size))
        to, begin = pack_group(size[order], capacity, good, last)
        number = (level << 56) + (group << 24) + to
        null = to < 0
        return table.take(pa.array(order)).append_column(names[0], pa.array(number, pa.int64(), mask=null)).append_column(names[1], pa.array(begin, pa.int64(), mask=null))

    return run


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of every sequence: its pieces' ids (:func:`cut_documents` with ``ids``) in the order of their offsets."""
    whole = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))
