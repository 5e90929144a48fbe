"""Batching (B1-B3) and run tagging.

B1 and B3 need a running total per ``partition_by`` in ``order_by`` order.
A plain ordered window sends each partition key to one task, which does not
survive a key holding a third of all rows.  We compute the prefix sum in
parallel instead (classic two-level scan):

1. every row gets a *chunk*: a value monotone in the order (e.g. the order
   key divided by a width), so chunks of one key are ordered;
2. per (key, chunk) totals -- a partial+final aggregate, tiny output;
3. per key, an exclusive running sum over the chunk totals (window on the
   tiny table) gives each chunk's offset;
4. the offsets are joined back on (key, chunk) -- broadcast
   when the planner's estimate or AQE's measured size is small, else a
   shuffle join whose partitioning the in-chunk window reuses (the large
   side is shuffled exactly once either way);
5. within each (key, chunk) an ordinary running window adds the rest.

Each task holds one chunk, never a whole key.  The result equals the plain
window exactly (ties must be broken by ``order_by``), whatever the chunking,
so the chunk only decides the work split, never the answer.

``chunk="auto"`` (the default) splits only *hot* keys -- those holding more
than ``rows / n_chunks`` rows, of which there are fewer than ``n_chunks`` --
at approximate quantiles of the first order column, and values that alone fill
chunks at those of the next order columns.  Cold keys stay whole.  No (key,
chunk) group then holds much more than ``rows / n_chunks`` rows unless that
many rows are tied on every order column.  ``n_chunks`` follows the input's
size.  A Column may be given instead (see :func:`order_chunk`);
``chunk=None`` is the plain window.

The chunk-totals table has one row per non-empty (key, chunk): with auto
chunks at most ``keys + n_chunks**2`` tiny rows, far below the data; it is
aggregated, windowed and joined like any table (broadcast only when measured
small).
"""

from __future__ import annotations

import math
import re
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import BATCH_NAME_FORMAT, MAX_BATCH_ROWS, MAX_BUFFER_BYTES
from tidewater.session import work_path

DEFAULT_MAX_BYTES = MAX_BUFFER_BYTES
DEFAULT_BATCH_ROWS = MAX_BATCH_ROWS
#: Bytes of input that a chunk is meant to hold, and the longest list of cuts.
CHUNK_BYTES = 128 * 1024 * 1024
MOST_CHUNKS = 100_000
#: An estimate beyond this is none; how many chunks there are then.
UNKNOWN_BYTES, UNKNOWN_CHUNKS = 1 << 60, 1_000


def epoch_value(c: Column, dtype) -> Column:
    """A date or time as a number that grows with it, whatever the session time zone."""
    from pyspark.sql.types import DateType, TimestampNTZType

    if isinstance(dtype, DateType):
        return F.unix_date(c)
    if isinstance(dtype, TimestampNTZType):
        # timestamp_diff would read the wall clock in the session zone, which jumps at its clock changes
        minutes = F.unix_date(c.cast("date")).cast("long") * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_micros(c)


def order_chunk(order_col: str | Column, width: int | float, kind: str = "number") -> Column:
    """A chunk id monotone in ``order_col``.

    kind ``number``        -> floor(value / width)
    kind ``timestamp``     -> floor(epoch microseconds / width), width in microseconds
    kind ``timestamp_ntz`` -> the same on the wall clock, free of the session time zone
    """
    from pyspark.sql.types import TimestampNTZType, TimestampType

    c = F.col(order_col) if isinstance(order_col, str) else order_col
    if kind == "timestamp":
        c = epoch_value(c.cast("timestamp"), TimestampType())
    elif kind == "timestamp_ntz":
        c = epoch_value(c.cast("timestamp_ntz"), TimestampNTZType())
    return F.floor(c / F.lit(width))


def _order_value(df: DataFrame, name: str, first: bool = True) -> Column:
    """A double that never decreases in the column's order: numbers as they are, dates and times from the
    epoch, booleans as 0 and 1, strings and binaries (not as the first order column) by their first six bytes."""
    from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return epoch_value(c, dtype).cast("double")
    if isinstance(dtype, (NumericType, BooleanType)):
        return c.cast("double")
    if isinstance(dtype, (StringType, BinaryType)) and not first:
        lead = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(lead, 16, 10).cast("double")
    raise ValueError(
        f"chunk='auto' needs a numeric, date or timestamp first order column, not "
        f"{dtype.simpleString()}; pass chunk=<Column monotone in the order> instead"
    )


def _chunk_count(df: DataFrame) -> int:
    """As many chunks as keep one near CHUNK_BYTES by the planner's size estimate, two per core at least."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > UNKNOWN_BYTES:  # the planner has no estimate
        size = UNKNOWN_CHUNKS * CHUNK_BYTES
    return int(min(MOST_CHUNKS, max(16, 2 * df.sparkSession.sparkContext.defaultParallelism, size // CHUNK_BYTES)))


def _cuts(df: DataFrame, value: str, n_chunks: int, rows: Column | None = None) -> tuple[list[float], list[float], int]:
    """Approximate quantiles of ``value`` (finite ones), those that repeat (values holding more than a chunk) and the row count."""
    probs = [i / n_chunks for i in range(1, n_chunks)]
    # Balance only needs a rank error under half a chunk, so the sketch accuracy grows with n_chunks, not with the data.
    sketch = F.percentile_approx(value, probs, max(1_000, 4 * n_chunks)) if probs else F.lit(None)
    row = (df if rows is None else df.where(rows)).agg(sketch.alias("q"), F.count(F.lit(1)).alias("n")).first()
    found = [c for c in (row["q"] or []) if c is not None and math.isfinite(c)]
    heavy = sorted({c for c, d in zip(found, found[1:]) if c == d})
    return sorted(set(found)), heavy, row["n"]


def _with_auto_chunk(df: DataFrame, keys: list[str], order: list[str], n_chunks: int | None, out_col: str) -> DataFrame:
    """Split hot keys into chunks along the order.

    The first order column is cut at its approximate quantiles (a bounded list; Spark ML's ``Bucketizer`` finds
    a row's chunk by binary search in the JVM). A value that alone fills chunks gets a chunk of its own, cut
    again at the quantiles of the next order column, and so on. A key holding more than ``rows / n_chunks``
    rows is *hot*: fewer than ``n_chunks`` keys can be, so that key set is small and is broadcast. Every other
    key stays whole (chunk 0). Rows tied on every order column share a chunk: their order is not defined.
    Null order values go to the first chunk, as they sort; empty inputs and inputs without a finite value have one.
    """
    from pyspark.ml.feature import Bucketizer

    if n_chunks is None:
        n_chunks = _chunk_count(df)
    out, drop, chunk, tied, total = df, [], None, None, 0
    for level, name in enumerate(order):
        value, bucket = f"_tw_ordv{level}", f"_tw_b{level}"
        out = out.withColumn(value, _order_value(df, name, level == 0))
        cuts, heavy, n = _cuts(out, value, n_chunks, tied)
        drop += [value]
        total = total if level else n
        if cuts:
            ends = {c for h in heavy for c in (h, math.nextafter(h, math.inf))}
            splits = [-math.inf, *sorted({*cuts, *ends}), math.inf]
            out = Bucketizer(splits=splits, inputCol=value, outputCol=bucket, handleInvalid="keep").transform(out)
            # NaN sorts last, null first; Bucketizer keeps NaN in an extra bucket and leaves null
            place = F.when(F.col(value).isNull(), F.lit(-1)).otherwise(F.col(bucket)).cast("long")
            drop += [bucket]
        else:
            place = F.lit(0).cast("long")
        place = place if tied is None else F.when(tied, place).otherwise(F.lit(0).cast("long"))
        chunk = place if chunk is None else chunk * F.lit(4 * n_chunks + 8) + place
        if not heavy:
            break
        # at most one heavy value a chunk
        marked = df.sparkSession.createDataFrame([(h, True) for h in heavy], f"_tw_hv{level} DOUBLE, _tw_heavy{level} BOOLEAN")
        out = out.join(F.broadcast(marked), F.col(value) == F.col(f"_tw_hv{level}"), "left").drop(f"_tw_hv{level}")
        drop += [f"_tw_heavy{level}"]
        mine = F.coalesce(F.col(f"_tw_heavy{level}"), F.lit(False))
        tied = mine if tied is None else tied & mine

    hot = (
        out.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_tw_rows"))
        .where(F.col("_tw_rows") > F.lit(max(1, total // n_chunks)))
        .select(*[F.col(k).alias(f"_tw_h{i}") for i, k in enumerate(keys)], F.lit(True).alias("_tw_hot"))
    )
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_tw_h{i}"))
        cond = c if cond is None else cond & c
    flagged = out.join(F.broadcast(hot), cond, "left")
    chunk = F.when(F.col("_tw_hot"), chunk).otherwise(F.lit(0).cast("long"))
    return flagged.withColumn(out_col, chunk).drop("_tw_hot", *drop, *[f"_tw_h{i}" for i in range(len(keys))])


def _cols(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def running_before(
    df: DataFrame,
    weight: Column,
    order_by: Sequence[str] | str,
    partition_by: Sequence[str] | str,
    chunk: Column | str | None = "auto",
    out_col: str = "_before",
    n_chunks: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = sum of ``weight`` over earlier rows of the same partition."""
    keys = _cols(partition_by)
    order = _cols(order_by)
    if not keys:
        raise ValueError("partition_by is required: an unpartitioned running total runs in one task")
    base = df.withColumn("_tw_w", weight.cast("long"))
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return base.withColumn(out_col, F.coalesce(F.sum("_tw_w").over(w), F.lit(0))).drop("_tw_w")

    # Chunks ascend with nulls first, so any other order would add the wrong offsets.
    if any(not isinstance(o, str) and re.search(r" (DESC|ASC)( NULLS (FIRST|LAST))?'>$", str(o).replace(" ASC NULLS FIRST", "")) for o in order):
        raise ValueError("chunks need an ascending order with nulls first; use chunk=None for any other")
    if isinstance(chunk, str):
        if chunk != "auto":
            raise ValueError(f"unknown chunk mode {chunk!r}")
        if not all(isinstance(o, str) for o in order):
            raise ValueError("chunk='auto' needs the order columns by name")
        base = _with_auto_chunk(base, keys, order, n_chunks, "_tw_chunk")
    else:
        base = base.withColumn("_tw_chunk", chunk)
    # The join and the in-chunk window use the same plain, non-null columns
    # (value-or-default, is-null) per key plus the chunk, so no null-safe
    # rewrite changes the join's hash keys: both require the same hash
    # partitioning and the large side is shuffled once whether the join is
    # broadcast or not.  Null keys and null chunks still match exactly.
    jcols: list[str] = []
    schema = base.schema
    pairs = {}
    for i, k in enumerate([*keys, "_tw_chunk"]):
        pairs[f"_tw_v{i}"] = F.coalesce(F.col(k), _default_of(schema[k].dataType))
        pairs[f"_tw_n{i}"] = F.col(k).isNull()
        jcols += [f"_tw_v{i}", f"_tw_n{i}"]
    base = base.withColumns(pairs)
    # carry each key once: the stand-in pair replaces it until the end
    order_names = {o for o in order if isinstance(o, str)}
    restorable = [k for k in keys if k not in order_names]
    base = base.drop("_tw_chunk", *restorable)
    kcols, ccols = jcols[:-2], jcols[-2:]
    totals = base.groupBy(*jcols).agg(F.sum("_tw_w").alias("_tw_cw"))
    # null chunks (null order values) sort first, as in the ascending order
    w_tot = (
        Window.partitionBy(*kcols)
        .orderBy(F.col(ccols[1]).desc(), F.col(ccols[0]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(*jcols, F.coalesce(F.sum("_tw_cw").over(w_tot), F.lit(0)).alias("_tw_off"))
    # Every row has an offset unless the input changed between its two readings: that must not lose rows.
    joined = base.join(offsets, jcols, "left")
    missing = F.raise_error(F.lit("running total: the input changed while it was read"))
    offset = F.when(F.col("_tw_off").isNull(), missing.cast("long")).otherwise(F.col("_tw_off"))
    w_in = Window.partitionBy(*jcols).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    restored = {k: F.when(~F.col(f"_tw_n{i}"), F.col(f"_tw_v{i}")) for i, k in enumerate(keys) if k in restorable}
    out = joined.withColumns(
        {out_col: offset + F.coalesce(F.sum("_tw_w").over(w_in), F.lit(0)), **restored}
    )
    return out.select(*df.columns, out_col)


def _default_of(dtype) -> Column:
    """A non-null stand-in value of ``dtype`` (paired with an is-null flag)."""
    from pyspark.sql.types import (
        BinaryType,
        BooleanType,
        DateType,
        NumericType,
        StringType,
        TimestampNTZType,
        TimestampType,
    )

    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, BinaryType):
        return F.lit(b"")
    raise TypeError(f"unsupported partition key type {dtype.simpleString()}")


def assign_byte_batch(
    df: DataFrame,
    payload: str | Column | None,
    order_by: Sequence[str] | str,
    partition_by: Sequence[str] | str,
    max_bytes: int = DEFAULT_MAX_BYTES,
    chunk: Column | str | None = "auto",
    out_col: str = "batch_id",
    n_chunks: int | None = None,
    size_col: str | None = None,
) -> DataFrame:
    """B1: batch number by running payload bytes; a new batch starts once the
    bytes *before* a row reach the next multiple of ``max_bytes``.

    Fixed byte bins over the uncompressed payload (UTF-8 bytes): deterministic
    and parallel; each batch holds at most ``max_bytes`` plus one event.
    ``size_col``: a column that already has the bytes, so that the payload itself need
    not travel through the shuffle (``payload`` is then ignored).
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    size = F.col(size_col) if size_col is not None else F.octet_length(p)
    out = running_before(
        df, F.coalesce(size, F.lit(0)), order_by, partition_by, chunk, "_tw_before", n_chunks
    )
    return out.withColumn(out_col, F.floor(F.col("_tw_before") / F.lit(max_bytes))).drop("_tw_before")


#: Bytes of a segment of the greedy rotation, in batches.
SEGMENT_BATCHES = 16
#: Segments whose transfers are joined into one.
FAN_IN = 64


def assign_greedy_batch(
    df: DataFrame,
    payload: str | Column | None,
    order_by: Sequence[str] | str,
    partition_by: Sequence[str] | str,
    max_bytes: int = DEFAULT_MAX_BYTES,
    chunk: Column | str | None = "auto",
    out_col: str = "batch_id",
    n_chunks: int | None = None,
    size_col: str | None = None,
) -> DataFrame:
    """B1 as the delivery tool rotates its buffers: a row starts a new batch once the batch before it holds more than ``max_bytes``.

    Where a batch starts depends on where the one before it started, so one pass per key is a chain. Here it is cut up:
    with every row's running total known (:func:`running_before`), the next start after a start is the first row whose
    total is more than ``max_bytes`` ahead. A key's totals are cut into segments of SEGMENT_BATCHES batches. Only
    rows in the first ``max_bytes`` of a segment, and the one after them, can be the first start in it; for each of these the segment's last start and number of
    starts are found by pointer doubling. These transfers are joined FAN_IN at a time, level by level, until a key has one,
    and then the levels are walked back, which tells every segment where the batch before it started. So no task holds more
    than a segment's totals, or FAN_IN segments' first rows, however hot a key is.

    The batches equal the chain's exactly. Every batch but a key's last has more than ``max_bytes``, by less than one event. Rows of one total (events without bytes)
    share a batch. Rows are written once below the shared folder with their totals.
    """
    keys = _cols(partition_by)
    p = F.col(payload) if isinstance(payload, str) else payload
    size = F.col(size_col) if size_col is not None else F.octet_length(p)
    before, seg = "_tw_before", "_tw_seg"
    rows = running_before(df, F.coalesce(size, F.lit(0)), order_by, partition_by, chunk, before, n_chunks)
    rows = rows.withColumn(seg, F.floor(F.col(before) / F.lit(SEGMENT_BATCHES * max_bytes)).cast("bigint"))
    rows = _written(rows, "greedy-rows")
    names = {k: f"_tw_k{i}" for i, k in enumerate(keys)}
    ids = list(names.values())
    slim = rows.select(*[F.col(k).alias(n) for k, n in names.items()], seg, before).distinct()
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema.fields}
    key_ddl = ", ".join(f"{n} {kinds[n]}" for n in ids)
    transfer = f"{key_ddl}, {seg} bigint, cand array<bigint>, last array<bigint>, cnt array<bigint>"
    levels = [_written(slim.groupBy(*ids, seg).applyInArrow(_transfers(ids, seg, before, max_bytes), transfer), "greedy-transfers")]
    while not levels[-1].groupBy(*ids).count().where("count > 1").isEmpty():
        up = levels[-1].withColumn("_tw_up", F.floor(F.col(seg) / F.lit(FAN_IN ** len(levels))).cast("bigint"))
        levels.append(_written(up.groupBy(*ids, "_tw_up").applyInArrow(_joined(ids, seg, max_bytes, FAN_IN ** (len(levels) - 1)), transfer), "greedy-transfers"))
    # The whole key is entered before its first row.
    entry = f"{key_ddl}, {seg} bigint, enter bigint, base bigint"
    enters = levels[-1].select(*ids, seg, F.lit(-1).cast("bigint").alias("enter"), F.lit(0).cast("bigint").alias("base"))
    for depth in range(len(levels) - 2, -1, -1):
        # a joined transfer bears its first segment; its children are those of the same stretch
        stretch = F.floor(F.col(seg) / F.lit(FAN_IN ** (depth + 1))).cast("bigint").alias("_tw_up")
        mine = levels[depth].select("*", stretch, F.lit(None).cast("bigint").alias("enter"), F.lit(None).cast("bigint").alias("base"))
        none = [F.lit(None).cast("array<bigint>").alias(c) for c in ("cand", "last", "cnt")]
        both = mine.unionByName(enters.select(*ids, F.lit(None).cast("bigint").alias(seg), *none, stretch, "enter", "base"))
        enters = _written(both.groupBy(*ids, "_tw_up").applyInArrow(_entered(ids, seg, max_bytes), entry), "greedy-enters")
    flat = slim.unionByName(enters.select(*ids, seg, "enter", "base"), allowMissingColumns=True)
    starts = _written(flat.groupBy(*ids, seg).applyInArrow(_starts(ids, seg, before, max_bytes), f"{key_ddl}, {seg} bigint, starts array<bigint>, base bigint"), "greedy-starts")
    match = rows[seg] == starts[seg]
    for k, n in names.items():
        match = match & rows[k].eqNullSafe(starts[n])
    done = F.col("base") - 1 + F.size(F.filter("starts", lambda x: x <= F.col(before)))
    return rows.join(starts, match, "left").select(*[rows[c] for c in df.columns], done.cast("bigint").alias(out_col))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame written below the shared folder: a lost executor repeats only what comes after."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key_row(table: pa.Table, ids: list[str]) -> dict:
    return {n: table.column(n).slice(0, 1) for n in ids}


def _lists(*arrays) -> list[pa.Array]:
    return [pa.array([a], pa.list_(pa.int64())) for a in arrays]


def _transfers(ids: list[str], seg: str, before: str, most: int):
    """A segment's possible first starts, and for each the segment's last start and the number of starts."""

    def run(table: pa.Table) -> pa.Table:
        at = np.unique(table.column(before).to_numpy())
        n = len(at)
        jump = np.append(np.searchsorted(at, at + most, side="right"), n)  # the place of the next start; n: beyond the segment
        last, count = np.append(np.arange(n), n), np.append(np.ones(n, np.int64), 0)
        while (jump[:n] < n).any():  # doubling: each place takes over what its jump knows
            far = jump < n
            last[far], count[far], jump = last[jump[far]], count[far] + count[jump[far]], np.where(far, jump[np.minimum(jump, n)], n)
        first = table.column(seg)[0].as_py() * SEGMENT_BATCHES * most
        cand = int(np.searchsorted(at, first + most, side="right")) + 1
        return pa.table({**_key_row(table, ids), seg: table.column(seg).slice(0, 1), **dict(zip(("cand", "last", "cnt"), _lists(at[:cand], at[last[:n]][:cand], count[:n][:cand])))})

    return run


def _parts(table: pa.Table, seg: str) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The transfers of a table in order: segment, candidates, last starts, counts."""
    rows = [(table.column(seg)[i].as_py(), *(table.column(c)[i].values.to_numpy() for c in ("cand", "last", "cnt"))) for i in range(table.num_rows) if table.column("cand")[i].is_valid]
    return sorted(rows, key=lambda r: r[0])


def _joined(ids: list[str], seg: str, most: int, width: int):
    """The transfers of neighbouring segments as one: what enters the first leaves the last."""

    def run(table: pa.Table) -> pa.Table:
        parts = _parts(table, seg)
        # A start that enters a later part first is that part's first row: the parts before it then have no start.
        cand = np.concatenate([parts[0][1], *[p[1][:1] for p in parts[1:2]]])
        last, count = np.zeros(len(cand), np.int64), np.zeros(len(cand), np.int64)
        ahead = cand - 1  # the next start is the first row beyond
        for _, c, to, n in parts:
            i = np.searchsorted(c, ahead, side="right")
            hit = i < len(c)
            last[hit], count[hit] = to[i[hit]], count[hit] + n[i[hit]]
            ahead = np.where(hit, last + most, ahead)
        return pa.table({**_key_row(table, ids), seg: pa.array([parts[0][0]], pa.int64()), **dict(zip(("cand", "last", "cnt"), _lists(cand, last, count)))})

    return run


def _entered(ids: list[str], seg: str, most: int):
    """For every part of a stretch: the first start in it is the first row beyond ``enter``, and has number ``base``."""

    def run(table: pa.Table) -> pa.Table:
        given = next(i for i in range(table.num_rows) if table.column("enter")[i].is_valid)
        enter, base = table.column("enter")[given].as_py(), table.column("base")[given].as_py()
        out = []
        for s, c, to, n in _parts(table, seg):
            out.append((s, enter, base))
            i = int(np.searchsorted(c, enter, side="right"))
            if i < len(c):
                enter, base = int(to[i]) + most, base + int(n[i])
        key = {n: pa.chunked_array([pa.concat_arrays([v.combine_chunks()] * len(out))]) for n, v in _key_row(table, ids).items()}
        return pa.table({**key, seg: [o[0] for o in out], "enter": [o[1] for o in out], "base": [o[2] for o in out]}, schema=None)

    return run


def _starts(ids: list[str], seg: str, before: str, most: int):
    """Every start in a segment."""

    def run(table: pa.Table) -> pa.Table:
        totals, enters = table.column(before), table.column("enter")
        at = np.unique(totals.drop_null().to_numpy())
        enter, base = enters.drop_null()[0].as_py(), table.column("base").drop_null()[0].as_py()
        found, i = [], int(np.searchsorted(at, enter, side="right"))
        while i < len(at):
            found.append(int(at[i]))
            i = int(np.searchsorted(at, at[i] + most, side="right"))
        return pa.table({**_key_row(table, ids), seg: table.column(seg).slice(0, 1), "starts": _lists(found)[0], "base": pa.array([base], pa.int64())})

    return run


def assign_count_batch(
    df: DataFrame,
    order_by: Sequence[str] | str,
    partition_by: Sequence[str] | str,
    n: int = DEFAULT_BATCH_ROWS,
    chunk: Column | str | None = "auto",
    out_col: str = "batch_id",
    n_chunks: int | None = None,
) -> DataFrame:
    """Batch number = (row position within partition) div n."""
    out = running_before(df, F.lit(1), order_by, partition_by, chunk, "_tw_before", n_chunks)
    return out.withColumn(out_col, F.floor(F.col("_tw_before") / F.lit(n))).drop("_tw_before")


_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(every: str) -> int:
    """``'5 seconds'``, ``'1 hour 30 minutes'`` -> microseconds."""
    parts = every.lower().replace(",", " ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"cannot read duration {every!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        total += int(n) * _UNIT_MICROS[unit.rstrip("s")]
    if total <= 0:
        raise ValueError(f"duration must be positive: {every!r}")
    return total


def assign_time_batch(
    df: DataFrame,
    ts_col: str,
    every: str = "1 second",
    prefix: str = "ingest-",
    name_format: str = BATCH_NAME_FORMAT,
    start_col: str = "batch_start",
    name_col: str = "batch_name",
) -> DataFrame:
    """B2: batch by the time bucket a row falls in, named after the bucket's
    start second (``prefix + yyyyMMdd-HHmmss``).  Row-local, no shuffle.

    Buckets are aligned to the epoch like ``window()``; they are computed
    directly because ``window()`` also filters out rows whose time is null,
    and a batching step must not lose rows (an undated row gets a null batch).
    ``timestamp_ntz`` is bucketed on its wall clock, ``timestamp`` on the instant.
    """
    step = duration_micros(every)
    dtype = df.schema[ts_col].dataType.simpleString()
    if dtype == "timestamp_ntz":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    else:
        epoch = F.lit("1970-01-01 00:00:00+00:00").cast("timestamp")
    ts = F.col(ts_col).cast(dtype if dtype in ("timestamp", "timestamp_ntz") else "timestamp")
    since = epoch_value(ts, T.TimestampNTZType() if dtype == "timestamp_ntz" else T.TimestampType())
    start = F.timestamp_add("MICROSECOND", F.floor(since / F.lit(step)) * F.lit(step), epoch)
    return df.withColumns(
        {start_col: start, name_col: F.concat(F.lit(prefix), F.date_format(start, name_format))}
    )


def new_run_id() -> str:
    """A random run id (16 random bytes, base64), created once on the driver."""
    import base64
    import os

    return base64.b64encode(os.urandom(16)).decode("ascii")


def tag_run(df: DataFrame, run_id: str, col: str = "run_id") -> DataFrame:
    """Attach the caller-supplied run id to every row."""
    return df.withColumn(col, F.lit(run_id))
