"""Two-pass external shuffle into shards.

Pass 1 scatters rows uniformly into buckets sized for a task's memory, by a seeded
hash. Pass 2 loads one bucket at a time, puts it in a canonical order, applies a
seeded Fisher-Yates shuffle and writes it. The concatenation of the buckets is one
random permutation of the corpus; it is cut into shards whose row counts differ by
at most one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh, materialize

#: Bytes of rows that one bucket holds on average.
BUCKET_BYTES = 32 * 1024 * 1024


def row_bytes(df: DataFrame, text_col: str):
    """UTF-8 bytes of the text (none for null) plus 1."""
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("bigint")


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The permutation of ``0..n-1`` for one bucket: swap i with a random j <= i, from the end."""
    rng = np.random.Generator(np.random.PCG64([seed & 0xFFFFFFFF, bucket]))
    order = np.arange(n, dtype=np.int64)
    picks = rng.integers(0, np.arange(n, 0, -1, dtype=np.int64)) if n else order
    for i, j in zip(range(n - 1, 0, -1), picks.tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle_bucket(seed: int, bucket: str, first: str, second: str, pos: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one bucket: sized for a task's memory
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        ids = table.column(bucket).to_numpy()
        for b in np.unique(ids).tolist():
            part = table if ids[0] == ids[-1] == b and (ids == b).all() else table.filter(pc.equal(table.column(bucket), b))
            canonical = np.lexsort((part.column(second).to_numpy(), part.column(first).to_numpy()))
            order = canonical[fisher_yates(len(canonical), seed, b)]
            columns = [n for n in part.column_names if n not in (first, second, pos)]
            for at in range(0, len(order), 4096):
                rows = part.select(columns).take(pa.array(order[at : at + 4096])).combine_chunks()
                rows = rows.append_column(pos, pa.array(np.arange(at, at + rows.num_rows, dtype=np.int64)))
                yield from rows.to_batches()

    return run


def external_shuffle(
    df: DataFrame,
    shards: int = 16,
    seed: int = 20240229,
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows of ``df`` with ``shard`` and ``slot`` appended, as a table of shuffled buckets.

    Placement depends on the seed and the rows' contents alone, not on how the input
    is split, so a rerun or a lost executor gives the same result. Rows equal in every
    column are told apart by an occurrence number, so copies scatter like any other
    rows. Shards hold row counts at most one apart; slots run from 0 without gaps.
    Null ids, null and empty texts are rows like others; an empty table gives an empty
    result. Where the input already has a column named ``shard`` or ``slot``, the new
    ones get a suffix (see ``shard_columns``).
    """
    names = df.columns
    h1, h2, bucket, pos, occ = (fresh(n, names) for n in ("__h1", "__h2", "__bucket", "__pos", "__occ"))
    everything = [F.col(f"`{c}`") for c in names]
    hashed = df.withColumn(h1, F.xxhash64(F.lit(seed), *everything)).withColumn(h2, F.xxhash64(*everything, F.lit(seed)))
    total = hashed.agg(F.sum(row_bytes(df, text_col)).alias("b"), F.count("*").alias("n")).first()
    n_rows, buckets = total["n"], max(1, -(-(total["b"] or 0) // bucket_bytes))

    # Rows equal in every column: their keys and counts, found on 16 bytes per row with map-side sums.
    repeated = materialize(hashed.groupBy(h1, h2).agg(F.count("*").alias(occ)).where(F.col(occ) > 1), "shuffle-repeats")
    if repeated.isEmpty():
        rows = hashed.withColumn(occ, F.lit(0).cast("bigint"))
    else:
        single = hashed.join(repeated, [h1, h2], "left_anti").withColumn(occ, F.lit(0).cast("bigint"))
        several = hashed.join(repeated.drop(occ), [h1, h2], "left_semi")
        several = several.groupBy(*everything, h1, h2).agg(F.count("*").alias(occ))
        several = several.withColumn(occ, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(occ) - 1)))
        rows = single.unionByName(several.select(single.columns))
    scattered = (
        rows.withColumn(h2, F.xxhash64(F.col(h2), F.col(occ)))
        .withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), h1, h2), F.lit(buckets)).cast("int"))
        .drop(occ)
        .repartitionById(buckets, F.col(bucket))
    )
    schema = T.StructType([f for f in scattered.schema.fields if f.name not in (h1, h2)] + [T.StructField(pos, T.LongType())])
    shuffled = materialize(scattered.mapInArrow(_shuffle_bucket(seed, bucket, h1, h2, pos), schema), "shuffle-buckets")

    # One row per bucket (bytes / bucket_bytes of them): where its block starts in the permutation.
    counts = shuffled.groupBy(bucket).agg(F.count("*").alias("n"))
    start = F.coalesce(F.sum("n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialize(counts.select(F.col(bucket).alias("__b"), start.alias("__start")), "shuffle-starts")
    shard_col, slot_col = shard_columns(names)
    rank = F.col("__start") + F.col(pos)
    placed = shuffled.join(starts, F.col(bucket) == F.col("__b"))
    placed = placed.withColumn(shard_col, F.expr(f"CAST((__start + `{pos}`) * {shards} DIV {max(1, n_rows)} AS INT)"))
    first = F.expr(f"(CAST(`{shard_col}` AS BIGINT) * {n_rows} + {shards - 1}) DIV {shards}")
    return placed.withColumn(slot_col, rank - first).select(*everything, shard_col, slot_col)


def shard_columns(names: list[str]) -> tuple[str, str]:
    """The names of the added columns: ``shard`` and ``slot``, with an underscore appended while taken."""
    low = {n.lower() for n in names}
    out = []
    for base in ("shard", "slot"):
        while base in low:
            base += "_"
        out.append(base)
    return out[0], out[1]


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the shards, one folder each, in slot order."""
    shard, slot = shuffled.columns[-2:]
    shuffled.repartition(F.col(shard), F.floor(F.col(slot) / 100_000)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
