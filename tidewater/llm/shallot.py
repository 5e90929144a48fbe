"""Exact k-means over integer vectors by Shallot search.

Every vector remembers its nearest and second-nearest centroid, an upper bound on the distance to the
first and a lower bound on the distance to all others. Where a round's bounds do not settle a vector, its two
remembered centroids are measured, and the scan starts from the closer one: the others follow in order
of their distance from it and the search ball shrinks with every better second-nearest, so a scan ends at the first
neighbour outside the ball. Bounds are rounded outwards; survivors are compared in integers, so ties go to
the smaller number and the result equals a full scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import work_path

#: Largest size of an integer component: squared distances of such vectors fit 64 bits.
MOST = 1 << 27
#: Bounds are widened by this factor, far more than double precision loses in a run.
SLACK = 1e-12
#: Vectors handled at once.
SLICE = 8192


class Search(NamedTuple):
    """Centroids as integer rows; per centroid the others by distance (``order``) and those distances, rounded down
    (``apart``); how far each moved in the last round, rounded up (``moved``)."""

    centroids: np.ndarray
    order: np.ndarray
    apart: np.ndarray
    moved: np.ndarray

    @property
    def others_moved(self) -> np.ndarray:
        """For every centroid the farthest move of any other."""
        if len(self.moved) < 2:
            return np.zeros(len(self.moved))
        top = np.argsort(self.moved)[::-1]
        out = np.full(len(self.moved), self.moved[top[0]])
        out[top[0]] = self.moved[top[1]]
        return out


def above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def below(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    gap = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", gap, gap)


def prepare(centroids: np.ndarray, before: np.ndarray | None = None) -> Search:
    k = len(centroids)
    between = np.array([squared(centroids, c) for c in centroids]).reshape(k, k)
    apart, rows = below(between), np.arange(k)
    apart[rows, rows] = -1.0  # first of its own row
    order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
    moved = np.zeros(k) if before is None else above(squared(centroids, before))
    return Search(centroids, order, np.take_along_axis(apart, order, axis=1), moved)


def assign(s: Search, x: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray):
    """The nearest and second-nearest centroid of every row of ``x`` and the bounds, from those of the round before.

    Also returns how many distances were measured. A vector whose upper bound is below its lower bound is settled
    unmeasured; its remembered second-nearest then stays as a hint, which costs only time if it is out of date."""
    first, second = first.copy(), second.copy()
    upper, lower = upper + s.moved[first], lower - s.others_moved[first]
    if len(s.centroids) == 1:
        return first, second, upper, lower, 0
    near = s.apart[:, 0]  # from every centroid to its nearest other one
    lower = np.maximum(lower, near[first] - upper)
    open_ = np.flatnonzero(upper >= lower)
    d1 = squared(x[open_], s.centroids[first[open_]])
    measured = len(open_)
    upper[open_] = above(d1)
    lower[open_] = np.maximum(lower[open_], near[first[open_]] - upper[open_])
    left = upper[open_] >= lower[open_]
    open_, d1 = open_[left], d1[left]
    xs, c1, c2 = x[open_], first[open_], second[open_]
    d2 = squared(xs, s.centroids[c2])
    measured += len(open_)
    swap = (d2 < d1) | ((d2 == d1) & (c2 < c1))
    c1, c2, d1, d2 = np.where(swap, c2, c1), np.where(swap, c1, c2), np.where(swap, d2, d1), np.where(swap, d1, d2)
    centre, partner, inner = c1.copy(), c2.copy(), above(d1)
    rows = np.arange(len(open_))
    for step in range(s.order.shape[1]):
        # no neighbour this far from the centre is nearer than the second best found
        rows = rows[s.apart[centre[rows], step] <= inner[rows] + above(d2[rows])]
        if not len(rows):
            break
        c = s.order[centre[rows], step]
        new = c != partner[rows]
        at, c = rows[new], c[new]
        d = squared(xs[at], s.centroids[c])
        measured += len(at)
        best = (d < d1[at]) | ((d == d1[at]) & (c < c1[at]))
        next_ = ~best & ((d < d2[at]) | ((d == d2[at]) & (c < c2[at])))
        to = at[best]
        c2[to], d2[to] = c1[to], d1[to]
        c1[to], d1[to] = c[best], d[best]
        c2[at[next_]], d2[at[next_]] = c[next_], d[next_]
    first[open_], second[open_], upper[open_], lower[open_] = c1, c2, above(d1), below(d2)
    return first, second, upper, lower, measured


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _assign_round(s: Search, width: int, fresh: bool):
    """A pass over the vectors: their new state and, last, what each centroid's sum and count gain here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(s.centroids.shape, np.int64), np.zeros(len(s.centroids), np.int64)
        schema = None
        for whole in batches:
            schema = whole.schema
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                x, old = _rows(batch.column(1), width), batch.column(2).to_numpy()
                state = assign(s, x, old, *(batch.column(i).to_numpy() for i in (3, 4, 5)))[:4]
                to = state[0]
                for c in np.unique(np.concatenate([to, old])):
                    gain, loss = to == c, np.zeros(len(to), bool) if fresh else old == c
                    sums[c] += x[gain & ~loss].sum(axis=0, dtype=np.int64) - x[loss & ~gain].sum(axis=0, dtype=np.int64)
                    counts[c] += gain.sum() - loss.sum()
                none = pa.nulls(len(to))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, state), *(none.cast(t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=_NAMES)
        some = np.flatnonzero(counts.astype(bool) | sums.any(axis=1))
        if len(some):
            none = pa.nulls(len(some))
            kinds = [schema.field(i).type for i in range(6)]
            gains = [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(none.cast(t) for t in kinds), *gains], names=_NAMES)

    return run


_STATE = ["id", "x", "first", "second", "upper", "lower"]
_NAMES = [*_STATE, "cluster", "n", "sums"]


def _last_pass(s: Search, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                x = _rows(batch.column(1), width)
                first = assign(s, x, *(batch.column(i).to_numpy() for i in (2, 3, 4, 5)))[0]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first), pa.array(squared(x, s.centroids[first]))], names=["id", "cluster", "distance"])

    return run


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _discard(df: DataFrame, path: str) -> None:
    """Delete a round's table once the next one is written: no later plan reads it."""
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """``id`` and ``x``: vectors of ``width`` components, none null or non-finite, as floor(scale * component)."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where((F.size("vec") == width) & ~bad)
    far = F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}: squared distances would not fit 64 bits"))
    whole = F.transform("vec", lambda v: F.when(F.abs(v * scale) <= MOST, F.floor(v * scale)).otherwise(far.cast("bigint")).cast("int"))
    return rows.select("id", whole.alias("x"))


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3"
) -> tuple[DataFrame, list[list[int]]]:
    """Lloyd's k-means, exactly, on the vectors of :func:`integer_vectors`: (a row per vector, the final centroids).

    The k vectors with the smallest sha256 of ``<salt>:<id>`` start (null ids last, ties by components; all vectors if
    they are fewer). Each round assigns every vector to its nearest centroid (ties: the smaller number), then
    replaces each non-empty centroid by its vectors' componentwise floor(sum / count). After the last
    round vectors are assigned once more. The rows: the id, ``cluster``, ``distance`` (squared), ``cluster_inertia``
    and ``inertia`` (distances summed over the cluster and over all).

    Null vectors, those of another length and those with null or non-finite components have no row; rows with a
    null id or a repeated one are vectors like others; other columns are ignored; an empty table gives an
    empty result and no centroids. A component beyond MOST / scale fails the job rather than overflow.

    A round is one pass over a table of the vectors and their bounds, written below the shared folder; each task
    adds up the moves it saw, so what is shuffled is a row per task and centroid, and what the driver gets is k x
    width sums. k is a parameter: the driver and every task hold k x (width + 2 k) numbers.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vector_col, width, scale)
    state = vectors.select("id", "x", F.lit(0).alias("first"), F.least(F.lit(1), F.lit(k - 1)).alias("second"), F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    state, path = _write(state, "shallot-start")
    starts = state.orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(k).select("x").collect()
    centroids = np.array([r["x"] for r in starts], dtype=np.int64).reshape(len(starts), width)
    kind = state.schema["id"].dataType.simpleString()
    if not len(centroids):
        none = spark.createDataFrame([], f"id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint")
        return none.withColumnRenamed("id", id_col), []
    if len(centroids) < 2:
        state = state.withColumn("second", F.lit(0))
    schema = f"id {kind}, x array<int>, first int, second int, upper double, lower double, cluster int, n bigint, sums array<bigint>"
    before, fresh = None, True
    sums, counts = np.zeros(centroids.shape, dtype=object), np.zeros(len(centroids), dtype=object)
    for _ in range(rounds):
        s = prepare(centroids, before)
        table, to = _write(state.mapInArrow(_assign_round(s, width, fresh), schema), "shallot-round")
        _discard(state, path)
        gains = table.where("sums is not null").select("cluster", "n", F.posexplode("sums").alias("place", "gain"))
        for r in gains.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("gain").alias("gain")).collect():
            sums[r["cluster"], r["place"]] += r["gain"]
            if r["place"] == 0:
                counts[r["cluster"]] += r["n"]
        state, path = table.where("sums is null").select(*_STATE), to
        before, fresh = centroids, False
        centroids = np.array([[v // n for v in row] if n else old.tolist() for row, n, old in zip(sums, counts, centroids)], dtype=np.int64)
    s = prepare(centroids, before)
    out, _ = _write(state.mapInArrow(_last_pass(s, width), f"id {kind}, cluster int, distance bigint"), "shallot-assigned")
    _discard(state, path)
    inertia = {r["cluster"]: r["d"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    per = spark.createDataFrame(list(inertia.items()), "cluster int, cluster_inertia bigint")  # a row a centroid
    rows = out.join(F.broadcast(per), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(sum(inertia.values())).cast("bigint").alias("inertia"))
    return rows, centroids.tolist()


def centroid_digest(centroid: list[int]) -> str:
    """Lowercase hex sha256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
