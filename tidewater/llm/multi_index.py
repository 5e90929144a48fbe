"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one per half of the normalised vectors, form a product grid of cells.
Every vector is a query: the multi-sequence algorithm visits the grid's cells in order of
their distance from it, until the distance that the target recall needs, and the vectors
in the visited cells are verified by cosine in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize
from tidewater.llm.components import connected_components

#: Vectors (those with the smallest hash) that fit the codebooks and the stopping distance.
FIT_ROWS = 8192
#: Recall of pairs at the least cosine, from one end, that sets how far a traversal goes.
TARGET_RECALL = 0.9995
#: Rows of members or of queries that one block holds.
LEAST_BLOCK, MOST_BLOCK = 256, 8192


class Index(NamedTuple):
    """Codebooks of the halves, distances between their centroids, and the squared distance where a traversal stops."""

    books: tuple[np.ndarray, np.ndarray]
    between: tuple[np.ndarray, np.ndarray]
    reach: float

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the nearest centroid of every row, and its squared distance to every centroid's cell.

        A cell lies beyond the plane halfway between its centroid and the row's nearest one, so the
        distance to that plane bounds the distance to any vector of the cell from below."""
        out = []
        for book, between, part in zip(self.books, self.between, halves(x)):
            d = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
            near = d.argmin(axis=1)
            beyond = np.maximum(0.0, d - d[np.arange(len(x)), near][:, None]) / (2 * between[near])
            beyond[np.arange(len(x)), near] = 0.0
            out.append((near, beyond**2))
        return out

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
        """Multi-sequence traversal of one row: cells in order of the summed distances, up to ``reach``."""
        by1, by2 = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        a, b = first[by1].tolist(), second[by2].tolist()
        heap, out, done = [(a[0] + b[0], 0, 0)], [], set()
        while heap and heap[0][0] <= self.reach:
            _, i, j = heapq.heappop(heap)
            out.append((by1[i], by2[j]))
            done.add((i, j))
            # a cell is queued once both its neighbours nearer to the corner are done
            if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done):
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in done):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return out


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows over their length in double precision; scaled first, so that extreme values neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    points = np.unique(x, axis=0)
    book = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = ((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None]).argmin(axis=1)
        count = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, x)
        book = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], book)
    return np.unique(book, axis=0)


def fit(x: np.ndarray, labels: np.ndarray, cells_a_half: int, least: float, seed: int = 0) -> Index:
    """Codebooks from a sample of unit vectors, and the stopping distance for TARGET_RECALL.

    No linked vector lies beyond the squared distance 2 - 2 * least. Of a difference of that length in a
    random direction, the part across two given planes has the chi-square law of two degrees, whose TARGET_RECALL
    quantile is -2 ln(1 - recall) / dimensions of it: the traversal goes that far at least, and farther
    (up to the bound) where any linked pair of the sample needs it from either end.
    """
    books = tuple(k_means(part, cells_a_half, seed) for part in halves(x))
    between = tuple(np.maximum(1e-12, np.sqrt(((b[:, None] - b[None]) ** 2).sum(axis=2))) for b in books)
    bound = 2.0 * (1.0 - least) * (1 + 1e-9)
    reach = bound * min(1.0, -2.0 * np.log(1.0 - TARGET_RECALL) / x.shape[1])
    index = Index(books, between, reach)
    chunks = [index.bounds(x[at : at + 512]) for at in range(0, len(x), 512)]
    cells, far = ([np.concatenate([c[half][part] for c in chunks]) for half in (0, 1)] for part in (0, 1))
    for at in range(0, len(x), 512):
        i, j = np.nonzero((x[at : at + 512] @ x.T >= least) & (labels[at : at + 512, None] == labels[None]))
        i += at
        there, back = (sum(far[h][a, cells[h][b]] for h in (0, 1)) for a, b in ((i, j), (j, i)))
        reach = max(reach, np.minimum(there, back).max(initial=0.0))
    return index._replace(reach=min(bound, reach))


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98) -> DataFrame:
    """One row per input row: the id, ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable by links, itself included) and ``kept`` (the row's id is its component's).

    Rows link when their labels are equal and not null, their vectors have the same length and their cosine
    is at least ``least``. Null, zero and non-finite vectors and rows without an id link with nothing and are kept.
    Equal vectors are one node, so a group of copies costs one query. Blocks of at most ``MOST_BLOCK`` members and
    as many queries are verified together and give a row per vector, not per pair. Other columns are ignored.
    An empty table gives an empty result.
    """
    spark = df.sparkSession
    # Single precision travels as it is and is widened where it is compared.
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = "float" if single else "double"
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("vec"), F.col(f"`{label_col}`").alias("label"))
    ok = usable(F.col("vec")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    vec = F.transform("vec", lambda v: v + F.lit(0.0).cast(kind))  # -0.0 counts as 0.0
    rows = rows.withColumn("ok", ok).withColumn("vec", F.when(F.col("ok"), vec)).withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec", F.lit(2)))
    key = ["label", "h1", "h2"]
    nodes = rows.where("ok").groupBy(*key).agg(F.min("id").alias("node"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    nodes = materialize(nodes, "index-nodes")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    narrow = rows.select("id", "ok", *key)
    none = narrow.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not size["n"]:
        return none
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).select("label", "vec").toArrow()
    code = {v: i for i, v in enumerate(sorted(set(map(str, sample.column("label").to_pylist()))))}
    x = _matrix(sample.column("vec").combine_chunks(), size["d"])
    index = fit(unit_rows(x), np.array([code[str(v)] for v in sample.column("label").to_pylist()]), int(np.clip(np.sqrt(size["n"]) / 8, 4, 128)), least)

    placed = materialize(nodes.select("node", "n", "label", "vec").mapInArrow(_place(index, size["d"]), _schema(nodes)), "index-placed")
    found = _verify_blocks(placed, size, least)
    found = materialize(found, "index-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = nodes.select(*key, F.col("node"), F.col("n").alias("copies"))
    out = narrow.join(classes, key, "left").join(links.withColumnRenamed("id", "node"), "node", "left").join(parts.withColumnRenamed("id", "node"), "node", "left")
    linked = F.col("ok") & F.col("node").isNotNull()
    component = F.when(linked, F.coalesce("component", "node")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(linked, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _schema(nodes: DataFrame) -> str:
    label, vec = (nodes.schema[c].dataType.simpleString() for c in ("label", "vec"))
    return f"node bigint, n bigint, label {label}, vec {vec}, cell int, seen array<int>"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, filled up with zeros to ``width``."""
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    if len(column) and (size == width).all():
        return values.reshape(len(column), width).astype(np.float64)
    at = np.repeat(np.arange(len(column)), size)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def _place(index: Index, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(index.books[1])
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = unit_rows(_matrix(batch.column(3), width))
                (near1, far1), (near2, far2) = index.bounds(x)
                seen = [[i * many + j for i, j in index.visits(a, b)] for a, b in zip(far1, far2)]
                cells = pa.array((near1 * many + near2).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells, pa.array(seen, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell", "seen"])

    return run


def _verify_blocks(placed: DataFrame, size, least: float) -> DataFrame:
    """``id``, ``links`` (weight of the links counted here) and ``root`` (an id it is connected to), for vectors with links.

    A block is some members of a cell against some of the queries that visit it; the cells' counts
    decide into how many blocks they are cut, so no task holds more than a block's rows.
    """
    most = int(np.clip(-(-size["n"] // 1024), LEAST_BLOCK, MOST_BLOCK))
    keys = ["label", F.size("vec").alias("dim")]
    members = placed.select(*keys, "cell", "node", "n", "vec", "seen", F.col("cell").alias("own"), F.lit(True).alias("member"))
    queries = placed.select(*keys, F.explode("seen").alias("cell"), "node", "n", "vec", F.lit(None).cast("array<int>").alias("seen"), F.col("cell").alias("own"), F.lit(False).alias("member"))
    place = ["label", "dim", "cell"]
    count = members.groupBy(*place).agg(F.count("*").alias("m")).join(queries.groupBy(*place).agg(F.count("*").alias("q")), place)
    count = materialize(count.select(*place, F.ceil(F.col("m") / most).cast("int").alias("m"), F.ceil(F.col("q") / most).cast("int").alias("q")), "index-cells")
    rows = members.unionByName(queries).join(count, place)  # queries of cells without members end here
    slot = lambda many: F.pmod(F.xxhash64("node"), F.col(many)).cast("int")
    every = lambda many: F.sequence(F.lit(0), F.col(many) - 1)
    rows = rows.withColumn("mc", F.explode(F.when(F.col("member"), F.array(slot("m"))).otherwise(every("m"))))
    rows = rows.withColumn("qc", F.explode(F.when(F.col("member"), every("q")).otherwise(F.array(slot("q")))))
    rows = rows.select(*place, "mc", "qc", "member", "node", "n", "vec", "seen", "own")

    def verify(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy()
        node, n, own = (table.column(c).to_numpy() for c in ("node", "n", "own"))
        column = table.column("vec").combine_chunks()
        x = unit_rows(_matrix(column, len(column[0])))
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        near = (x[q] @ x[m].T >= least) & (node[q][:, None] != node[m][None])
        qi, mi = np.nonzero(near)
        if not len(qi):
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        # A query counts its links here. A member counts one only if it does not visit the query's cell itself.
        lists = table.column("seen").combine_chunks().take(pa.array(m))
        flat, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        visits = set(zip(np.repeat(np.arange(len(m)), np.diff(bounds)).tolist(), flat.tolist()))
        owners, which = np.unique(own[q], return_inverse=True)
        blind = np.array([[(k, c) not in visits for c in owners.tolist()] for k in range(len(m))])
        links = np.zeros(len(node), np.int64)
        np.add.at(links, q[qi], n[m[mi]])
        once = blind[mi, which[qi]]
        np.add.at(links, m[mi[once]], n[q[qi[once]]])
        # Roots: the smallest id of each linked part of the block.
        label = node.copy()
        while True:
            before = label.copy()
            np.minimum.at(label, q[qi], label[m[mi]])
            np.minimum.at(label, m[mi], label[q[qi]])
            if np.array_equal(before, label):
                break
        some = np.unique(np.concatenate([q[qi], m[mi]]))
        return pa.table({"id": node[some], "links": links[some], "root": label[some]})

    return rows.groupBy(*place, "mc", "qc").applyInArrow(verify, "id bigint, links bigint, root bigint")
