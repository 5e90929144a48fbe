"""N-gram Jaccard join by grouped prefixes.

A text is the set of its word shingles. Texts with equal sets are one node. Shingles
have one global order, rare ones first; two sets that are similar enough share a shingle
of their prefixes. Nodes with equal prefixes and sizes form a group. Groups that share a prefix shingle
are paired where their sizes and the shingle's places allow; pairs connect them into candidate
neighbourhoods. In each, group pairs are filtered by size and prefix, and the members of those left are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, maybe_in
from tidewater.llm.components import connected_components
from tidewater.llm.textarrays import Texts, mix64, range_hashes, slices, texts, words

#: Sets of up to this many shingles count all of them, in an order of their own among themselves.
SMALL = 128
#: The low bits of a shingle say which order it belongs to.
SMALL_KIND, COUNTED_KIND, EXTRA_KIND = 0, 1, 2
#: Groups that share a prefix shingle are paired one by one up to so many, and held together by a star beyond.
LIGHT = 64
#: Nodes that a block of the verification has on either side.
LEAST_BLOCK, MOST_BLOCK = 128, 4096


def shingles(t: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, in order of text and hash, and their bounds by text.

    Words are compared with A-Z as a-z. A text with fewer words than ``size`` has its whole sequence as one
    shingle; a text without words has none."""
    w = words(t)
    h = range_hashes(t.data, w.begin, w.end, lower=True)
    count = np.diff(w.first)
    n = len(h) - size + 1
    parts, owners = [], []
    if n > 0:
        s = _sequence(h, np.arange(n), size)
        inside = (w.text[:n] == w.text[size - 1 :]) if n else np.zeros(0, bool)
        parts.append(s[inside]), owners.append(w.text[:n][inside])
    for short in range(1, size):
        which = np.flatnonzero(count == short)
        parts.append(_sequence(h, w.first[which], short)), owners.append(which)
    value, owner = np.concatenate(parts), np.concatenate(owners)
    by = np.lexsort((value, owner))
    value, owner = value[by], owner[by]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(t.n + 1))


def _sequence(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[at + k])
    return out


def counted_one_in(percent: int, room: float) -> int:
    """One shingle in this many (by hash) comes before the others in the global order and is counted: ``room``
    times the prefix, so that shingles that several texts have can be left to its end."""
    return max(1, int(100 / (room * max(1, 100 - percent))))


def prefix_length(n: np.ndarray | int, percent: int):
    """Shingles of a set of n that cannot all be missing from a set whose Jaccard similarity is ``percent`` or more."""
    return n - (n * percent + 99) // 100 + 1


def _signatures(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: two sums of scrambled members modulo 2**64."""
    out = []
    for salt in (1, 2):
        run = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix64(value ^ mix64(np.array([salt], np.uint64))), out=run[1:])
        out.append((run[first[1:]] - run[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _lists(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


def _summaries(size: int):
    """id, set size and signatures of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                value, first = shingles(texts(batch.column(1)[at:to]), size)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], pa.array(np.diff(first)), *map(pa.array, _signatures(value, first))], names=["id", "n", "s1", "s2"])

    return run


def _ordered_part(size: int, percent: int, room: float):
    """The shingles of each text that take part in the orders, as KIND bits and hash: all of a small set; the
    counted ones of a set that is not far below SMALL or above it, and those that its prefix needs beyond them.

    Two sets that are similar enough are both small, or both in the other part: their sizes are too close."""
    one_in = np.uint64(counted_one_in(percent, room))
    clear = ~np.uint64(3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                value, first = shingles(texts(batch.column(1)[at:to]), size)
                n = np.diff(first)
                s1, _ = _signatures(value, first)
                owner = np.repeat(np.arange(to - at), n)
                small = (n <= SMALL)[owner]
                large = (n * 100 >= SMALL * percent)[owner]
                counted = large & (value % one_in == 0)
                n_counted = np.bincount(owner[counted], minlength=to - at)
                lack = np.maximum(0, np.where(n > 0, prefix_length(n, percent), 0) - n_counted)
                other = np.flatnonzero(large & ~counted)
                extra = other[np.arange(len(other)) - np.searchsorted(owner[other], owner[other]) < lack[owner[other]]]
                picked = [(np.flatnonzero(small), SMALL_KIND), (np.flatnonzero(counted), COUNTED_KIND), (extra, EXTRA_KIND)]
                rows = np.concatenate([p for p, _ in picked])
                tagged = np.concatenate([(value[p] & clear) | np.uint64(kind) for p, kind in picked])
                by = np.argsort(owner[rows], kind="stable")
                rows, tagged = rows[by], tagged[by]
                bounds = np.searchsorted(owner[rows], np.arange(to - at + 1))
                yield pa.RecordBatch.from_arrays([pa.array(s1), _lists(tagged, bounds)], names=["s1", "shingles"])

    return run


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90, room: float = 1.6) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id`` (smallest id reachable by links,
    itself included), ``n_links`` (other rows linked directly) and ``copies`` (rows with the same set).

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of ``size``-word shingles.
    Null and empty texts have empty sets and link with nothing, as do rows without an id. Rows with one id
    and different texts count as one document for the links. Texts with equal sets are one node, so groups of
    copies cost one row. Every neighbourhood is verified in blocks of at most ``MOST_BLOCK`` nodes a side, whole;
    a block gives a row per node, not per pair. ``room``: shingles counted for the order, as a multiple of the
    prefix (a matter of cost alone). Shingles and sets are known by 62- and 64-bit hashes where candidates are
    sought; links are verified on 64-bit hashes of whole sets, copies found by 128 bits. Other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    summary = materialize(rows.mapInArrow(_summaries(size), "id bigint, n bigint, s1 bigint, s2 bigint"), "jaccard-sets")
    key = ["n", "s1", "s2"]
    live = summary.where("n > 0 AND id IS NOT NULL")
    nodes = materialize(live.groupBy(*key).agg(F.min("id").alias("node"), F.count("*").alias("copies")), "jaccard-nodes")
    # The shingles of one text per set, from a second reading of those that may have a node's id: cheaper than to write
    # those of all rows. Other rows that slip through have sets of other nodes, so equal ones are dropped.
    parts = maybe_in(rows, "id", nodes.select("node"), "__may").where("__may").select("id", "text")
    parts = parts.mapInArrow(_ordered_part(size, percent, room), "s1 bigint, shingles array<bigint>").dropDuplicates(["s1"])
    parts = materialize(parts, "jaccard-parts")
    near = _candidates(nodes, parts, percent)
    found = materialize(_verify(rows, near, size, percent), "jaccard-links")
    links = found.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "node")
    classes = nodes.select(*key, "node", "copies").join(links, "node", "left").join(parts, "node", "left")
    out = summary.select("id", *key).join(classes, key, "left")
    own = F.col("id").isNotNull() & F.col("node").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(own, F.coalesce("component", "node")).otherwise(F.col("id")).alias("component_id"),
        F.when(own, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(own, F.col("copies")).otherwise(1).cast("bigint").alias("copies"),
    )


def _candidates(nodes: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``near`` (a neighbourhood), node, copies, n, s1, s2, group and prefix of the nodes that may have links.

    Order of a small set's shingles: by the number of small sets that have them and hash. Of the others: the
    counted ones likewise, then the rest by hash. A shingle that one node has cannot match, so only those of two
    or more travel back to their nodes.
    """
    each = parts.select("s1", F.explode("shingles").alias("shingle"))
    shared = materialize(each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-shared")
    kind = F.col("shingle").bitwiseAND(F.lit(3))
    rank = F.when(kind == EXTRA_KIND, 0).otherwise(F.col("df")).alias("df")
    back = each.join(shared, "shingle").groupBy("s1").agg(F.array_sort(F.collect_list(F.struct(kind.alias("kind"), rank, "shingle"))).alias("known"))
    many = lambda kind: F.size(F.filter("shingles", lambda x: x.bitwiseAND(F.lit(3)) == kind))
    counts = parts.select("s1", many(SMALL_KIND).alias("n_small"), many(COUNTED_KIND).alias("n_counted"))
    need = F.expr(f"CAST(n - (n * {percent} + 99) DIV 100 + 1 AS INT)")
    of = lambda *kinds: F.filter("known", lambda x: x["kind"].isin(*kinds))
    alone_small, alone = F.col("n_small") - F.size(of(SMALL_KIND)), F.col("n_counted") - F.size(of(COUNTED_KIND))
    head = lambda known, alone: F.slice(known, 1, F.greatest(F.lit(0), need - alone))
    of_small = head(of(SMALL_KIND), alone_small)
    of_large = F.when(F.col("n_counted") >= need, head(of(COUNTED_KIND), alone)).otherwise(of(COUNTED_KIND, EXTRA_KIND))
    cols = ["node", "copies", "n", "s1", "s2"]
    rows = nodes.join(back.join(counts, "s1"), "s1")
    # Where a shingle stands in its set's order at least: behind those that no other set has, which come first.
    placed = lambda known, alone: F.transform(known, lambda x, i: F.struct(x["shingle"].alias("shingle"), (alone + i).cast("int").alias("place")))
    known = F.concat(placed(of_small, alone_small), placed(of_large, alone)).alias("known")
    rows = rows.select(*cols, known, ((alone_small == 0) & (alone == 0)).alias("whole"))
    rows = rows.select(*cols, F.transform("known", lambda x: x["shingle"]).alias("prefix"), F.transform("known", lambda x: x["place"]).alias("places"), "whole")
    rows = rows.where(F.size("prefix") > 0)
    # Groups: equal size and prefix (a prefix with a shingle of its own is no other's).
    rows = rows.withColumn("group_key", F.when(F.col("whole"), F.xxhash64("n", "prefix")).otherwise(F.xxhash64("n", "prefix", "node", "s1"))).drop("whole")
    rows = materialize(rows, "jaccard-prefixes")
    rows = rows.withColumnRenamed("group_key", "group")
    groups = rows.groupBy("group", "n").agg(F.first("prefix").alias("prefix"), F.first("places").alias("places"))
    postings = groups.select("group", "n", F.explode(F.arrays_zip("prefix", "places")).alias("x")).select("group", "n", F.col("x.prefix").alias("shingle"), F.col("x.places").alias("place"))
    postings = materialize(postings, "jaccard-postings")
    several = postings.groupBy("shingle").agg(F.count("*").alias("many")).where("many > 1")
    postings = materialize(postings.join(several, "shingle"), "jaccard-postings")
    near = connected_components(_pairs(postings.where(F.col("many") <= LIGHT), percent).unionAll(_stars(postings.where(F.col("many") > LIGHT), percent)))
    near = near.select(F.col("id").alias("group"), F.col("component").alias("near"))
    rows = rows.join(near, "group", "left")
    rows = rows.drop("places").withColumn("near", F.coalesce("near", "group"))  # a group of several nodes may stand alone
    rows = materialize(rows, "jaccard-grouped")
    many = rows.groupBy("near").agg(F.count("*").alias("nodes")).where("nodes > 1")
    return materialize(rows.join(many, "near"), "jaccard-near")


def _pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups on one list that may be similar: by their sizes, and by what can follow their first common shingle
    in both orders."""
    a = postings.select("shingle", F.col("group").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"))
    b = postings.select("shingle", F.col("group").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    reach = left * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    return a.join(b, "shingle").where((F.col("a") < F.col("b")) & fits & reach).select("a", "b").distinct()


def _stars(postings: DataFrame, percent: int) -> DataFrame:
    """Links that hold all groups on one long list together, without its pairs. Similar sets differ in size by at most one step."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent + 1e-9))).cast("int")
    postings = postings.select("group", step.alias("step"), "shingle")
    leaders = materialize(postings.groupBy("shingle", "step").agg(F.min("group").alias("leader")), "jaccard-leaders")
    follow = postings.join(leaders, ["shingle", "step"]).select(F.col("group").alias("a"), F.col("leader").alias("b"))
    above = leaders.select("shingle", (F.col("step") - 1).alias("step"), F.col("leader").alias("b"))
    return follow.unionAll(leaders.join(above, ["shingle", "step"]).select(F.col("leader").alias("a"), "b"))


def _full_sets(rows: DataFrame, near: DataFrame, size: int) -> DataFrame:
    """The candidates with their whole sets, from a second reading of their texts."""
    wanted = near.select(F.col("node").alias("id"), "s1", "s2", "n").distinct()
    few = maybe_in(rows, "id", wanted.select("id").distinct(), "__may").where("__may").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                value, first = shingles(texts(batch.column(1)[at:to]), size)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], *map(pa.array, _signatures(value, first)), _lists(value, first)], names=["node", "s1", "s2", "members"])

    sets = few.mapInArrow(run, "node bigint, s1 bigint, s2 bigint, members array<bigint>")
    return near.join(sets, ["node", "s1", "s2"])


def _verify(rows: DataFrame, near: DataFrame, size: int, percent: int) -> DataFrame:
    """``id``, ``links`` (rows linked to it, counted here) and ``root`` (an id it is connected to).

    The nodes of a neighbourhood are cut into k parts by hash; a block is a pair of parts, so every pair
    of nodes meets in one block. Blocks of one neighbourhood go to consecutive partitions."""
    total = near.count()
    most = int(np.clip(-(-total // 1024), LEAST_BLOCK, MOST_BLOCK))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = _full_sets(rows, near, size)
    sets = sets.withColumn("k", F.ceil(F.col("nodes") / most).cast("int")).withColumn("part", F.pmod(F.xxhash64("node", "s1"), F.col("k")).cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    sets = sets.withColumn("block", F.least("part", "other") * F.col("k") + F.greatest("part", "other"))
    sets = sets.withColumn("to", F.pmod(F.xxhash64("near") + F.col("block"), F.lit(partitions)).cast("int"))
    sets = sets.select("to", "near", "block", "k", "part", "node", "s1", "copies", "n", "group", "prefix", "members")
    sets = sets.repartitionById(partitions, F.col("to")).sortWithinPartitions("near", "block", "node", "s1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            out = verify_block(block, percent)
            if out is not None:
                yield out

    return sets.drop("to").mapInArrow(run, "id bigint, links bigint, root bigint")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one (near, block), joined over batch ends."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        near, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((near[1:] != near[:-1]) | (block[1:] != block[:-1])) + 1
        for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if at == to:
                continue
            own = (near[at], block[at])
            if held and own != key:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(at, to - at))
    if held:
        yield pa.Table.from_batches(held)


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values and the row of each."""
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))


def common_counts(values: np.ndarray, row: np.ndarray, n: int, width: int = 4096) -> np.ndarray:
    """How many values each two of n rows have in common (values are distinct in a row)."""
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    several = count[code] > 1
    code = np.searchsorted(np.flatnonzero(count > 1), code[several])
    row = row[several]
    by = np.argsort(code, kind="stable")
    code, row = code[by], row[by]
    out = np.zeros((n, n), np.float32)
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        has = np.zeros((n, min(width, int(code[b - 1]) + 1 - low)), np.float32)
        has[row[a:b], code[a:b] - low] = 1.0
        out += has @ has.T
    return out


def verify_block(block: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Links among a block's nodes: group pairs that share no prefix shingle or differ too much in size are
    passed over; the members of the others are compared whole."""
    node, copies, n, group, part = (block.column(c).to_numpy() for c in ("node", "copies", "n", "group", "part"))
    many = len(node)
    # Group pairs: sizes and prefixes are the same in a group.
    _, first, of = np.unique(np.stack([group, n]), axis=1, return_index=True, return_inverse=True)
    of = of.ravel()
    values, row = _flat(block, "prefix")
    lead = np.isin(row, first)
    meet = common_counts(values[lead], of[row[lead]], len(first)) > 0
    np.fill_diagonal(meet, True)  # members of one group share its whole prefix
    size = n[first]
    fits = np.minimum(size[:, None], size[None]) * 100 >= np.maximum(size[:, None], size[None]) * percent
    pairs = (meet & fits)[of][:, of]
    own_block = block.column("block")[0].as_py()
    k = block.column("k")[0].as_py()
    if own_block // k != own_block % k:  # a block of two parts has only the pairs across
        pairs &= part[:, None] != part[None]
    np.fill_diagonal(pairs, False)
    rows = np.flatnonzero(pairs.any(axis=1))
    if not len(rows):
        return None
    values, row = _flat(block, "members")
    spot = np.full(many, -1)
    spot[rows] = np.arange(len(rows))
    inside = spot[row] >= 0
    common = common_counts(values[inside], spot[row[inside]], len(rows)).astype(np.int64)
    size = n[rows]
    linked = pairs[np.ix_(rows, rows)] & (common * 100 >= (size[:, None] + size[None] - common) * percent)
    links = linked @ copies[rows]
    label = node[rows].copy()
    a, b = np.nonzero(linked)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        if np.array_equal(before, label):
            break
    some = np.flatnonzero(links)
    if not len(some):
        return None
    return pa.RecordBatch.from_arrays([pa.array(node[rows][some]), pa.array(links[some]), pa.array(label[some])], names=["id", "links", "root"])
