"""Property tests (hypothesis) for B1 on random shapes."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater import assign_byte_batch


@settings(max_examples=6, deadline=None)
@given(
    seed=st.integers(0, 10_000),
    hot_share=st.floats(0.0, 0.9),
    max_bytes=st.integers(50, 5_000),
    n_chunks=st.integers(2, 40),
)
def test_byte_batches_equal_plain_window_and_stay_bounded(spark, seed, hot_share, max_bytes, n_chunks):
    r = random.Random(seed)
    rows = []
    for i in range(3000):
        key = "hot" if r.random() < hot_share else (None if r.random() < 0.1 else f"k{r.randint(0, 9)}")
        rows.append((i, key, r.randint(0, 1000), "x" * r.randint(0, 120)))
    df = spark.createDataFrame(rows, "id bigint, key string, t bigint, p string")
    got = assign_byte_batch(df, "p", ["t", "id"], "key", max_bytes=max_bytes, n_chunks=n_chunks)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn(
        "want", F.floor(F.coalesce(F.sum(F.octet_length("p")).over(w), F.lit(0)) / F.lit(max_bytes))
    )
    joined = got.join(want.select("id", "want"), "id")
    assert joined.count() == 3000
    assert joined.where(F.col("batch_id") != F.col("want")).count() == 0
    sizes = got.groupBy("key", "batch_id").agg(F.sum(F.octet_length("p")).alias("b"))
    assert sizes.where(F.col("b") > max_bytes + 120).count() == 0


# --- cleaners on random JSON documents, schema inferred by Spark -------------

import json  # noqa: E402

import pytest  # noqa: E402

from tests import model  # noqa: E402
from tests.test_cleaning import _fill, _to_py  # noqa: E402
from tidewater import (  # noqa: E402
    clean_events,
    drop_empty_fields,
    drop_empty_mv_fields,
    drop_mv_fields,
    drop_raw_field,
)

_STR = st.sampled_from([None, "", " ", "x", "__mv_"])


def _obj(depth):
    fields = {
        "s": _STR,
        "__mv_s": _STR,
        "_raw": _STR,
        "n": st.one_of(st.none(), st.integers(-3, 3)),
        "l": st.one_of(st.none(), st.lists(_STR, max_size=4)),
    }
    if depth < 3:
        child = st.deferred(lambda: _obj(depth + 1))
        fields["o"] = st.one_of(st.none(), child)
        fields["__mv_o"] = st.one_of(st.none(), child)
        fields["lo"] = st.one_of(st.none(), st.lists(child, max_size=3))
    return st.fixed_dictionaries({}, optional=fields)


def _project(value, dtype):
    """The part of a document the DataFrame holds (inference may drop fields
    that are only ever empty objects)."""
    from pyspark.sql.types import ArrayType, StructType

    if value is None:
        return None
    if isinstance(dtype, StructType):
        names = {f.name: f.dataType for f in dtype.fields}
        return {k: _project(v, names[k]) for k, v in value.items() if k in names}
    if isinstance(dtype, ArrayType):
        return [_project(x, dtype.elementType) for x in value]
    return value


OPS = [
    (drop_mv_fields, model.c1),
    (drop_empty_fields, model.c2),
    (drop_empty_mv_fields, model.c3),
    (drop_raw_field, model.c4),
    (clean_events, model.c5),
]


@settings(max_examples=4, deadline=None)
@given(docs=st.lists(_obj(0), min_size=5, max_size=20))
def test_cleaners_on_inferred_random_documents(spark, docs):
    docs = [dict(d, id=i) for i, d in enumerate(docs)]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(d) for d in docs]))
    if "id" not in df.columns:
        pytest.skip("no documents")
    for op, fn in OPS:
        out = op(df)
        got = {r["id"]: _to_py(r) for r in out.collect()}
        for d in docs:
            seen = _project(d, df.schema)
            assert got[d["id"]] == _fill(fn(seen), out.schema), (op.__name__, json.dumps(d))
