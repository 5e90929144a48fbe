import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tests import model
from tidewater import (
    clean_events,
    drop_empty_fields,
    drop_empty_mv_fields,
    drop_mv_fields,
    drop_raw_field,
)

SCHEMA_DDL = (
    "id BIGINT, a STRING, __mv_b STRING, _raw STRING, num BIGINT, l ARRAY<STRING>,"
    " n STRUCT<__mv_x: STRING, _raw: STRING, y STRING,"
    "          z: ARRAY<STRUCT<__mv_q: STRING, w: STRING, _raw: STRING>>>,"
    " m MAP<STRING, STRING>,"
    " mm MAP<STRING, STRUCT<__mv_p: STRING, v: STRING>>,"
    " ll ARRAY<ARRAY<STRING>>"
)

STRINGS = [None, "", " ", "x", "0", "__mv_"]
KEYS = ["k", "__mv_k", "_raw", "q", ""]


def _s(r):
    return r.choice(STRINGS)


def _maybe(r, f):
    return None if r.random() < 0.15 else f()


def _event(r, i):
    return {
        "id": i,
        "a": _s(r),
        "__mv_b": _s(r),
        "_raw": _s(r),
        "num": r.choice([None, 0, 5]),
        "l": _maybe(r, lambda: [_s(r) for _ in range(r.randint(0, 4))]),
        "n": _maybe(
            r,
            lambda: {
                "__mv_x": _s(r),
                "_raw": _s(r),
                "y": _s(r),
                "z": _maybe(
                    r,
                    lambda: [
                        _maybe(r, lambda: {"__mv_q": _s(r), "w": _s(r), "_raw": _s(r)})
                        for _ in range(r.randint(0, 3))
                    ],
                ),
            },
        ),
        "m": _maybe(r, lambda: {k: _s(r) for k in r.sample(KEYS, r.randint(0, len(KEYS)))}),
        "mm": _maybe(
            r,
            lambda: {
                k: _maybe(r, lambda: {"__mv_p": _s(r), "v": _s(r)})
                for k in r.sample(KEYS, r.randint(0, len(KEYS)))
            },
        ),
        "ll": _maybe(r, lambda: [_maybe(r, lambda: [_s(r) for _ in range(r.randint(0, 3))]) for _ in range(r.randint(0, 3))]),
    }


def _fill(value, dtype):
    """Struct fields absent in the model output are null in Spark."""
    if value is None:
        return None
    if isinstance(dtype, StructType):
        names = {f.name for f in dtype.fields}
        extra = set(value) - names
        assert not extra, f"model kept keys the Spark schema dropped: {extra}"
        return {f.name: _fill(value.get(f.name), f.dataType) for f in dtype.fields}
    if isinstance(dtype, ArrayType):
        return [_fill(x, dtype.elementType) for x in value]
    if isinstance(dtype, MapType):
        return {k: _fill(v, dtype.valueType) for k, v in value.items()}
    return value


def _to_py(row):
    return row.asDict(recursive=True)


@pytest.fixture(scope="module")
def events(spark):
    r = random.Random(7)
    data = [_event(r, i) for i in range(3000)]
    return data, spark.createDataFrame(data, StructType.fromDDL(SCHEMA_DDL))


@pytest.mark.parametrize(
    "op, fn",
    [
        (drop_mv_fields, model.c1),
        (drop_empty_fields, model.c2),
        (drop_empty_mv_fields, model.c3),
        (drop_raw_field, model.c4),
        (clean_events, model.c5),
    ],
)
def test_cleaners_match_model(events, op, fn):
    data, df = events
    out = op(df)
    got = {r["id"]: _to_py(r) for r in out.collect()}
    for ev in data:
        want = _fill(fn(ev), out.schema)
        assert got[ev["id"]] == want, json.dumps(ev)


def test_clean_events_fuses_the_four_passes(events):
    data, df = events
    fused = {r["id"]: _to_py(r) for r in clean_events(df).collect()}
    chained = {
        r["id"]: _to_py(r)
        for r in drop_raw_field(drop_empty_mv_fields(drop_empty_fields(drop_mv_fields(df)))).collect()
    }
    assert fused == chained


def test_clean_events_idempotent(events):
    _, df = events
    once = clean_events(df)
    assert sorted(map(_to_py, once.collect()), key=lambda d: d["id"]) == sorted(
        map(_to_py, clean_events(once).collect()), key=lambda d: d["id"]
    )


def test_c3_after_c1_c2_is_identity(events):
    _, df = events
    base = drop_empty_fields(drop_mv_fields(df))
    assert sorted(map(_to_py, base.collect()), key=lambda d: d["id"]) == sorted(
        map(_to_py, drop_empty_mv_fields(base).collect()), key=lambda d: d["id"]
    )


def test_clean_events_disabled_is_identity(events):
    _, df = events
    assert clean_events(df, "0") is df
    assert clean_events(df, False) is df


# The rule table (FIXTURES.md section 4) in MAP form, where key presence is visible.
RULES = [
    ('{"a":""}', '{"a":""}', "{}", '{"a":""}', '{"a":""}', "{}"),
    ('{"a":" "}', '{"a":" "}', '{"a":" "}', '{"a":" "}', '{"a":" "}', '{"a":" "}'),
    ('{"__mv_a":"","__mv_b":"x"}', "{}", '{"__mv_b":"x"}', '{"__mv_b":"x"}', '{"__mv_a":"","__mv_b":"x"}', "{}"),
    ('{"_raw":"r","x":"1"}', '{"_raw":"r","x":"1"}', '{"_raw":"r","x":"1"}', '{"_raw":"r","x":"1"}', '{"x":"1"}', '{"x":"1"}'),
]


@pytest.mark.parametrize("row", RULES)
def test_rule_table_map_form(spark, row):
    src, *expected = row
    df = spark.createDataFrame([(src,)], "j string").select(F.from_json("j", "map<string,string>").alias("m"))
    for op, want in zip([drop_mv_fields, drop_empty_fields, drop_empty_mv_fields, drop_raw_field, clean_events], expected):
        got = op(df).first()["m"]
        assert got == json.loads(want), (op.__name__, src)


def test_rule_table_lists_and_nesting(spark):
    df = spark.createDataFrame([(["", None, "x"], [""], {"a": ""})], "l array<string>, l1 array<string>, n struct<a:string>")
    r = clean_events(df).first()
    assert r["l"] == ["x"] and r["l1"] == [] and r["n"]["a"] is None
    r = drop_mv_fields(df).first()
    assert r["l"] == ["", None, "x"] and r["l1"] == [""]


STRUCT_RULES = [
    '{"a":null,"b":0,"c":false}',
    '{"l":["",null,"x"]}',
    '{"l":[""]}',
    '{"n":{"a":""}}',
    '{"_raw":"r","n":{"_raw":"r","x":1}}',
    '{"l":[{"__mv_a":"1"},{"_raw":""}]}',
    '{"__mv_a":"","__mv_b":"x","k":" "}',
]


@pytest.mark.parametrize("src", STRUCT_RULES)
def test_rule_table_struct_form(spark, src):
    df = spark.read.json(spark.sparkContext.parallelize([src]))
    data = json.loads(src)
    for op, fn in [(drop_mv_fields, model.c1), (drop_empty_fields, model.c2), (drop_empty_mv_fields, model.c3),
                   (drop_raw_field, model.c4), (clean_events, model.c5)]:
        out = op(df)
        got = _to_py(out.first()) if out.columns else {}
        assert got == _fill(fn(data), out.schema), (op.__name__, src)
