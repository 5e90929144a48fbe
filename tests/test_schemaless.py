"""C1-C5 on events without a common schema, against a plain model."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.model import c1, c2, c3, c4, c5
from tidewater.functions.cleaning import C1_DROP_MV, C2_DROP_EMPTY, C3_DROP_EMPTY_MV, C4_DROP_RAW, C5_ALL, json_depth
from tidewater.operators.clean import clean_json_events

RULES = [(C1_DROP_MV, c1), (C2_DROP_EMPTY, c2), (C3_DROP_EMPTY_MV, c3), (C4_DROP_RAW, c4), (C5_ALL, c5)]


def _any(rng, depth):
    t = rng.random()
    if depth == 0 or t < 0.35:
        return rng.choice([None, "", "", " ", 0, 1, False, True, "a", "[", '{"}', "\\", 1.5, -3, 'é"\n', 10**15])
    if t < 0.65:
        return [_any(rng, depth - 1) for _ in range(rng.randrange(4))]
    keys = ["a", "b", "_raw", "__mv_a", "__mv_", "c d", "", "é", "x.y", "$"]
    return {rng.choice(keys): _any(rng, depth - 1) for _ in range(rng.randrange(5))}


@pytest.fixture(scope="module")
def events():
    rng = random.Random(1)
    return [_any(rng, rng.randrange(1, 6)) for _ in range(800)]


@pytest.mark.parametrize("rule, plain", RULES, ids=[r.name for r, _ in RULES])
def test_any_json_equals_the_model(spark, events, rule, plain):
    df = spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(events)], "i int, event string")
    for r in clean_json_events(df, "event", rule).collect():
        assert json.loads(r.event) == plain(events[r.i]), events[r.i]


def test_variants_equal_text_and_odd_rows_pass(spark):
    texts = ['{"a":{"__mv_x":1,"b":[null,"",{"_raw":2}]}}', "not json", None, "", '[""]', '{"a":""}', "7", '""', "null", "{}", "[]"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i int, event string, key string")
    out = {r.i: (r.event, r.bad) for r in clean_json_events(df, "event", corrupt_col="bad").collect()}
    assert out[0] == ('{"a":{"b":[{}]}}', None) and out[1] == (None, "not json") and out[2] == (None, None) and out[3] == (None, "")
    assert [out[i][0] for i in range(4, 11)] == ["[]", "{}", "7", '""', "null", "{}", "[]"]
    v = clean_json_events(df.withColumn("event", F.try_parse_json("event")), "event").select("i", F.to_json("event").alias("event"))
    assert {r.i: r.event for r in v.collect()} == {i: e for i, (e, _) in out.items()}
    assert clean_json_events(df.limit(0), "event").count() == 0


def test_depth_is_measured_or_checked(spark):
    texts = ["1", "[]", '{"a":[[{"b":"[[[[["}]]}', '"{{{"', r'{"a":"\"[["}', "[" * 40 + "]" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "event string")
    assert [r[0] for r in df.select(json_depth(F.col("event"))).collect()] == [0, 1, 4, 0, 1, 40]
    assert clean_json_events(df, "event").where("event is null").count() == 0
    with pytest.raises(Exception, match="nests deeper"):
        clean_json_events(df, "event", depth=3).collect()
