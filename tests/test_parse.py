import pytest
from pyspark.sql import functions as F

from tidewater import apply_mapping, infer_rows, parse_raw, route_failures
from tidewater.sources.search import explode_results, search_head


def _raws(spark):
    return spark.createDataFrame(
        [(1, ' \t{"k": 1}\n'), (2, "not json"), (3, ""), (4, None), (5, "[1,2]"), (6, '{"k": "x"}'), (7, '　{"k": 7} ')],
        "id int, _raw string",
    )


def test_permissive_parse_and_routing(spark):
    parsed = parse_raw(_raws(spark), "k INT")
    good, dead = route_failures(parsed)
    assert {r.id: r.parsed.k for r in good.collect()} == {1: 1, 7: 7}
    assert sorted(r.id for r in dead.collect()) == [2, 3, 4, 5, 6]
    assert good.count() + dead.count() == 7


def test_failfast_aborts(spark):
    with pytest.raises(Exception):
        parse_raw(_raws(spark), "k INT", mode="failfast").collect()
    ok = spark.createDataFrame([(1, '{"k": 2}')], "id int, _raw string")
    assert parse_raw(ok, "k INT", mode="failfast").first().parsed.k == 2


def test_infer_rows_widens_like_the_json_reader(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5, "c": {"d": true}}',), ('{"b": 3}',)], "j string")
    out = infer_rows(df, "j")
    assert out.columns == ["a", "b", "c"]
    types = dict(out.dtypes)
    assert types["a"] == "double" and types["b"] == "string" and types["c"].startswith("struct")
    assert out.count() == 3


def test_apply_mapping_json_and_csv(spark):
    js = spark.createDataFrame([('{"a": "5", "b": {"c": [10, 20]}, "d": "x"}',)], "j string")
    out = apply_mapping(js, [("a", "$.a", "int"), ("c1", "$.b.c[1]", "bigint"), ("d", "$.d", "int")], "j").first()
    assert (out.a, out.c1, out.d) == (5, 20, None)
    cs = spark.createDataFrame([('1,"a,b",2024-01-02',)], "l string")
    out = apply_mapping(cs, [("x", 0, "bigint"), ("y", 1, "string"), ("z", 2, "date")], "l", kind="csv").first()
    assert out.x == 1 and out.y == "a,b" and str(out.z) == "2024-01-02"


def test_explode_results_requires_results(spark):
    env = spark.createDataFrame([('{"results": [{"_raw": "a"}, {"_raw": "b"}]}',)], "doc string")
    assert [r._raw for r in explode_results(env, "doc", "_raw STRING").collect()] == ["a", "b"]
    bad = spark.createDataFrame([('{"nope": []}',)], "doc string")
    with pytest.raises(Exception):
        explode_results(bad, "doc", "_raw STRING").collect()


def test_search_head_plan_pushes_filter_and_takes_ordered(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    q = search_head(ev, F.col("event_type") == "error", 50, [F.col("ts").desc(), F.col("event_id").desc()])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert q.count() == 50
    capped = search_head(ev, None, 50, ["event_id"], cap=10)
    assert capped.count() == 10


def test_infer_rows_on_empty_input_gives_empty_frame(spark):
    df = spark.createDataFrame([], "j string")
    assert infer_rows(df, "j").count() == 0


def test_append_routed_one_scan(spark, tmp_path):
    from tidewater.sinks.tables import append_routed

    parsed = parse_raw(_raws(spark), "k INT", mode="deadletter")
    target = str(tmp_path / "routed")
    append_routed(parsed, target)
    back = spark.read.parquet(target)
    counts = {r.route: r["count"] for r in back.groupBy("route").count().collect()}
    assert counts == {"good": 2, "dead": 5}
    dead_text = {r._corrupt for r in back.where("route = 'dead'").collect()}
    assert "not json" in dead_text


def test_infer_rows_reads_pretty_printed_payloads(spark):
    import json as _json

    docs = [_json.dumps({"a": i, "s": f"x{i}", "n": {"b": [i, i + 1]}}, indent=4) for i in range(5)]
    df = spark.createDataFrame([("\n  " + d + "\r\n",) for d in docs], "j string")
    out = infer_rows(df, "j")
    assert out.columns == ["a", "n", "s"]
    assert sorted(r.a for r in out.collect()) == list(range(5))
    assert out.where("n.b[1] = a + 1").count() == 5


def test_search_head_large_n_prefilter_is_exact(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    pred = F.col("event_type") != "view"
    plain = search_head(ev, pred, 3000, order)
    fast = search_head(ev, pred, 3000, order, direct_rows=400, sample_rows=500)
    assert fast.count() == 3000
    assert [r.event_id for r in fast.collect()] == [r.event_id for r in plain.collect()]
    asc = [F.col("value"), F.col("event_id")]
    a1 = search_head(ev, None, 2500, asc)
    a2 = search_head(ev, None, 2500, asc, direct_rows=400, sample_rows=500)
    assert [r.event_id for r in a1.collect()] == [r.event_id for r in a2.collect()]


def test_search_head_prefilter_with_nulls_and_ties(spark):
    import random

    r = random.Random(4)
    rows = [(i, None if r.random() < 0.1 else r.randint(0, 40)) for i in range(5000)]
    df = spark.createDataFrame(rows, "id bigint, t bigint")
    t = F.col("t")
    for first in (t, t.desc(), t.asc_nulls_last(), t.desc_nulls_first()):
        order = [first, F.col("id")]
        for k in (480, 4999):
            plain = [x.id for x in search_head(df, None, k, order).collect()]
            fast = [x.id for x in search_head(df, None, k, order, direct_rows=100, sample_rows=400).collect()]
            assert fast == plain, (first, k)
    # rows that nothing tells apart: as many as asked for
    assert search_head(df.select(F.lit(1).alias("same")), None, 700, ["same"], direct_rows=10, sample_rows=40).count() == 700


def test_search_head_selects_by_any_order_type(spark):
    import random
    from datetime import date, datetime, timedelta
    from decimal import Decimal

    r = random.Random(8)
    day = datetime(2024, 3, 30, 23, 59, 59, 1)
    rows = [
        (i, r.choice(["", "é", "a", "ab", "\U0001f600", "b" * 50]) + str(r.randrange(90)), bytes([r.randrange(256) for _ in range(r.randrange(4))]), r.random() < 0.3, Decimal(r.randrange(10**6)) / 100,
         day + timedelta(microseconds=r.randrange(10**12)), day + timedelta(microseconds=r.randrange(10**12)), date(2024, 1, 1) + timedelta(days=r.randrange(90)),
         r.choice([float("nan"), float("inf"), -0.0, 0.0, r.random(), -1e300, 1e18]), r.random())
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id bigint, s string, b binary, f boolean, d decimal(10,2), z timestamp, n timestamp_ntz, y date, x double, r float")
    for name in df.columns[1:]:
        order = [F.col(name).desc(), F.col("id")] if name in "bnxs" else [F.col(name), F.col("f").desc(), F.col("id").desc()]
        plain = [x.id for x in df.orderBy(*order).limit(1200).collect()]
        assert [x.id for x in search_head(df, None, 1200, order, direct_rows=400, sample_rows=500).collect()] == plain, name


def test_an_outlier_does_not_blur_the_selection(spark):
    from tidewater.sources.search import _narrow, _order_keys

    df = spark.range(200_000).select(F.when(F.col("id") == 7, 1e18).otherwise(F.col("id") / 1e6).alias("v"))
    order = [F.col("v").desc()]
    taken, rest, need = _narrow(df, _order_keys(df, order), order, 20_000, 500, 4096)
    sure = df.where(taken).count()
    assert sure + need == 20_000 and df.where(rest).count() <= 500 and df.where(taken & rest).count() == 0
    assert search_head(df, None, 20_000, order, direct_rows=500).agg(F.min("v"), F.max("v"), F.count("*")).first()[:] == ((200_000 - 19_999) / 1e6, 1e18, 20_000)


def test_apply_mapping_csv_reads_doubled_quotes(spark):
    import csv
    import io

    values = ['a "b", c', "x\\y", " lead", ""]
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(values)
    df = spark.createDataFrame([(buf.getvalue(),)], "l string")
    m = [(f"c{i}", i, "string") for i in range(len(values))]
    got = list(apply_mapping(df, m, "l", kind="csv").first())
    assert got[:3] == values[:3]
