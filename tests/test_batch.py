import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater import assign_byte_batch, assign_count_batch, assign_time_batch, tag_run
from tidewater.operators.batch import _with_auto_chunk, order_chunk, running_before


def _skewed(spark, n=20000, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if r.random() < 0.4 else (None if r.random() < 0.05 else f"k{r.randint(0, 20)}")
        rows.append((i, key, "x" * r.randint(0, 300)))
    return spark.createDataFrame(rows, "id bigint, key string, payload string")


def _plain_before(df, weight):
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("want", F.coalesce(F.sum(weight).over(w), F.lit(0)))


def test_chunked_prefix_sum_equals_plain_window(spark):
    df = _skewed(spark)
    got = running_before(df, F.octet_length("payload"), "id", "key", chunk=order_chunk("id", 700), out_col="got")
    want = _plain_before(df, F.octet_length("payload")).select("id", "want")
    bad = got.join(want, "id").where(F.col("got") != F.col("want")).count()
    assert got.count() == df.count()
    assert bad == 0


def test_auto_chunks_equal_plain_window(spark):
    df = _skewed(spark)
    got = running_before(df, F.octet_length("payload"), "id", "key", chunk="auto", out_col="got", n_chunks=37)
    want = _plain_before(df, F.octet_length("payload")).select("id", "want")
    assert got.join(want, "id").where(F.col("got") != F.col("want")).count() == 0
    assert got.count() == df.count()


def test_auto_chunks_on_timestamps(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    auto = assign_count_batch(df, ["ts", "event_id"], "event_type", n=7)
    plain = assign_count_batch(df, ["ts", "event_id"], "event_type", n=7, chunk=None)
    assert auto.select("event_id", "batch_id").exceptAll(plain.select("event_id", "batch_id")).count() == 0


def test_byte_batches_bounded_and_monotone(spark):
    df = _skewed(spark)
    max_bytes = 20_000
    b = assign_byte_batch(df, "payload", "id", "key", max_bytes=max_bytes, chunk=order_chunk("id", 1000))
    per = b.groupBy("key", "batch_id").agg(
        F.sum(F.octet_length("payload")).alias("bytes"), F.min("id").alias("lo"), F.max("id").alias("hi")
    )
    assert per.where(F.col("bytes") > max_bytes + 300).count() == 0
    w = Window.partitionBy("key").orderBy("batch_id")
    overlap = per.withColumn("prev_hi", F.lag("hi").over(w)).where(F.col("lo") < F.col("prev_hi")).count()
    assert overlap == 0
    plain = assign_byte_batch(df, "payload", "id", "key", max_bytes=max_bytes, chunk=None)
    assert b.select("id", "batch_id").exceptAll(plain.select("id", "batch_id")).count() == 0


def test_count_batches(spark):
    df = _skewed(spark)
    b = assign_count_batch(df, "id", "key", n=500, chunk=order_chunk("id", 333))
    sizes = b.groupBy("key", "batch_id").count()
    # every batch but the last of a key holds exactly n rows
    last = sizes.groupBy("key").agg(F.max("batch_id").alias("last"))
    full = sizes.join(last, sizes.key.eqNullSafe(last.key)).where(F.col("batch_id") < F.col("last"))
    assert full.where(F.col("count") != 500).count() == 0
    assert b.count() == df.count()


def test_time_batch_names(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.999",), ("2024-01-02 03:04:06",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts")
    )
    names = [r[0] for r in assign_time_batch(df, "ts").select("batch_name").collect()]
    assert names == ["ingest-20240102-030405", "ingest-20240102-030406"]


def test_tag_run(spark):
    df = spark.range(3)
    assert {r[0] for r in tag_run(df, "r1").select("run_id").collect()} == {"r1"}


def test_unpartitioned_running_total_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        running_before(spark.range(3), F.lit(1), "id", [])


def test_auto_chunks_bound_the_hot_key(spark):
    from tidewater.operators.batch import _with_auto_chunk

    df = _skewed(spark, n=30000)
    n_chunks = 20
    chunked = _with_auto_chunk(df, ["key"], ["id"], n_chunks, "c")
    sizes = chunked.groupBy("key", "c").count()
    biggest = sizes.agg(F.max("count")).first()[0]
    hot_rows = df.where("key = 'hot'").count()
    assert hot_rows > 10000
    assert biggest <= 1.5 * 30000 / n_chunks
    # only the hot key is split; cold keys (each under rows / n_chunks) stay whole
    per_key = {r["key"]: r["n"] for r in sizes.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert per_key["hot"] >= n_chunks - 2
    assert all(n == 1 for k, n in per_key.items() if k != "hot")


def test_large_side_is_shuffled_once_without_broadcast(spark):
    """At scale the offsets join is a shuffle join; the in-chunk window must
    reuse its partitioning instead of shuffling the large side again."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
        b = assign_count_batch(orders, "o_orderkey", "o_orderpriority", n=10, chunk=order_chunk("o_orderkey", 100))
        b.write.format("noop").mode("overwrite").save()
        plan = b._jdf.queryExecution().executedPlan().toString()
        between = plan.split("Window [sum(1)")[1].split("SortMergeJoin")[0]
        assert "SortMergeJoin" in plan and "Exchange" not in between, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_order_by_columns_and_string_order(spark):
    import pytest

    df = _skewed(spark, n=2000)
    b = assign_count_batch(df, [F.col("id")], "key", n=50, chunk=order_chunk("id", 100))
    plain = assign_count_batch(df, "id", "key", n=50, chunk=None)
    assert b.select("id", "batch_id").exceptAll(plain.select("id", "batch_id")).count() == 0
    with pytest.raises(ValueError):
        assign_count_batch(df, "payload", "key", n=50)


def test_null_order_values_and_keys_match_plain_window(spark):
    r = random.Random(21)
    rows = []
    for i in range(6000):
        key = "hot" if r.random() < 0.5 else (None if r.random() < 0.2 else f"k{r.randint(0, 30)}")
        ts = None if r.random() < 0.05 else r.randint(0, 10_000)
        rows.append((i, key, ts, r.randint(0, 50)))
    df = spark.createDataFrame(rows, "id bigint, key string, t bigint, w int")
    got = running_before(df, F.col("w"), ["t", "id"], "key", chunk="auto", out_col="got", n_chunks=12)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("want", F.coalesce(F.sum("w").over(w), F.lit(0))).select("id", "want")
    assert got.count() == 6000
    assert got.join(want, "id").where(F.col("got") != F.col("want")).count() == 0


def test_time_batch_keeps_undated_rows_and_matches_window(spark):
    from tidewater.operators.batch import duration_micros

    assert duration_micros("1 hour 30 minutes") == 5_400_000_000
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    with_null = ev.union(spark.createDataFrame([(-1, None)], "event_id bigint, ts timestamp_ntz"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for every in ("1 second", "7 minutes", "1 day"):
                got = assign_time_batch(with_null, "ts", every)
                assert got.count() == ev.count() + 1
                assert got.where("event_id = -1 AND batch_start IS NULL").count() == 1
                want = ev.withColumn("w", F.window("ts", every).start)
                diff = got.join(want, "event_id").where(F.col("batch_start") != F.col("w")).count()
                assert diff == 0, (tz, every)
            ltz = ev.withColumn("ts", F.col("ts").cast("timestamp"))
            got = assign_time_batch(ltz, "ts", "1 hour").join(ltz.withColumn("w", F.window("ts", "1 hour").start), "event_id")
            assert got.where(F.col("batch_start") != F.col("w")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_duration_parser_rejects_bad_input():
    import pytest

    from tidewater.operators.batch import duration_micros

    assert duration_micros("5 seconds") == 5_000_000 and duration_micros("2 days") == 172_800_000_000
    for bad in ("", "5", "0 seconds", "3 fortnights"):
        with pytest.raises((ValueError, KeyError)):
            duration_micros(bad)


def test_work_paths_are_unique_under_the_checkpoint_root(spark):
    from tidewater.session import checkpoint_root, work_path

    root = checkpoint_root(spark)
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def _mismatches(df, order, keys, n_chunks=16):
    got = running_before(df, F.lit(1), order, keys, "auto", "before", n_chunks)
    want = running_before(df, F.lit(1), order, keys, None, "before")
    cols = [*df.columns, "before"]
    return got.select(cols).exceptAll(want.select(cols)).count() + want.select(cols).exceptAll(got.select(cols)).count()


def test_wall_clock_order_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        start = F.lit("2024-03-10 00:30:00").cast("timestamp_ntz")
        df = spark.range(4000).select("id", F.timestamp_add("SECOND", F.col("id") * 3, start).alias("ts"), (F.col("id") % 3).alias("k"))
        assert _mismatches(df, ["ts", "id"], ["k"]) == 0
        chunk = order_chunk("ts", 600_000_000, "timestamp_ntz")
        got = running_before(df, F.lit(1), ["ts", "id"], ["k"], chunk, "b")
        want = running_before(df, F.lit(1), ["ts", "id"], ["k"], None, "b")
        assert got.exceptAll(want).count() == 0
        named = assign_time_batch(df, "ts", "1 minute").where(F.date_trunc("MINUTE", "ts") != F.col("batch_start"))
        assert named.count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ties_of_the_first_order_column_are_split(spark):
    df = spark.range(20_000).select(
        "id", F.lit(1.0).alias("v"), F.lit("x").alias("k"), F.concat(F.lit("ab"), F.lpad((F.col("id") % 5000).cast("string"), 6, "0")).alias("s")
    )
    assert _mismatches(df, ["v", "s", "id"], ["k"]) == 0
    for order in (["v", "id"], ["v", "s", "id"]):
        largest = _with_auto_chunk(df, ["k"], order, 16, "c").groupBy("c").count().agg(F.max("count")).first()[0]
        assert largest <= 2 * 20_000 // 16


def test_empty_null_and_infinite_order_values(spark):
    df = spark.range(3000).select("id", F.col("id").cast("double").alias("v"), F.lit("x").alias("k"))
    assert _mismatches(df.where("false"), ["v", "id"], ["k"]) == 0
    assert assign_byte_batch(df.where("false"), "k", ["v"], ["k"]).count() == 0
    for value in ("CAST(NULL AS DOUBLE)", "if(id % 2 = 0, double('inf'), double('-inf'))", "CASE WHEN id % 3 = 0 THEN double('nan') WHEN id % 3 = 1 THEN NULL ELSE v END"):
        assert _mismatches(df.withColumn("v", F.expr(value)), ["v", "id"], ["k"]) == 0


def test_descending_order_needs_the_plain_window(spark):
    df = spark.range(10).select("id", F.lit("x").alias("k"))
    with pytest.raises(ValueError, match="ascending"):
        running_before(df, F.lit(1), [F.desc("id")], ["k"], order_chunk("id", 3))
    assert running_before(df, F.lit(1), [F.desc("id")], ["k"], None, "b").where("b != 9 - id").count() == 0


def _greedy(sizes, most):
    """Batch of every size in order, one after the other."""
    out, batch, held = [], 0, 0
    for n in sizes:
        if held > most:
            batch, held = batch + 1, 0
        out.append(batch)
        held += n
    return out


@pytest.mark.parametrize("most, fan_in", [(10, 3), (1000, 64)])
def test_greedy_rotation_equals_the_chain(spark, monkeypatch, most, fan_in):
    from tidewater.operators import batch

    monkeypatch.setattr(batch, "FAN_IN", fan_in)
    rng = random.Random(most)
    rows = []
    for key, n in (("hot", 1500), ("cold", 40), (None, 90), ("one", 1)):
        for i in range(n):
            # long gaps without a start, events without bytes, one event above the limit
            size = rng.choice([0, 0, 1, 3, 9, 40, most, 30 * most if rng.random() < 0.05 else 2])
            rows.append((key, i, size))
    df = spark.createDataFrame(rows, "k string, i int, size bigint").repartition(5)
    got = {(r.k, r.i): r.batch_id for r in batch.assign_greedy_batch(df, None, "i", "k", most, n_chunks=7, size_col="size").collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        want = _greedy([r[2] for r in mine], most)
        assert [got[(key, r[1])] for r in mine] == want, key


def test_greedy_rotation_of_nothing(spark):
    from tidewater.operators.batch import assign_greedy_batch

    df = spark.createDataFrame([], "k string, i int, p string")
    assert assign_greedy_batch(df, "p", "i", "k").collect() == []
