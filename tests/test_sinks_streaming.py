import os
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from tidewater import (
    append_table,
    clean_events,
    deliver_direct,
    eligible_files,
    list_files,
    load_staged,
    committed_rows,
    read_staged_csv,
    read_staged_json,
    stage_csv,
    stage_json,
)
from tidewater.operators.lifecycle import alert_windows
from tidewater.streaming.alerts import alert_windows_stream
from tidewater.streaming.intake import stage_intake
from tidewater.streaming.load import _write_batch, load_ledger

SF = "/root/testdata/sf0.001"


def _dir():
    return tempfile.mkdtemp(prefix="tw-test-")


TRICKY = ['a,"b"c', '  lead', 'trail  ', '"', '""', "x\ny", "tab\there", "#not a comment", "\\back\\", "ünï ", ","]


def test_stage_csv_roundtrip_is_lossless(spark):
    d = _dir() + "/csv"
    df = spark.createDataFrame([(s,) for s in TRICKY], "line string")
    stage_csv(df, d)
    back = [r.line for r in read_staged_csv(spark, d, "line STRING").collect()]
    assert sorted(back) == sorted(TRICKY)


def test_stage_json_keeps_microseconds(spark):
    d = _dir() + "/json"
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("batch_id", F.lit(0))
    stage_json(ev, d)
    assert any(f.endswith(".json.gz") for _, _, fs in os.walk(d) for f in fs)
    back = read_staged_json(spark, d, ev.schema)
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def _stage_events(spark, d, where="true"):
    ev = spark.read.parquet(f"{SF}/events.parquet").where(where).withColumn("batch_id", F.col("event_id") % 3)
    stage_json(ev, d)
    return spark.read.parquet(f"{SF}/events.parquet").schema


def test_load_staged_exactly_once(spark):
    base = _dir()
    staged, target, ckpt = f"{base}/staged", f"{base}/target", f"{base}/ckpt"
    schema = _stage_events(spark, staged, "event_id < 500")
    load_staged(spark, staged, target, schema, ckpt, run_id="r1")
    assert committed_rows(spark, target).count() == 500
    # a rerun from the same checkpoint adds nothing
    load_staged(spark, staged, target, schema, ckpt, run_id="r1")
    assert committed_rows(spark, target).count() == 500
    # new files are picked up once
    _stage_events(spark, staged, "event_id >= 500")
    load_staged(spark, staged, target, schema, ckpt, run_id="r1")
    rows = committed_rows(spark, target)
    assert rows.count() == 1000 and rows.select("event_id").distinct().count() == 1000
    ledger = load_ledger(spark, target)
    assert ledger.agg(F.sum("rows")).first()[0] == 1000


def test_replayed_micro_batch_is_idempotent(spark):
    target = _dir() + "/t"
    write = _write_batch(target, "parquet", "r1")
    batch = spark.range(10).withColumn("v", F.col("id") * 2)
    write(batch, 0)
    write(batch, 0)  # crash after the append, replay of the same batch id
    assert committed_rows(spark, target).count() == 10


def test_uncommitted_batches_are_invisible(spark):
    target = _dir() + "/t"
    write = _write_batch(target, "parquet", "r1")
    write(spark.range(5), 0)
    # a batch whose data landed but whose ledger row did not
    spark.range(7).write.parquet(f"{target}/load_batch=1")
    assert committed_rows(spark, target).count() == 5


def test_deliver_direct_batch_and_stream(spark):
    base = _dir()
    ev = spark.read.parquet(f"{SF}/events.parquet")
    deliver_direct(ev, f"{base}/batch")
    assert spark.read.parquet(f"{base}/batch").count() == ev.count()
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    deliver_direct(clean_events(stream), f"{base}/stream", checkpoint=f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/stream").count() == ev.count()


def test_append_twice_doubles(spark):
    t = _dir() + "/t"
    df = spark.range(4)
    append_table(df, t)
    append_table(df, t)
    assert spark.read.parquet(t).count() == 8


def test_stream_intake_drops_blank_lines(spark):
    base = _dir()
    raw = f"{base}/raw"
    os.makedirs(raw)
    with open(f"{raw}/a.txt", "w") as f:
        f.write('one\n\n \t\ntwo, "q"\n  three\n　\n')
    stage_intake(spark, raw, f"{base}/staged", f"{base}/ckpt")
    lines = sorted(r.line for r in read_staged_csv(spark, f"{base}/staged", "line STRING").collect())
    assert lines == sorted(["one", 'two, "q"', "  three"])


def test_eligible_files_rule(spark):
    now = datetime(2024, 1, 1, 12, 0, 0)
    files = spark.createDataFrame(
        [
            ("big-new", 6 * 1024 * 1024, datetime(2024, 1, 1, 11, 59, 59)),
            ("small-new", 10, datetime(2024, 1, 1, 11, 59, 55)),
            ("small-settled", 10, datetime(2024, 1, 1, 11, 59, 50)),
            ("future", 10 * 1024 * 1024, datetime(2024, 1, 1, 12, 0, 1)),
        ],
        "path string, length long, modificationTime timestamp",
    )
    got = sorted(r.path for r in eligible_files(files, now).collect())
    assert got == ["big-new", "small-settled"]


def test_list_files_reads_metadata_only(spark):
    d = _dir() + "/json"
    _stage_events(spark, d)
    listing = list_files(spark, d, "*.json.gz")
    assert listing.count() >= 3
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1].split("\n")[0]


def test_alert_windows_stream_matches_batch(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    pred = F.col("event_type") == "error"
    batch = alert_windows(ev, "ts", pred, "1 day", min_count=1)
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    out = alert_windows_stream(stream, "ts", pred, "1 day", "1 hour", min_count=1)
    q = out.writeStream.format("memory").queryName("alerts_t").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("alerts_t").select(F.col("window_start").cast("timestamp_ntz").alias("s"), "n_matches")
    want = batch.select(F.col("window_start").alias("s"), "n_matches")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _files(root, suffix):
    return [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(suffix)]


def test_load_staged_archives_loaded_files(spark):
    base = _dir()
    staged, target, ckpt, archive = f"{base}/staged", f"{base}/target", f"{base}/ckpt", f"{base}/archive"
    schema = _stage_events(spark, staged, "event_id < 300")
    n_first = len(_files(staged, ".json.gz"))
    load_staged(spark, staged, target, schema, ckpt, archive_dir=archive, max_files_per_trigger=1)
    _stage_events(spark, staged, "event_id >= 300")
    load_staged(spark, staged, target, schema, ckpt, archive_dir=archive, max_files_per_trigger=1)
    assert committed_rows(spark, target).count() == 1000
    # archiving lags one micro-batch: files of every earlier batch have moved
    assert len(_files(archive, ".json.gz")) >= n_first
    assert load_ledger(spark, target).count() == len(_files(staged, ".json.gz")) + len(_files(archive, ".json.gz"))


def test_modified_before_skips_fresh_files(spark):
    d = _dir() + "/json"
    _stage_events(spark, d)
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    assert read_staged_json(spark, d, schema, modified_before="2000-01-01T00:00:00").count() == 0
    assert read_staged_json(spark, d, schema, modified_before=datetime(2999, 1, 1)).count() == 1000


def test_new_run_id_is_random():
    from tidewater import new_run_id

    a, b = new_run_id(), new_run_id()
    assert a != b and len(a) == 24


def test_eligible_files_now_is_an_instant(spark):
    from datetime import timezone

    files = spark.createDataFrame([("f", 10, datetime(2024, 1, 1, 11, 0, 0))], "path string, length long, modificationTime timestamp")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        aware = datetime(2024, 1, 1, 11, 0, 30, tzinfo=timezone.utc)
        assert eligible_files(files, aware).count() == 1
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert eligible_files(files, aware).count() == 1
        assert eligible_files(files).count() == 1  # current time
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_crash_between_append_and_commit_replays_exactly_once(spark):
    """A micro-batch dies after its data landed and before its ledger row; the
    restarted stream replays the batch from the checkpoint into the same
    folder, so the rows are there exactly once."""
    import pytest

    from tidewater.streaming import load as loadmod

    base = _dir()
    staged, target, ckpt = f"{base}/staged", f"{base}/target", f"{base}/ckpt"
    schema = _stage_events(spark, staged)
    real = loadmod.write_ledger

    def crashing(*_):
        raise RuntimeError("executor lost before the ledger row")

    loadmod.write_ledger = crashing
    try:
        with pytest.raises(Exception):
            load_staged(spark, staged, target, schema, ckpt)
    finally:
        loadmod.write_ledger = real
    assert spark.read.parquet(target).count() == 1000
    assert not os.path.isdir(f"{target}/_ledger")  # data landed, nothing committed
    load_staged(spark, staged, target, schema, ckpt)
    rows = committed_rows(spark, target)
    assert rows.count() == 1000 and rows.select("event_id").distinct().count() == 1000
    assert spark.read.parquet(target).count() == 1000


def test_negative_control_default_json_timestamps_lose_micros(spark):
    d = _dir()
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    ev.write.option("compression", "gzip").json(f"{d}/naive")  # Spark's default format
    naive = spark.read.schema(ev.schema).json(f"{d}/naive")
    assert ev.exceptAll(naive).count() > 0.9 * ev.count()
    stage_json(ev.withColumn("batch_id", F.lit(0)), f"{d}/ours")
    ours = read_staged_json(spark, f"{d}/ours", ev.schema).select("event_id", "ts")
    assert ev.exceptAll(ours).count() == 0


def test_alert_action_direct_on_a_stream(spark):
    from tidewater.plans.programs import alert_action

    base = _dir()
    ev = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    account = alert_action(stream, f"{base}/t", "r9", durable="0", checkpoint=f"{base}/ckpt").first()
    assert (account.run_id, account.sent, account.failed) == ("r9", ev.count(), 0)


def test_load_staged_on_a_processing_time_trigger(spark):
    base = _dir()
    staged, target, ckpt = f"{base}/staged", f"{base}/target", f"{base}/ckpt"
    schema = _stage_events(spark, staged)
    q = load_staged(spark, staged, target, schema, ckpt, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert committed_rows(spark, target).count() == 1000


def test_alert_action_durable_on_a_stream(spark):
    from tidewater.plans.programs import alert_action

    base = _dir()
    ev = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    account = alert_action(
        stream, f"{base}/t", "r7", durable="1", order_by=("ts", "event_id"), partition_by=("event_type",),
        max_bytes=20_000, staging_dir=f"{base}/staged", checkpoint=f"{base}/ckpt",
    ).first()
    assert (account.run_id, account.sent, account.failed) == ("r7", ev.count(), 0)
    rows = committed_rows(spark, f"{base}/t")
    assert rows.count() == ev.count() and rows.select("event_id").distinct().count() == ev.count()
    assert rows.select("batch_id").distinct().count() > 1  # 20 kB rotation produced several batches


def test_stage_stream_micro_batch_replay_is_idempotent(spark):
    from tidewater.streaming.stage import _stage_batch

    d = _dir() + "/staged"
    ev = spark.read.parquet(f"{SF}/events.parquet")
    write = _stage_batch(d, ["ts", "event_id"], ["event_type"], 20_000, "auto", 8)
    write(ev, 0)
    first = sorted(_files(d, ".json.gz"))
    write(ev, 0)  # the same micro-batch again after a crash
    assert sorted(_files(d, ".json.gz")) != [] and len(_files(d, ".json.gz")) == len(first)
    assert read_staged_json(spark, d, ev.schema).count() == ev.count()
