"""Delivery across runs, reruns, replays and damaged input."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from tidewater.functions.cleaning import C5_ALL
from tidewater.operators.clean import clean_events
from tidewater.operators.encode import encode_json
from tidewater.operators.lifecycle import alert_events, sweep_dated_folders
from tidewater.operators.parse import infer_rows, parse_raw
from tidewater.plans.programs import alert_action, forwarder
from tidewater.sinks.tables import append_table, stage_csv, stage_json
from tidewater.sources.files import ADMIT_FILES, admit_files, read_raw_lines, read_staged_csv
from tidewater.sources.search import search_head
from tidewater.operators.account import delivery_summary
from tidewater.streaming.load import attempts, committed_rows, dead_letters, load_ledger, load_staged
from tidewater.streaming.stage import _stage_batch


def _events(spark, n=100):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), (F.col("id") % 3).cast("string").alias("event_type"), F.concat(F.lit("note "), F.col("id")).alias("note")
    )


def _act(events, base, run, target="t", **more):
    return alert_action(
        events, f"{base}/{target}", run, durable="1", order_by=("ts", "event_id"), partition_by=("event_type",), max_bytes=800,
        staging_dir=f"{base}/staged-{run}", checkpoint=f"{base}/ckpt-{run}", **more,
    ).first()


def test_two_runs_into_one_target(spark, tmp_path):
    base = str(tmp_path)
    for run in ("a", "b"):
        account = _act(_events(spark), base, run)
        assert (account.run_id, account.sent, account.failed) == (run, 100, 0)
    rows = committed_rows(spark, f"{base}/t")
    assert rows.count() == 200
    assert dict(rows.groupBy("run_id").count().collect()) == {"a": 100, "b": 100}
    assert rows.groupBy("event_type").agg(F.countDistinct("batch_id").alias("n")).where("n < 2").count() == 0


def test_a_rerun_delivers_nothing_twice(spark, tmp_path):
    base = str(tmp_path)
    for _ in range(2):
        account = _act(_events(spark), base, "a/b+c=")
        assert (account.sent, account.failed) == (100, 0)
    assert committed_rows(spark, f"{base}/t").count() == 100
    for _ in range(2):
        direct = alert_action(_events(spark), f"{base}/direct", "r", durable="0").first()
        assert (direct.sent, direct.failed) == (100, 0)
    assert spark.read.parquet(f"{base}/direct").count() == 100


def _stream(spark, base, name, n=100):
    """The events of a run as a stream of files."""
    _events(spark, n).withColumn("note", F.concat(F.lit(f"{name} "), "note")).repartition(3).write.mode("ignore").parquet(f"{base}/source-{name}")
    return spark.readStream.schema(_events(spark, 1).schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/source-{name}")


def _batch(spark, base, name, n=100):
    return _events(spark, n).withColumn("note", F.concat(F.lit(f"{name} "), "note"))


@pytest.mark.parametrize("kinds", [("batch", "batch"), ("stream", "stream"), ("stream", "batch")])
@pytest.mark.parametrize("shared", [False, True])
def test_runs_share_a_staging_folder_and_a_target(spark, tmp_path, kinds, shared):
    base = str(tmp_path)
    make = {"batch": _batch, "stream": _stream}

    def act(i, ckpt):
        return alert_action(
            make[kinds[i]](spark, base, f"r{i}"), f"{base}/t", f"r{i}", durable="1", order_by=("ts", "event_id"), partition_by=("event_type",),
            max_bytes=800, staging_dir=f"{base}/staged", checkpoint=f"{base}/{ckpt}",
        ).first()

    for again in range(1 + shared):  # the second time nothing is new
        for i in (0, 1):
            account = act(i, "ckpt" if shared else f"ckpt-{i}")
            assert (account.run_id, account.sent, account.failed) == (f"r{i}", 100, 0), (again, i)
        rows = committed_rows(spark, f"{base}/t")
        assert rows.count() == 200 and rows.select("note").distinct().count() == 200
        assert dict(rows.groupBy("run_id").count().collect()) == {"r0": 100, "r1": 100}
    # a third load of the whole folder into the same target finds everything claimed; into another one it takes all
    schema = rows.drop("load_batch").schema
    load_staged(spark, f"{base}/staged", f"{base}/t", schema, f"{base}/ckpt-all")
    assert committed_rows(spark, f"{base}/t").count() == 200
    load_staged(spark, f"{base}/staged", f"{base}/other", schema, f"{base}/ckpt-other")
    assert committed_rows(spark, f"{base}/other").count() == 200


def test_a_run_goes_on_with_another_checkpoint(spark, tmp_path, monkeypatch):
    from tidewater.streaming import load as loads

    base, real, calls = str(tmp_path), loads.write_ledger, []

    def crashing(spark, target, batch, *rest):
        calls.append(batch)
        if len(calls) == 1:  # the start of the run is in the ledger, its first micro-batch is not
            raise RuntimeError("lost")
        return real(spark, target, batch, *rest)

    monkeypatch.setattr(loads, "write_ledger", crashing)
    with pytest.raises(Exception):
        _act(_events(spark), base, "a")
    monkeypatch.undo()
    account = alert_action(
        _events(spark), f"{base}/t", "a", durable="1", order_by=("ts", "event_id"), partition_by=("event_type",), max_bytes=800,
        staging_dir=f"{base}/staged-a", checkpoint=f"{base}/another",
    ).first()
    assert (account.sent, account.failed) == (100, 0)
    assert committed_rows(spark, f"{base}/t").count() == 100


def test_a_run_without_events_has_an_account(spark, tmp_path):
    base = str(tmp_path)
    for name, events in (("batch", _events(spark, 0)), ("stream", spark.readStream.schema(_events(spark, 1).schema).parquet(_empty(base)))):
        account = _act(events, base, name)
        assert (account.run_id, account.sent, account.failed) == (name, 0, 0)
        direct = alert_action(events, f"{base}/d-{name}", name, durable="0", checkpoint=f"{base}/c-{name}").collect()
        assert not direct or (direct[0].sent, direct[0].failed) == (0, 0)


def _empty(base):
    os.makedirs(f"{base}/empty", exist_ok=True)
    return f"{base}/empty"


def test_direct_streams_and_batches_share_a_target(spark, tmp_path):
    base = str(tmp_path)
    for i, make in enumerate((_stream, _stream, _batch)):
        account = alert_action(make(spark, base, f"r{i}"), f"{base}/t", f"r{i}", durable="0", checkpoint=f"{base}/ckpt").first()
        assert (account.sent, account.failed) == (100, 0)
    rows = spark.read.parquet(f"{base}/t")
    assert rows.count() == 300 and rows.select("note").distinct().count() == 300


def test_direct_delivery_and_the_forwarder_take_a_mapping(spark, tmp_path):
    base, mapping = str(tmp_path), [("id", "$.event_id", "bigint"), ("said", "$.note", "string"), ("run", "$.run_id", "string")]
    for i, make in enumerate((_batch, _stream)):
        account = alert_action(make(spark, base, f"r{i}"), f"{base}/t", f"r{i}", durable="0", checkpoint=f"{base}/ckpt", mapping=mapping).first()
        assert (account.run_id, account.sent, account.failed) == (f"r{i}", 100, 0)
    rows = spark.read.parquet(f"{base}/t").select("id", "said", "run")
    assert {tuple(r) for r in rows.collect()} == {(e, f"r{i} note {e}", f"r{i}") for e in range(100) for i in (0, 1)}
    os.makedirs(f"{base}/raw")
    with open(f"{base}/raw/a.txt", "w") as f:
        f.write('one, "two"\n \nthree\n')
    out = forwarder(spark, f"{base}/raw", f"{base}/fs", f"{base}/ft", f"{base}/c1", f"{base}/c2", mapping=[("text", 0, "string")])
    assert sorted(r.text for r in out.collect()) == ['one, "two"', "three"]


def test_two_loads_of_one_folder_take_each_file_once(spark, tmp_path):
    base = str(tmp_path)
    for i in range(6):
        _gzip(f"{base}/staged/[{i}] {{x}}.json.gz", f'{{"a": {i}}}\n')
    for ckpt in ("one", "two"):
        load_staged(spark, f"{base}/staged", f"{base}/t", "a INT", f"{base}/{ckpt}", max_files_per_trigger=2)
        assert sorted(r.a for r in committed_rows(spark, f"{base}/t").collect()) == list(range(6))


def test_a_stage_replay_after_the_load(spark, tmp_path):
    base = str(tmp_path)
    events = _events(spark)
    write = _stage_batch(f"{base}/staged", ["ts", "event_id"], ["event_type"], 800, "auto", None)
    for replay in range(2):
        write(events, 0)
        load_staged(spark, f"{base}/staged", f"{base}/t", events.schema, f"{base}/ckpt")
        assert committed_rows(spark, f"{base}/t").count() == 100, replay


def test_bad_events_are_counted_and_kept(spark, tmp_path):
    base = str(tmp_path)
    raw = _events(spark).withColumn("_raw", F.when(F.col("event_id") % 10 == 0, "broken").otherwise('{"k": 1}'))
    parsed = parse_raw(raw, "k INT", "_raw")
    for _ in range(2):
        account = _act(parsed, base, "a", corrupt_col="_corrupt")
        assert (account.sent, account.failed) == (90, 10)
    assert committed_rows(spark, f"{base}/t").count() == 90
    assert [r.record for r in dead_letters(spark, f"{base}/t").collect()] == ["broken"] * 10
    direct = alert_action(parsed, f"{base}/direct", "r", durable="0", corrupt_col="_corrupt").first()
    assert (direct.sent, direct.failed) == (90, 10)


def _gzip(path, text, cut=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = gzip.compress(text.encode())
    with open(path, "wb") as f:
        f.write(data[:cut])
    past = time.time() - 3600
    os.utime(path, (past, past))


def test_malformed_lines_become_dead_letters(spark, tmp_path):
    base = str(tmp_path)
    _gzip(f"{base}/staged/a.json.gz", '{"a": 1, "b": "x"}\nnot json\n{"a": "wrong", "b": "c"}\n\n{"a": 2}\n')
    load_staged(spark, f"{base}/staged", f"{base}/t", "a INT, b STRING", f"{base}/ckpt", run_id="r")
    assert {(r.a, r.b) for r in committed_rows(spark, f"{base}/t").collect()} == {(1, "x"), (2, None)}
    dead = dead_letters(spark, f"{base}/t").collect()
    assert {r.record for r in dead} == {"not json", '{"a": "wrong", "b": "c"}'} and all("a.json.gz" in r.file for r in dead)
    assert dict(load_ledger(spark, f"{base}/t").select("status", "rows").collect()) == {"ok": 2, "failed": 2}


def test_a_damaged_buffer_is_tried_again_then_dead(spark, tmp_path):
    base = str(tmp_path)
    line = '{"a": 1, "b": "' + "".join(chr(97 + i * i % 26) for i in range(4000)) + '"}\n'
    for name, cut in (("good", None), ("cut", 60), ("mended", 60)):
        _gzip(f"{base}/staged/{name}.json.gz", line * 20, cut=cut)

    def load():
        load_staged(spark, f"{base}/staged", f"{base}/t", "a INT, b STRING", f"{base}/ckpt", run_id="r", archive_dir=f"{base}/done")
        state = {os.path.basename(r.file): (r.tries, r.state) for r in attempts(spark, f"{base}/t").collect()}
        return committed_rows(spark, f"{base}/t").count(), state

    assert load() == (20, {"cut.json.gz": (1, "retry"), "mended.json.gz": (1, "retry")})
    _gzip(f"{base}/staged/late.json.gz", line)
    assert load() == (21, {"cut.json.gz": (2, "retry"), "mended.json.gz": (2, "retry")})
    _gzip(f"{base}/staged/mended.json.gz", line * 20)
    assert load() == (41, {"cut.json.gz": (3, "retry"), "mended.json.gz": (3, "loaded")})
    assert load()[1]["cut.json.gz"] == (4, "retry") and dead_letters(spark, f"{base}/t").count() == 0
    assert load() == (41, {"cut.json.gz": (5, "dead"), "mended.json.gz": (3, "loaded")})
    assert load() == (41, {"cut.json.gz": (5, "dead"), "mended.json.gz": (3, "loaded")})
    (dead,) = dead_letters(spark, f"{base}/t").collect()
    assert dead.record is None and dead.file.endswith("cut.json.gz")
    assert delivery_summary(load_ledger(spark, f"{base}/t"), count_col="rows").select("sent", "failed").first()[:] == (41, 1)
    assert sorted(f for f in os.listdir(f"{base}/done") if f.endswith(".gz")) == ["cut.json.gz", "good.json.gz", "late.json.gz", "mended.json.gz"]


def test_a_file_that_stays_damaged_is_not_parsed_again(spark, tmp_path, monkeypatch):
    from tidewater.streaming import load as module

    base, parsed, read = str(tmp_path), [], module.read_records
    monkeypatch.setattr(module, "read_records", lambda spark, files, *rest: parsed.append(sorted(map(os.path.basename, files))) or read(spark, files, *rest))
    line = '{"a": 1, "b": "' + "".join(chr(97 + i * i % 26) for i in range(4000)) + '"}\n'
    for name, cut in (("good", None), ("cut", 60), ("mended", 60)):
        _gzip(f"{base}/staged/{name}.json.gz", line * 20, cut=cut)

    def load():
        parsed.clear()
        load_staged(spark, f"{base}/staged", f"{base}/t", "a INT, b STRING", f"{base}/ckpt", run_id="r")
        return committed_rows(spark, f"{base}/t").count(), list(parsed)

    assert load() == (20, [["cut.json.gz", "good.json.gz", "mended.json.gz"], ["good.json.gz"]])
    assert load() == (20, [[]])
    _gzip(f"{base}/staged/mended.json.gz", line * 20)
    assert load() == (40, [["mended.json.gz"]])


def test_buffers_of_the_mapped_load_are_bounded(spark, tmp_path, monkeypatch):
    from tidewater.plans import catalog

    events = spark.range(0, 1000, 1, 2).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 10 > 0, "click").alias("event_type"), (F.col("id") / 4).alias("value"), F.lit("{}").alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "BUFFER_LINES", 100, raising=False)
    monkeypatch.setattr(catalog, "work_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = catalog.q_load_mapped(spark, str(tmp_path)).collect()
    lines = []
    for name in os.listdir(f"{tmp_path}/mapped-staged"):
        if name.endswith(".gz") and name != "cut.json.gz":
            with gzip.open(f"{tmp_path}/mapped-staged/{name}") as f:
                lines.append(len(f.readlines()))
    assert max(lines) <= 100 and sum(lines) == 1000
    # a null event type leaves the line null, which is no record
    found = lambda route: sorted(r.id if route == "good" else r.record for r in rows if r.route == route)
    known = [i for i in range(1000) if i % 10]
    broken = {i: f"not json {i}" if i % 97 == 0 else f"[{i}]" for i in range(1000) if i % 97 == 0 or i % 89 == 0}
    assert found("good") == [i for i in known if i not in broken] and found("dead") == sorted(broken.values())
    assert [r.record for r in rows if r.route == "lost"] == [None]


def test_mapped_csv_records_stay_whole(spark, tmp_path):
    base = str(tmp_path)
    lines = ["a\nb", "c", 'q"x', "x,y", " z "]
    stage_csv(spark.createDataFrame([(v,) for v in lines], "line STRING"), f"{base}/staged")
    with open(f"{base}/staged/other.csv", "w") as f:
        f.write('1,"two\nlines",3\nshort\n')
    load_staged(spark, f"{base}/staged", f"{base}/t", "x STRING", f"{base}/ckpt", kind="csv", mapping=[("first", 0, "string"), ("second", 1, "string")])
    got = {(r.first, r.second) for r in committed_rows(spark, f"{base}/t").select("first", "second").collect()}
    assert got == {(v, None) for v in lines} | {("1", "two\nlines"), ("short", None)}
    assert dead_letters(spark, f"{base}/t").count() == 0


def test_mapped_json_takes_what_the_parser_takes(spark, tmp_path):
    base = str(tmp_path)
    _gzip(f"{base}/staged/a.json.gz", '{"a": 1, "a": 2}\n{"a": NaN, "b": {"c": [5]}}\n"text"\n{"a": 1\n[{"a": 1}]\n{"b": 7}\n')
    load_staged(spark, f"{base}/staged", f"{base}/t", "a INT", f"{base}/ckpt", mapping=[("a", "$.a", "string"), ("c", "$.b.c[0]", "int")])
    assert {(r.a, r.c) for r in committed_rows(spark, f"{base}/t").collect()} == {("2", None), ("NaN", 5), (None, None)}
    assert {r.record for r in dead_letters(spark, f"{base}/t").collect()} == {'"text"', '{"a": 1', '[{"a": 1}]'}


def test_a_mapping_projects_the_staged_records(spark, tmp_path):
    base = str(tmp_path)
    _gzip(f"{base}/staged/a.json.gz", '{"a": 1, "b": {"c": "x"}}\n[1]\nnot json\n')
    mapping = [("num", "$.a", "int"), ("text", "$.b.c", "string")]
    load_staged(spark, f"{base}/staged", f"{base}/t", "a INT", f"{base}/ckpt", mapping=mapping)
    assert [(r.num, r.text) for r in committed_rows(spark, f"{base}/t").collect()] == [(1, "x")]
    assert {r.record for r in dead_letters(spark, f"{base}/t").collect()} == {"[1]", "not json"}


def test_a_damaged_file_does_not_hold_up_the_others(spark, tmp_path):
    base = str(tmp_path)
    line = '{"a": 1, "b": "' + "".join(chr(97 + i * 7 % 26) for i in range(4000)) + '"}\n'
    _gzip(f"{base}/in/good.json.gz", line)
    _gzip(f"{base}/in/cut.json.gz", line * 50, cut=60)
    with open(f"{base}/in/young.json.gz", "wb") as f:  # still being written
        f.write(b"")
    load_staged(spark, f"{base}/staged", f"{base}/t", "a INT, b STRING", f"{base}/ckpt", incoming_dir=f"{base}/in")
    assert committed_rows(spark, f"{base}/t").count() == 1
    assert "cut.json.gz" in os.listdir(f"{base}/in/_bad")
    assert os.path.exists(f"{base}/in/young.json.gz") and os.path.exists(f"{base}/staged/good.json.gz")
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz") == {"admitted": 0, "bad": 0}


def test_a_growing_file_is_left_alone(spark, tmp_path, monkeypatch):
    from tidewater.sources import files

    base = str(tmp_path)
    for name in ("still", "grows"):
        _gzip(f"{base}/in/{name}.json.gz", '{"a": 1}\n')

    def meanwhile(_):
        _gzip(f"{base}/in/grows.json.gz", '{"a": 1}\n{"a": 22}\n')  # its time says that it is an hour old

    monkeypatch.setattr(files.time, "sleep", meanwhile)
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz", wait_seconds=10) == {"admitted": 1, "bad": 0}
    assert os.listdir(f"{base}/staged") == ["still.json.gz"]
    monkeypatch.setattr(files.time, "sleep", lambda _: None)
    # the last cycle's listing knows the larger size, and now it is the same
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz") == {"admitted": 1, "bad": 0}
    # a file that grows from one cycle to the next
    _gzip(f"{base}/in/more.json.gz", '{"a": 1}\n', cut=5)
    os.utime(f"{base}/in/more.json.gz")
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz") == {"admitted": 0, "bad": 0}
    _gzip(f"{base}/in/more.json.gz", '{"a": 1}\n')
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz") == {"admitted": 0, "bad": 0}
    assert admit_files(spark, f"{base}/in", f"{base}/staged", "*.json.gz") == {"admitted": 1, "bad": 0}


def test_more_finished_files_than_a_block_are_all_loaded(spark, tmp_path):
    base, n = str(tmp_path), ADMIT_FILES + 3
    for i in range(n):
        _gzip(f"{base}/in/{i}.json.gz", f'{{"a": {i}}}\n')
    load_staged(spark, f"{base}/staged", f"{base}/t", "a INT", f"{base}/ckpt", incoming_dir=f"{base}/in")
    assert sorted(r.a for r in committed_rows(spark, f"{base}/t").collect()) == list(range(n))
    assert not [f for f in os.listdir(f"{base}/in") if f.endswith(".gz")]


def test_the_intake_goes_on_in_every_cycle(spark, tmp_path):
    base = str(tmp_path)
    _gzip(f"{base}/in/0.json.gz", '{"a": 0}\n')
    query = load_staged(spark, f"{base}/staged", f"{base}/t", "a INT", f"{base}/ckpt", incoming_dir=f"{base}/in", every="1 second")
    try:
        for i in (1, 2):
            _gzip(f"{base}/in/{i}.json.gz", f'{{"a": {i}}}\n')
            until = time.time() + 60
            while os.path.exists(f"{base}/in/{i}.json.gz") and time.time() < until:
                time.sleep(0.2)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.a for r in committed_rows(spark, f"{base}/t").collect()) == [0, 1, 2]


def test_carriage_returns_survive(spark, tmp_path):
    values = ["a\rb", "a\r\nb", "x\r", 'q"\r', "plain", "\r", "a,b\nc"]
    df = spark.createDataFrame([(v,) for v in values], "line STRING")
    stage_csv(df, f"{tmp_path}/csv")
    assert sorted(r.line for r in read_staged_csv(spark, f"{tmp_path}/csv", "line STRING", line_sep="\n").collect()) == sorted(values)
    df.where("NOT contains(line, '\\n')").write.text(f"{tmp_path}/raw")
    assert sorted(r.value for r in read_raw_lines(spark, f"{tmp_path}/raw").collect()) == sorted(v for v in values if "\n" not in v)


def test_batches_share_folders(spark, tmp_path):
    df = spark.range(50).select(F.lit("k").alias("event_type"), "id", F.floor(F.col("id") / 5).alias("batch_id"))
    stage_json(df, f"{tmp_path}/s", ("event_type", "batch_id"), batches_per_folder=4)
    folders = {d for d, _, files in os.walk(f"{tmp_path}/s") if any(f.endswith(".gz") for f in files)}
    assert len(folders) == 3
    assert spark.read.json(f"{tmp_path}/s").select("batch_id").distinct().count() == 10


def test_reserved_only_structs_can_be_written(spark, tmp_path):
    df = spark.createDataFrame([(1, ("x",), [("y",)])], "id INT, s STRUCT<__mv_a: STRING>, l ARRAY<STRUCT<_raw: STRING>>")
    out = clean_events(df)
    append_table(out, f"{tmp_path}/t")
    row = spark.read.parquet(f"{tmp_path}/t").first()
    assert (row.id, row.s, row.l) == (1, {}, [{}])


def test_variants_are_refused(spark):
    df = spark.range(1).select("id", F.parse_json(F.lit('{"__mv_a": 1}')).alias("v"))
    with pytest.raises(TypeError, match="VARIANT"):
        clean_events(df)
    assert C5_ALL.name == "clean_events"


def test_explicit_nulls_are_kept_without_cleaning(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b STRING")
    assert encode_json(df, keep_nulls=True).first().payload == '{"a":1,"b":null}'
    assert encode_json(df).first().payload == '{"a":1}'


def test_inference_loses_no_row(spark):
    df = spark.createDataFrame([('{"a": 1}',), (None,), ("",), ("  ",), ('{"a": 2.5,\n "b": [1]}',)], "j STRING")
    with pytest.raises(Exception, match="missing payload"):
        infer_rows(df, "j").collect()
    rows = infer_rows(df, "j", mode="PERMISSIVE").collect()
    assert len(rows) == 5 and sorted(r.a for r in rows if r.a is not None) == [1.0, 2.5]


def test_heads_beyond_a_page(spark):
    df = spark.range(1_200_000)
    assert search_head(df, None, 1_200_000, [F.col("id").desc()]).count() == 1_200_000
    head = search_head(df, None, 1_100_000, [F.col("id").desc()], direct_rows=100_000)
    assert head.agg(F.min("id"), F.count("*")).first()[:] == (100_000, 1_100_000)


def test_undated_events_never_fire(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (2, None), (3, "2024-01-01 00:20:00")], "id INT, t STRING").withColumn("ts", F.col("t").cast("timestamp"))
    for least in (1, 2):
        assert sorted(r.id for r in alert_events(df, "ts", F.lit(True), "1 hour", least).collect()) == [1, 3]


def test_dated_folders_are_swept_whole(spark, tmp_path):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    spark.createDataFrame([(i, d) for d in days for i in range(20)], "id INT, day STRING").repartition(5).write.partitionBy("day").parquet(f"{tmp_path}/t")
    assert sweep_dated_folders(spark, f"{tmp_path}/t", "2024-01-03 12:00:00", days=1) == 1
    assert sorted(p for p in os.listdir(f"{tmp_path}/t") if p.startswith("day=")) == ["day=2024-01-02", "day=2024-01-03"]
    assert sweep_dated_folders(spark, f"{tmp_path}/none", "2024-01-03") == 0


def test_a_computed_input_is_inferred_in_one_execution(spark):
    rows = spark.range(0, 400, 1, 8).select(F.col("id"), F.to_json(F.struct("id", F.when(F.col("id") == 7, "x").alias("s"))).alias("j"))
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    head = rows.mapInArrow(counted, "id bigint, j string").orderBy(F.col("id").desc()).limit(395)
    out = infer_rows(head, "j")
    assert out.columns == ["id", "s"] and out.count() == 395 and out.where("s = 'x'").count() == 1
    assert runs.value == 400


def _fired(events, least, every=3600):
    """Matching events of windows that have ``least`` of them."""
    by = {}
    for i, t, hit in events:
        if hit and t is not None:
            by.setdefault(t // every, []).append(i)
    return sorted(i for some in by.values() if len(some) >= least for i in some)


@pytest.mark.parametrize("least", [4])
def test_firing_windows_of_a_stream_equal_the_batch(spark, tmp_path, least):
    import random

    from tidewater.streaming.alerts import FiringWindows

    rng = random.Random(least)
    events = [(i, None if rng.random() < 0.05 else rng.choice([rng.randrange(40 * 3600), 7 * 3600 + rng.randrange(600)]), rng.random() < 0.6) for i in range(300)]
    schema = "id int, t bigint, hit boolean"
    to_ts = lambda df: df.withColumn("ts", F.timestamp_seconds("t"))
    firing = FiringWindows(f"{tmp_path}/state", "ts", F.col("hit"), "1 hour", least, "60 hours")
    got, seen = [], set()
    for n in range(4):
        batch = to_ts(spark.createDataFrame(events[n * 75 : n * 75 + 75], schema))
        first = sorted(r.id for r in firing.select(batch, n).collect())
        assert first == sorted(r.id for r in firing.select(batch, n).collect())  # a replay
        got += first
        seen |= set(first)
        assert sorted(seen) == _fired(events[: n * 75 + 75], least)  # as soon as a window fires
    assert sorted(got) == _fired(events, least)
    plain = alert_events(to_ts(spark.createDataFrame(events, schema)), "ts", F.col("hit"), "1 hour", least)
    assert sorted(r.id for r in plain.collect()) == sorted(got)
    held = spark.read.parquet(f"{tmp_path}/state/held/n=3")
    assert held.groupBy("__tw_window").count().where(f"count >= {least}").count() == 0


def test_closed_windows_leave_no_state(spark, tmp_path):
    from tidewater.streaming.alerts import FiringWindows

    firing = FiringWindows(f"{tmp_path}/s", "ts", F.lit(True), "1 hour", 2, "2 hours")
    give = lambda n, *hours: sorted(r.id for r in firing.select(spark.createDataFrame([(int(h * 10), int(h * 3600)) for h in hours], "id int, t bigint").select("id", F.timestamp_seconds("t").alias("ts")), n).collect())
    assert give(0, 1.5, 5.5) == []
    assert give(1, 5.2, 1.7) == [52, 55]  # 1.7 comes more than two hours after its window ended: too late
    assert give(2, 5.8, 30.1) == [58]
    assert give(3, 30.2) == [301, 302]
    state = spark.read.parquet(f"{tmp_path}/s/windows/n=3").collect()
    assert len(state) == 1 and spark.read.parquet(f"{tmp_path}/s/held/n=3").count() == 0
    assert not os.path.exists(f"{tmp_path}/s/held/n=1")
