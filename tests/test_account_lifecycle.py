import pytest
from pyspark.sql import functions as F

from tidewater import alert_events, alert_windows, delivery_summary, retain, search_funnel

SF = "/root/testdata/sf0.001"


def test_search_funnel_counts(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    r = search_funnel(ev, F.col("event_type") == "error", 50).first()
    n_err = ev.where("event_type = 'error'").count()
    assert (r.scan_count, r.event_count, r.result_count) == (ev.count(), n_err, min(50, n_err))
    by = search_funnel(ev, F.col("value") > 100, 10, by=["event_type"])
    assert by.count() == ev.select("event_type").distinct().count()


def test_delivery_summary_weighted(spark):
    ledger = spark.createDataFrame(
        [("r", "ok", 5, "2024-01-01 00:00:00"), ("r", "failed", 2, "2024-01-01 00:02:30")],
        "run_id string, status string, rows long, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = delivery_summary(ledger, count_col="rows").first()
    assert (r.sent, r.failed, r.elapsed_seconds, r.elapsed_minutes) == (5, 2, 150, 2.5)


def test_retain_keeps_threshold_row(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2023-12-31 23:59:59",), ("2024-01-01 12:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("ts"))
    kept = sorted(str(r.ts) for r in retain(df, "ts", "2024-01-02 00:00:00", days=1).collect())
    assert kept == ["2024-01-01 00:00:00", "2024-01-01 12:00:00"]
    with_null = df.union(spark.createDataFrame([(None,)], "ts timestamp_ntz"))
    assert retain(with_null, "ts", "2024-01-02 00:00:00", days=1).count() == 3
    from tidewater import expired

    assert expired(with_null, "ts", "2024-01-02 00:00:00", days=1).count() == 1


def test_alert_events_semijoin(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    pred = F.col("event_type") == "error"
    wins = alert_windows(ev, "ts", pred, "1 day", min_count=7)
    firing = {r.window_start for r in wins.collect()}
    got = alert_events(ev, "ts", pred, "1 day", min_count=7)
    days = {r.d for r in got.select(F.date_trunc("day", "ts").alias("d")).distinct().collect()}
    assert days == {w for w in firing}
    assert got.count() == wins.agg(F.sum("n_matches")).first()[0]


def test_retain_pushes_the_threshold_into_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    q = retain(li, "l_shipdate", "2001-11-04 00:00:00", days=365)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(l_shipdate," in plan


def test_sweep_expired_deletes_only_old_files(spark, tmp_path):
    import os
    import time

    from tidewater.operators.lifecycle import expired_files, sweep_expired

    d = tmp_path / "archive"
    d.mkdir()
    old, new = d / "old.json.gz", d / "new.json.gz"
    old.write_bytes(b"x")
    new.write_bytes(b"y")
    two_days_ago = time.time() - 2 * 86400
    os.utime(old, (two_days_ago, two_days_ago))
    assert [r.path.rsplit("/", 1)[-1] for r in expired_files(spark, str(d)).collect()] == ["old.json.gz"]
    assert sweep_expired(spark, str(d)) == 1
    assert not old.exists() and new.exists()


def test_expired_is_the_complement_of_retain(spark):
    from tidewater import expired

    ev = spark.read.parquet(f"{SF}/events.parquet")
    kept = retain(ev, "ts", "2024-01-31 00:00:00", days=3)
    gone = expired(ev, "ts", "2024-01-31 00:00:00", days=3)
    assert kept.count() + gone.count() == ev.count()
    assert kept.join(gone, "event_id").count() == 0


def _slowly(batches):
    import time

    for batch in batches:
        time.sleep(0.2)
        yield batch


def test_progress_rows_grow_to_a_hundred(spark, tmp_path):
    from tidewater.operators.account import SearchProgress

    place = str(tmp_path / "progress")
    with SearchProgress(spark, "r1", place, every=0.05) as progress:
        slow = spark.range(0, 40, 1, 40).mapInArrow(_slowly, "id bigint")
        assert slow.count() == 40
    rows = spark.read.parquet(place).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(len(rows))) and len(rows) > 2
    percent = [r.percent_done for r in rows]
    assert percent == sorted(percent) and percent[-1] == 100.0 and all(p < 100 for p in percent[:-1])
    assert [r.is_done for r in rows] == [False] * (len(rows) - 1) + [True]
    assert rows[-1].done == rows[-1].total >= 40
    with pytest.raises(ZeroDivisionError), SearchProgress(spark, "r2", every=5) as failed:
        1 / 0
    assert [(r.percent_done, r.is_done) for r in failed.rows().collect()] == [(0.0, False)]


def test_sweep_runs_in_tasks(spark, tmp_path, monkeypatch):
    import os
    import time

    from tidewater.operators.lifecycle import sweep_expired
    from tidewater.sources.files import walk_files

    old = time.time() - 3 * 86400
    names = ["a b", "100%", "é#?", "deep/er/x=1"]
    for name in names:
        os.makedirs(f"{tmp_path}/{name}")
        for i in range(300):
            path = f"{tmp_path}/{name}/{i} [1] {{x}}.gz" if i else f"{tmp_path}/{name}/_hidden.gz"
            open(path, "w").close()
            if i % 3 == 0:
                os.utime(path, (old, old))
    assert walk_files(spark, str(tmp_path)).count() == 4 * 299
    assert walk_files(spark, str(tmp_path), "1*.gz").count() == 4 * 111
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "collect", lambda *_: pytest.fail("paths on the driver"))
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda *_: pytest.fail("paths on the driver"))
    monkeypatch.setattr(DataFrame, "first", lambda self: _single(self))
    assert sweep_expired(spark, str(tmp_path)) == 4 * 99
    monkeypatch.undo()
    assert sum(len(files) for _, _, files in os.walk(tmp_path)) == 4 * 201
    assert sweep_expired(spark, str(tmp_path)) == 0 and sweep_expired(spark, str(tmp_path / "none")) == 0


def _single(df):
    rows = df.toArrow().to_pylist()
    assert len(rows) <= 1 and all(len(str(v)) < 30 for r in rows for v in r.values())
    return tuple(rows[0].values()) if rows else None
