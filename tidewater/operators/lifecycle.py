"""Retention (L1) and alert windows (L2, batch form; stream form in
:mod:`tidewater.streaming.alerts`)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.constants import RETENTION_DAYS


def _ts_literal(df: DataFrame, ts_col: str, now) -> Column:
    dtype = df.schema[ts_col].dataType.simpleString()
    value = now.isoformat(sep=" ") if isinstance(now, datetime) else str(now)
    return F.lit(value).cast(dtype)


def retain(df: DataFrame, ts_col: str, now, days: int = RETENTION_DAYS) -> DataFrame:
    """L1: keep rows not older than ``days`` before ``now``.

    The delivery tool deletes strictly older items (``mtime < threshold``), so
    a row exactly at the threshold is kept, and so is a row without a
    timestamp.  On a table partitioned by a date column this is a partition
    filter and prunes whole directories.
    """
    threshold = _ts_literal(df, ts_col, now) - F.expr(f"INTERVAL {int(days)} DAYS")
    # a row without a timestamp cannot be dated, so it is kept, never swept
    return df.where((F.col(ts_col) >= threshold) | F.col(ts_col).isNull())


def expired(df: DataFrame, ts_col: str, now, days: int = RETENTION_DAYS) -> DataFrame:
    """The exact complement of :func:`retain` (what the sweep deletes)."""
    threshold = _ts_literal(df, ts_col, now) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.where(F.col(ts_col) < threshold)


def alert_windows(df: DataFrame, ts_col: str, predicate: Column, every: str = "1 hour",
                  min_count: int = 1) -> DataFrame:
    """L2: tumbling windows of ``every`` in which at least ``min_count`` rows
    match ``predicate`` (a saved search run on an interval fires when it has
    results).  Partial+final aggregate on the window start; no window is ever
    materialised as a group of rows."""
    w = F.window(F.col(ts_col), every)
    return (
        df.where(predicate)
        .groupBy(w.start.alias("window_start"), w.end.alias("window_end"))
        .agg(F.count(F.lit(1)).alias("n_matches"))
        .where(F.col("n_matches") >= F.lit(min_count))
    )


def alert_events(df: DataFrame, ts_col: str, predicate: Column, every: str = "1 hour",
                 min_count: int = 1) -> DataFrame:
    """L2: the matching events of every firing window (the events an alert
    hands to its action).  Semi-join on the window start; with
    ``min_count <= 1`` every dated matching event fires and no join is needed.
    An event without a time is in no window, whatever ``min_count`` is."""
    matched = df.where(predicate)
    if min_count <= 1:
        return matched.where(F.col(ts_col).isNotNull())
    firing = alert_windows(df, ts_col, predicate, every, min_count).select("window_start")
    keyed = matched.withColumn("window_start", F.window(F.col(ts_col), every).start)
    return keyed.join(firing, "window_start", "left_semi").drop("window_start")


def expired_files(spark, path: str, now=None, days: int = RETENTION_DAYS, glob: str = "*") -> DataFrame:
    """L1 on a folder: files under ``path`` last modified strictly before
    ``now - days`` (``now=None`` is the current time).  Tasks list the folders;
    file contents are not read and no path comes to the driver."""
    from tidewater.sources.files import _instant, walk_files

    threshold = _instant(now) - F.expr(f"INTERVAL {int(days)} DAYS")
    return walk_files(spark, path, glob).where(F.col("modificationTime") < threshold)


def sweep_expired(spark, path: str, now=None, days: int = RETENTION_DAYS, glob: str = "*") -> int:
    """L1's sweep: delete the files :func:`expired_files` lists; returns how many.

    Each file is deleted by the task that has its row, and only counts come back, so
    folders of any number of files are swept. A retried task finds files gone and goes on (they
    then count once less)."""
    from tidewater.sources.files import delete_files

    return delete_files(expired_files(spark, path, now, days, glob))


def sweep_dated_folders(spark, path: str, now, days: int = RETENTION_DAYS, date_col: str = "day") -> int:
    """L1's sweep of a table or staging area laid out by day: delete the whole folders
    ``<path>/<date_col>=<yyyy-MM-dd>`` that lie strictly before ``now - days``; returns how many.

    One listing of one level and one delete per expired day, however many files it holds.
    A day counts as old as its last moment, so no row within the retention goes; folders
    without a date are kept."""
    from datetime import date, timedelta

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return 0
    at = now if isinstance(now, datetime) else datetime.fromisoformat(str(now))
    n = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith(f"{date_col}=")):
            continue
        try:
            day = date.fromisoformat(name[len(date_col) + 1 :])
        except ValueError:
            continue
        if datetime.combine(day + timedelta(days=1), datetime.min.time()) <= at.replace(tzinfo=None) - timedelta(days=days):
            n += bool(fs.delete(status.getPath(), True))
    return n
