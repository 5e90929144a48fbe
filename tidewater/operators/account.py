"""Accounting (A1, A2): one aggregate pass each (partial + final)."""

from __future__ import annotations

import threading
import uuid
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.constants import POLL_SECONDS


def search_funnel(df: DataFrame, predicate: Column, n: int, by: Sequence[str] = ()) -> DataFrame:
    """A1: scanned, matched and returned counts of a ``search ... | head n``.

    One aggregate (no ``observe`` before a filter, which would block Parquet
    pushdown): ``scan_count`` rows read, ``event_count`` rows matching,
    ``result_count`` = min(matching, n).
    """
    matched = F.count_if(predicate)
    aggs = [
        F.count(F.lit(1)).alias("scan_count"),
        matched.alias("event_count"),
        F.least(matched, F.lit(n).cast("long")).alias("result_count"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


class SearchProgress:
    """A1's percent done: what share of a search's tasks has ended, while it runs and when it is done.

    A context manager about the search's actions. Every ``every`` seconds it adds a row ``(run_id, seq, done, total,
    percent_done, is_done, ts)`` from Spark's status tracker; :meth:`rows` gives them as a table, and with ``path`` they are appended there at the
    end. Tasks of a stage count once it has been submitted, so the share could fall when another one
    begins: ``percent_done`` never does, and is 100 only in the last row, ``is_done`` if the search did not fail."""

    SCHEMA = "run_id STRING, seq INT, done BIGINT, total BIGINT, percent_done DOUBLE, is_done BOOLEAN, ts TIMESTAMP"

    def __init__(self, spark: SparkSession, run_id: str, path: str | None = None, every: float = POLL_SECONDS):
        self.spark, self.run_id, self.path, self.every = spark, run_id, path, every
        self._seen: list[tuple] = []
        self._stages: dict[int, tuple[int, int]] = {}
        self._stop = threading.Event()

    def __enter__(self) -> SearchProgress:
        self._tag = f"search-{uuid.uuid4().hex}"
        self.spark.sparkContext.setJobGroup(self._tag, f"search {self.run_id}")
        self._poll = threading.Thread(target=self._watch, daemon=True)
        self._poll.start()
        return self

    def __exit__(self, kind, *_) -> None:
        self._stop.set()
        self._poll.join()
        self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        self._look()
        done, total = self._sums()
        self._add(total if kind is None else done, total, 100.0 if kind is None else self._percent(done, total), kind is None)
        if self.path is not None:
            self.rows().coalesce(1).write.mode("append").parquet(self.path)

    def _watch(self) -> None:
        while not self._stop.wait(self.every):
            self._look()
            done, total = self._sums()
            self._add(done, total, self._percent(done, total), False)

    def _look(self) -> None:
        tracker = self.spark.sparkContext.statusTracker()
        for job in tracker.getJobIdsForGroup(self._tag):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                s = tracker.getStageInfo(stage)
                if s is not None and s.numTasks:
                    self._stages[stage] = (s.numCompletedTasks, s.numTasks)

    def _sums(self) -> tuple[int, int]:
        return sum(d for d, _ in self._stages.values()), sum(t for _, t in self._stages.values())

    def _percent(self, done: int, total: int) -> float:
        share = 99.0 * done / total if total else 0.0
        return max([share, *(r[4] for r in self._seen[-1:])])

    def _add(self, done: int, total: int, percent: float, is_done: bool) -> None:
        self._seen.append((self.run_id, len(self._seen), done, total, percent, is_done, datetime.now(timezone.utc)))

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame(self._seen, self.SCHEMA)


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def delivery_summary(
    ledger: DataFrame,
    run_col: str = "run_id",
    status_col: str = "status",
    ts_col: str = "ts",
    ok_value: str = "ok",
    count_col: str | None = None,
) -> DataFrame:
    """A2: per run, events sent and failed and the elapsed time.

    ``count_col`` weights ledger rows that stand for several events (one row
    per delivered batch); without it each row is one event.
    """
    ok = F.col(status_col) == F.lit(ok_value)
    w = F.col(count_col).cast("long") if count_col else F.lit(1).cast("long")
    elapsed_us = F.max(_micros(F.col(ts_col))) - F.min(_micros(F.col(ts_col)))
    return ledger.groupBy(run_col).agg(
        F.sum(F.when(ok, w).otherwise(F.lit(0).cast("long"))).alias("sent"),
        F.sum(F.when(ok, F.lit(0).cast("long")).otherwise(w)).alias("failed"),
        F.floor(elapsed_us / F.lit(1_000_000)).alias("elapsed_seconds"),
        (F.floor(elapsed_us / F.lit(1_000_000)) / F.lit(60.0)).alias("elapsed_minutes"),
    )
