"""L2 on a stream: alert windows with a watermark, and the events of firing windows.

The events of a window are needed once it fires, so those that came before must be held. A window's state is its count
and fewer than ``min_count`` events, as later ones of a firing window pass straight through. The state is kept in
tables, not in a keyed state store: counts are combined per task and events go by a join with the few firing windows,
so a window that holds a third of all events does not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.batch import duration_micros, epoch_value


def alert_windows_stream(stream: DataFrame, ts_col: str, predicate: Column, every: str = "1 hour",
                         watermark: str = "10 minutes", min_count: int = 1) -> DataFrame:
    """Streaming form of :func:`tidewater.operators.lifecycle.alert_windows`.

    ``withWatermark`` needs a session-zone TIMESTAMP, so a TIMESTAMP_NTZ column
    is cast first.  Run in ``update`` or ``complete`` mode to see open windows;
    ``append`` mode emits a window only once the watermark passes its end.
    """
    ts = "_tw_ts"
    w = F.window(F.col(ts), every)
    return (
        stream.where(predicate)
        .withColumn(ts, F.col(ts_col).cast("timestamp"))
        .withWatermark(ts, watermark)
        .groupBy(w.alias("window"))
        .agg(F.count(F.lit(1)).alias("n_matches"))
        .where(F.col("n_matches") >= F.lit(min_count))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "n_matches",
        )
    )


class FiringWindows:
    """The matching events of firing windows, micro-batch by micro-batch (for ``foreachBatch``).

    ``select(batch, n)`` gives those events of the stream up to micro-batch ``n`` that are to be handed over now: the
    batch's own events in firing windows, and the held ones of windows that fire with this batch. Over all micro-batches that
    is :func:`tidewater.operators.lifecycle.alert_events` of everything that came, in whatever order. Events without a time never fire.
    An event may come ``watermark`` late, measured from the newest event of the batches before; a window that ended before
    that is closed: its state goes, and later events of it are dropped, as in any watermarked stream.

    State ``n`` lies below ``state_dir`` and is made from state ``n - 1`` and the batch alone, so a replay writes
    the same again; older ones are overwritten by nobody and removed two batches later.
    """

    def __init__(self, state_dir: str, ts_col: str, predicate: Column, every: str = "1 hour", min_count: int = 1, watermark: str = "10 minutes"):
        self.state_dir, self.ts_col, self.predicate, self.min_count = state_dir, ts_col, predicate, min_count
        self.every, self.delay = duration_micros(every), duration_micros(watermark)

    def _path(self, table: str, n: int) -> str:
        return f"{self.state_dir}/{table}/n={n}"

    def _write(self, df: DataFrame, table: str, n: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(table, n))
        return df.sparkSession.read.schema(df.schema).parquet(self._path(table, n))

    def _read(self, like: DataFrame, table: str, n: int) -> DataFrame:
        spark = like.sparkSession
        if n < 0:
            return spark.createDataFrame([], like.schema)
        return spark.read.schema(like.schema).parquet(self._path(table, n))

    def select(self, batch: DataFrame, n: int) -> DataFrame:
        spark, columns = batch.sparkSession, batch.columns
        at = epoch_value(F.col(self.ts_col), batch.schema[self.ts_col].dataType).cast("bigint")
        window = F.floor(at / F.lit(self.every)).cast("bigint") * F.lit(self.every)
        # One reading of the batch: only its matching events go on.
        came = batch.where(self.predicate & F.col(self.ts_col).isNotNull()).withColumns({"__tw_at": at, "__tw_window": window})
        came = self._write(came, "came", n)
        count = came.groupBy("__tw_window").agg(F.count("*").alias("n"), F.max("__tw_at").alias("newest"))
        before = self._read(count, "windows", n - 1)
        newest = before.agg(F.max("newest")).first()[0]
        closed = F.lit(False) if newest is None else F.col("__tw_window") + self.every <= F.lit(newest - self.delay)
        total = before.unionAll(count.where(~closed)).groupBy("__tw_window").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"))
        windows = self._write(total, "windows-now", n)
        firing = windows.where(F.col("n") >= self.min_count).select("__tw_window")
        events = came.where(~closed).unionByName(self._read(came, "held", n - 1))
        # What the next batch needs: the newest time (on any row) and windows that are still open.
        last = windows.agg(F.max("newest")).first()[0]
        ended = F.lit(False) if last is None else F.col("__tw_window") + self.every <= F.lit(last - self.delay)
        self._write(windows.where(~ended | (F.col("newest") == F.lit(last))), "windows", n)
        self._write(events.join(firing, "__tw_window", "left_anti").where(~ended).select(came.columns), "held", n)
        for table in ("came", "windows-now", "windows", "held"):
            self._remove(spark, self._path(table, n - 2))
        return events.join(firing, "__tw_window", "left_semi").select(columns)

    @staticmethod
    def _remove(spark, path: str) -> None:
        sc = spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
