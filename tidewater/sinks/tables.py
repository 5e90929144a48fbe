"""Table sinks and durable staging (K1, K2, K3, K5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.parse import JSON_TS_OPTIONS, route_label
from tidewater.sources.files import CSV_OPTIONS


#: Folders of a staging area that a run, or a stream's micro-batch, has published: ``<unit>=<owner>``, ``<unit>=<owner>-<n>``.
RUN_UNIT, STREAM_UNIT = "stage_run", "stage_batch"


def append_table(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None,
                 partition_by: Sequence[str] = (), as_table: bool = False) -> None:
    """K1: append ``df`` to a path (``fmt`` data source) or a catalog table."""
    w = df.write.format(fmt).options(**(options or {})).mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


def append_routed(df: DataFrame, target: str, corrupt_col: str = "_corrupt", fmt: str = "parquet") -> None:
    """D1 delivery in one scan: good rows land in ``route=good``, dead-letter
    rows (with their original text) in ``route=dead`` of the same table."""
    df.withColumn("route", route_label(corrupt_col)).write.format(fmt).mode("append").partitionBy(
        "route"
    ).save(target)


def path_name(text: str) -> str:
    """Any text as one safe folder name."""
    return quote(text, safe="")


def publish(df: DataFrame, root: str, name: str, write: Callable[[DataFrame, str], None]) -> bool:
    """Write ``df`` below ``<root>/_pending`` and rename it to ``<root>/<name>`` in one step.

    Readers never see part of it, and once it is there it is left alone: a rerun or a replay returns False."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, pending = (jvm.org.apache.hadoop.fs.Path(f"{root}/{p}") for p in (name, f"_pending/{name}"))
    fs = final.getFileSystem(conf)
    if fs.exists(final):
        return False
    write(df, pending.toString())
    if not fs.exists(pending):
        fs.mkdirs(pending)
    fs.mkdirs(final.getParent())
    if not fs.rename(pending, final):
        raise RuntimeError(f"could not publish {final}")
    return True


#: Batches that share a folder in the programs.
BATCHES_PER_FOLDER = 1_000


def stage_json(df: DataFrame, path: str, batch_cols: Sequence[str] = ("batch_id",),
               cluster: bool = False, run_id: str | None = None, overwrite: bool = False,
               batches_per_folder: int | None = None) -> None:
    """K2: durable mode -- write gzip JSON lines, one folder per batch.

    The output of :func:`assign_byte_batch` is already clustered: its window
    leaves each task holding whole (key, chunk) runs in order, so a batch is
    written by one task, or two at a chunk edge, without another shuffle.
    For input that is not clustered that way pass ``cluster=True`` to
    hash-partition on the batch columns first.  With ``batches_per_folder`` the last batch
    column stays in the rows and that many batches share a folder: the driver commits and lists
    folders, and 100 TB hold millions of batches. Timestamps keep microseconds. With ``run_id`` the stage is written
    once: a rerun of the same run finds it and adds nothing.
    """
    def write(rows: DataFrame, to: str) -> None:
        w = rows.write.mode("overwrite" if run_id or overwrite else "append").option("compression", "gzip").options(**JSON_TS_OPTIONS)
        (w.partitionBy(*folders) if folders else w).json(to)

    folders = list(batch_cols)
    if cluster and folders:
        df = df.repartition(*folders)
    if batches_per_folder and folders:
        df = df.withColumn("batch_group", F.floor(F.col(folders[-1]) / batches_per_folder))
        folders[-1] = "batch_group"
    if run_id is None:
        write(df, path)
    else:
        publish(df, path, f"{RUN_UNIT}={path_name(run_id)}", write)


def stage_csv(df: DataFrame, path: str, line_col: str = "line", partition_by: Sequence[str] = ()) -> None:
    """K3: write lines as single-field CSV rows (no header; quotes doubled;
    leading/trailing blanks kept)."""
    w = df.select(F.col(line_col), *[F.col(c) for c in partition_by]).write.mode("append").options(**CSV_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def deliver_direct(df: DataFrame, target: str, fmt: str = "parquet", checkpoint: str | None = None,
                   options: dict | None = None, run_id: str | None = None):
    """K5: non-durable delivery, no staging.

    Batch DataFrame -> :func:`append_table`, or with ``run_id`` a folder of that run which a rerun
    overwrites.  Streaming DataFrame -> an append-mode ``writeStream`` (exactly-once through the
    file sink's commit log), run to completion with ``availableNow``; returns the finished query. That log belongs to one stream:
    streams and batches that share a target need a ``run_id``, and each micro-batch of theirs overwrites a folder of its own.
    """
    if not df.isStreaming:
        if run_id is None:
            append_table(df, target, fmt, options)
        else:
            df.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{target}/delivery={path_name(run_id)}")
        return None
    if checkpoint is None:
        raise ValueError("a streaming delivery needs a checkpoint location")
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if run_id is None:
        w = w.format(fmt).options(**(options or {})).option("path", target).outputMode("append")
    else:
        place = f"{target}/delivery={path_name(run_id)}+"  # a sign that no run's folder name has
        w = w.foreachBatch(lambda batch, n: batch.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{place}{n}"))
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
