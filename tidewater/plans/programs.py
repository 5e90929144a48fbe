"""The three delivery programs as compositions of operators.

* :func:`backfill`     -- search head -> strip/parse payloads -> typed table -> append
* :func:`alert_action` -- alert events -> clean (optional) -> tag run ->
                          direct append, or durable: byte batches -> gzip JSON
                          staging -> exactly-once load; returns the delivery account
* :func:`run_alert`    -- the events of firing windows handed to the alert action
* :func:`forwarder`    -- raw text files -> non-blank lines -> staged CSV ->
                          exactly-once load

Each is a thin sequence of the public operators; all state (staged files,
checkpoints, ledgers) lives under paths the caller passes, normally below
``spark.checkpoint.dir`` (see :func:`tidewater.session.work_path`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewater.operators.account import delivery_summary
from tidewater.operators.batch import DEFAULT_MAX_BYTES, assign_byte_batch, tag_run
from tidewater.operators.clean import clean_events
from tidewater.operators.lifecycle import alert_events
from tidewater.operators.parse import JSON_TS_OPTIONS, apply_mapping, infer_rows
from tidewater.sinks.tables import BATCHES_PER_FOLDER, RUN_UNIT, STREAM_UNIT, append_table, deliver_direct, path_name, stage_json
from tidewater.sources.search import search_head
from tidewater.streaming.alerts import FiringWindows
from tidewater.streaming.intake import stage_intake
from tidewater.streaming.load import BATCH_COL, DEAD_DIR, committed_rows, load_ledger, load_staged, write_ledger
from tidewater.streaming.stage import stage_owner, stage_stream


def backfill(
    events: DataFrame,
    predicate: Column | None,
    n: int,
    order_by: Sequence[Column | str],
    raw_col: str = "_raw",
    target: str | None = None,
    fmt: str = "parquet",
    cap: int | None = None,
) -> DataFrame:
    """Program A: ``search <predicate> | head n``, parse each ``_raw`` payload
    (stripped), infer one table over all rows, append it to ``target``.
    A missing or malformed payload aborts the job, as in the reference."""
    head = search_head(events, predicate, n, order_by, cap).select(raw_col)
    typed = infer_rows(head, raw_col)
    if target is not None:
        append_table(typed, target, fmt)
    return typed


def _route_dead(events: DataFrame, corrupt_col: str, target: str, run_id: str) -> tuple[DataFrame, int]:
    """The good events, and how many bad ones went to the run's dead-letter folder (a rerun rewrites it)."""
    spark = events.sparkSession
    dead = events.where(F.col(corrupt_col).isNotNull())
    batch = f"run-{path_name(run_id)}"
    place = f"{target}/{DEAD_DIR}/{BATCH_COL}={batch}"
    dead.select(F.col(corrupt_col).alias("record"), F.lit(None).cast("string").alias("file"), F.lit(run_id).alias("run_id")).write.mode(
        "overwrite"
    ).parquet(place)
    n = spark.read.schema("record STRING").parquet(place).count()
    write_ledger(spark, target, batch, run_id, {"failed": n} if n else {"ok": 0})
    return events.where(F.col(corrupt_col).isNull()).drop(corrupt_col), n


def _delivered(spark: SparkSession, place: str, fmt: str, schema: StructType) -> DataFrame:
    """What is there; nothing if a stream had no micro-batch."""
    try:
        return spark.read.schema(schema).format(fmt).load(place)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def alert_action(
    events: DataFrame,
    target: str,
    run_id: str,
    *,
    durable: bool | str = False,
    remove_extra_fields: bool | str = True,
    order_by: Sequence[str] = ("ts",),
    partition_by: Sequence[str] = (),
    max_bytes: int = DEFAULT_MAX_BYTES,
    staging_dir: str | None = None,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    chunk: Column | str | None = "auto",
    n_chunks: int | None = None,
    corrupt_col: str | None = None,
    mapping: Sequence[tuple[str, str | int, str]] | None = None,
    archive_dir: str | None = None,
    select: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Program B: deliver the events of a fired alert; returns the run's account
    ``(run_id, sent, failed, elapsed_seconds, elapsed_minutes)``.

    ``durable`` and ``remove_extra_fields`` accept the alert options'
    ``"1"``/``"0"`` strings.  Durable mode needs ``partition_by`` (the batch
    key), ``staging_dir`` and ``checkpoint``; direct delivery of a streaming
    DataFrame needs ``checkpoint``.  ``corrupt_col`` marks bad events (see
    :func:`tidewater.operators.parse.parse_raw`): they go to the target's dead letters and
    count as failed, the others are delivered.  ``mapping`` projects each event to
    destination columns (a direct delivery's account then has no elapsed time).  ``select`` picks the events to deliver from each micro-batch of a
    stream (:class:`tidewater.streaming.alerts.FiringWindows`).  A rerun of the same run delivers nothing twice, and
    runs may share staging folder, target and checkpoint.
    """
    if isinstance(durable, str):
        durable = durable == "1"
    spark = events.sparkSession
    failed = 0
    if corrupt_col is not None:
        if events.isStreaming:
            raise ValueError("route bad events of a stream with route_failures before the alert action")
        events, failed = _route_dead(events, corrupt_col, target, run_id)
    ev = tag_run(clean_events(events, remove_extra_fields), run_id)
    if select is not None and not (durable and ev.isStreaming):
        raise ValueError("events are selected from the micro-batches of a durable stream")
    if not durable:
        rows = ev
        if mapping is not None:
            payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in ev.columns]), JSON_TS_OPTIONS)
            rows = apply_mapping(ev.select(payload.alias("payload")), mapping, "payload", "json")
        deliver_direct(rows, target, fmt, checkpoint=checkpoint and f"{checkpoint}/{path_name(run_id)}", run_id=run_id)
        sent = _delivered(spark, f"{target}/delivery={path_name(run_id)}" + ("+*" if ev.isStreaming else ""), fmt, rows.schema)
        ts = F.col(order_by[0]) if mapping is None else F.lit(None).cast(ev.schema[order_by[0]].dataType)
        ledger = sent.select(F.lit(run_id).alias("run_id"), F.lit("ok").alias("status"), ts.alias("ts"), F.lit(1).alias("rows"))
        if failed:
            ledger = ledger.unionByName(load_ledger(spark, target).where((F.col("run_id") == run_id) & (F.col("status") == "failed")).select("run_id", "status", F.lit(None).cast(ev.schema[order_by[0]].dataType).alias("ts"), "rows"))
        return delivery_summary(ledger, ts_col="ts", count_col="rows")
    if not (partition_by and staging_dir and checkpoint):
        raise ValueError("durable delivery needs partition_by, staging_dir and checkpoint")
    schema = StructType([*ev.schema.fields, StructField("batch_id", LongType())])
    # The account has a row even if there are no events, and its time starts here.
    write_ledger(spark, target, f"start-{path_name(run_id)}", run_id, {"ok": 0})
    if ev.isStreaming:
        stage = f"{checkpoint}/{path_name(run_id)}/stage"
        rows, prepare = ev, None
        if select is not None:  # before the cleaners remove what it may look at
            rows, prepare = events, lambda batch, n: tag_run(clean_events(select(batch, n), remove_extra_fields), run_id)
        stage_stream(rows, staging_dir, stage, list(order_by), list(partition_by), max_bytes, chunk=chunk, n_chunks=n_chunks, prepare=prepare)
        units = f"{STREAM_UNIT}={stage_owner(stage)}-*"
    else:
        payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in ev.columns]), JSON_TS_OPTIONS)
        batched = assign_byte_batch(
            ev, payload, list(order_by), list(partition_by), max_bytes, chunk=chunk, n_chunks=n_chunks
        )
        stage_json(batched, staging_dir, batch_cols=(*partition_by, "batch_id"), run_id=run_id, batches_per_folder=BATCHES_PER_FOLDER)
        units = f"{RUN_UNIT}={path_name(run_id)}"
    # Only what this run has staged: others may share the folder.
    load_staged(spark, staging_dir, target, schema, fmt=fmt, run_id=run_id, mapping=mapping, archive_dir=archive_dir, units=units)
    return delivery_summary(load_ledger(spark, target).where(F.col("run_id") == F.lit(run_id)), ts_col="ts", count_col="rows")


def run_alert(events: DataFrame, ts_col: str, predicate: Column, target: str, run_id: str, *, every: str = "1 hour",
              min_count: int = 1, watermark: str = "10 minutes", **action) -> DataFrame:
    """L2 -> B: the events of every firing window go to :func:`alert_action`; returns its account.

    Of a stream (durable delivery), every micro-batch hands over what fires with it; events may come
    ``watermark`` late."""
    if not events.isStreaming:
        return alert_action(alert_events(events, ts_col, predicate, every, min_count), target, run_id, **action)
    state = f"{action['checkpoint']}/{path_name(run_id)}/windows"
    firing = FiringWindows(state, ts_col, predicate, every, min_count, watermark)
    return alert_action(events, target, run_id, select=firing.select, **action)


def forwarder(
    spark: SparkSession,
    raw_dir: str,
    staged_dir: str,
    target: str,
    intake_checkpoint: str,
    load_checkpoint: str,
    run_id: str = "forwarder",
    fmt: str = "parquet",
    mapping: Sequence[tuple[str, int, str]] | None = None,
) -> DataFrame:
    """Program C: raw text -> staged single-field CSV (blank lines dropped) ->
    exactly-once load, through a CSV ``mapping`` if there is one.  Returns the committed rows of ``target``."""
    stage_intake(spark, raw_dir, staged_dir, intake_checkpoint)
    load_staged(spark, staged_dir, target, "line STRING", load_checkpoint, kind="csv", fmt=fmt, run_id=run_id, mapping=mapping)
    return committed_rows(spark, target, fmt)
