"""Durable staging of a stream: each micro-batch is rotated into byte-bounded
batches (B1) and written as gzip JSON (K2) into its own folder.

``foreachBatch`` publishes micro-batch ``n`` as ``<staging>/stage_batch=<owner>-<n>`` in one
rename, where the owner belongs to the stream's checkpoint: streams that share a staging folder never meet. A
replay finds the folder and leaves it alone, so a loader that already
took its files (:func:`tidewater.streaming.load.load_staged`) never sees copies of
them under new names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.batch import DEFAULT_MAX_BYTES, assign_byte_batch
from tidewater.operators.parse import JSON_TS_OPTIONS
from tidewater.sinks.tables import BATCHES_PER_FOLDER, STREAM_UNIT, publish, stage_json


def stage_owner(checkpoint: str) -> str:
    """The name of the stream with this checkpoint in a staging folder, the same after every restart."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _stage_batch(staging_dir: str, order_by, partition_by, max_bytes, chunk, n_chunks, owner: str = "stream", prepare: Callable[[DataFrame, int], DataFrame] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        if prepare is not None:
            batch = prepare(batch, batch_id)
        payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]), JSON_TS_OPTIONS)
        batched = assign_byte_batch(
            batch, payload, list(order_by), list(partition_by), max_bytes, chunk=chunk, n_chunks=n_chunks
        )
        publish(batched, staging_dir, f"{STREAM_UNIT}={owner}-{batch_id}", lambda rows, to: stage_json(rows, to, (*partition_by, "batch_id"), overwrite=True, batches_per_folder=BATCHES_PER_FOLDER))

    return write


def stage_stream(
    stream: DataFrame,
    staging_dir: str,
    checkpoint: str,
    order_by: Sequence[str],
    partition_by: Sequence[str],
    max_bytes: int = DEFAULT_MAX_BYTES,
    chunk: Column | str | None = "auto",
    n_chunks: int | None = None,
    every: str | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
):
    """Stage a streaming DataFrame durably.  ``every=None`` stages what is
    available and returns the finished query; else it runs on a
    processing-time trigger and the caller owns the query.  ``prepare`` turns each
    micro-batch (and its number) into the rows to stage; a replay must give the same rows."""
    w = (
        stream.writeStream.foreachBatch(_stage_batch(staging_dir, order_by, partition_by, max_bytes, chunk, n_chunks, stage_owner(checkpoint), prepare))
        .option("checkpointLocation", checkpoint)
    )
    if every is not None:
        return w.trigger(processingTime=every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
