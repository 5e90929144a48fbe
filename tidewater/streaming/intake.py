"""Forwarder intake as a stream: raw text lines -> non-blank lines -> staged CSV.

The listener's data side is a text file source; each row is a line, so
dropping blank lines is a filter.  The file sink commits through its log,
which makes the hand-off to :func:`tidewater.streaming.load.load_staged`
safe without file locks or settle times.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import is_blank
from tidewater.sources.files import CSV_OPTIONS, read_raw_lines


def stage_intake(spark: SparkSession, raw_dir: str, staged_dir: str, checkpoint: str,
                 every: str | None = None, max_files_per_trigger: int | None = None):
    """Run the intake stream.  ``every=None`` processes what is there and stops
    (``availableNow``); else it triggers every ``every`` (the forwarder's
    intake wait is ``tidewater.constants.INTAKE_WAIT``)
    and the caller owns the returned query."""
    lines = read_raw_lines(spark, raw_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)
    kept = lines.where(~is_blank(F.col("value"))).select(F.col("value").alias("line"))
    w = (
        kept.writeStream.format("csv")
        .options(**CSV_OPTIONS)
        .option("path", staged_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if every is None:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:
        q = w.trigger(processingTime=every).start()
    return q
