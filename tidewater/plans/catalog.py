"""Registered queries: one per operator of the inventory, each reading the
given tables (or data Spark derives from them) in full.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are scalar and named exactly as in the matching oracle SQL
(:mod:`tidewater.plans.oracle`).  Queries that exercise sinks write into a
fresh folder under the session's checkpoint root and read the result back.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.constants import RETRY_TIMES
from tidewater.functions.text import is_blank
from tidewater.operators.account import SearchProgress, delivery_summary, search_funnel
from tidewater.operators.batch import (
    assign_byte_batch,
    assign_count_batch,
    assign_greedy_batch,
    assign_time_batch,
    tag_run,
)
from tidewater.operators.clean import (
    clean_events,
    clean_json_events,
    drop_blank_lines,
    drop_empty_fields,
    drop_empty_mv_fields,
    drop_mv_fields,
    drop_raw_field,
)
from tidewater.operators.encode import encode_csv_line, encode_json
from tidewater.operators.lifecycle import alert_events, alert_windows, retain
from tidewater.operators.parse import JSON_TS_OPTIONS, apply_mapping, infer_rows, parse_raw, route_label
from tidewater.plans import fixtures as fx
from tidewater.plans.programs import alert_action, backfill, forwarder, run_alert
from tidewater.session import work_path
from tidewater.sinks.tables import BATCHES_PER_FOLDER, append_table, deliver_direct, stage_csv, stage_json
from tidewater.sources.files import (
    is_eligible,
    list_files,
    read_raw_lines,
    read_staged_csv,
    read_staged_json,
    unchanged_files,
)
from tidewater.sources.search import explode_results, search_head
from tidewater.streaming.alerts import alert_windows_stream
from tidewater.streaming.intake import stage_intake
from tidewater.streaming.load import committed_rows, dead_letters, load_staged

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run-0001"


def _is_error():
    return F.col("event_type") == F.lit("error")


def _newest_first():
    return [F.col("ts").desc(), F.col("event_id").desc()]


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


#: Bytes of a staged batch in these queries: small enough that every key has several at sf0.01.
BATCH_BYTES = 16 * 1024
#: Lines of a staged buffer written as text: about what ``MAX_BUFFER_BYTES`` holds.
BUFFER_LINES = 100_000


# --- sources -----------------------------------------------------------------

def q_search_head(spark, sf):
    ev = fx.table(spark, sf, "events")
    return search_head(ev, _is_error(), 50, _newest_first()).select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )


def q_explode_results(spark, sf):
    env = fx.envelopes(spark, sf)
    return explode_results(env, "doc", "event_id BIGINT, _raw STRING", keep=("event_type", "day")).select(
        "event_type", "day", "event_id", "_raw"
    )


def q_read_raw_lines(spark, sf):
    path = work_path(spark, "raw-lines")
    fx.raw_text(spark, sf).select(F.col("raw").alias("value")).write.text(path)
    return read_raw_lines(spark, path).select(F.col("value").alias("line"))


def q_stage_csv(spark, sf):
    """K3 then R4: non-blank lines staged as single-field CSV, read back."""
    path = work_path(spark, "staged-csv")
    lines = fx.quoted_lines(spark, sf).where(~is_blank(F.col("line")))
    stage_csv(lines, path, "line")
    return read_staged_csv(spark, path, "line STRING", line_sep="\n")


def _staged_events(spark, sf, path):
    """C5-cleaned sparse events, rotated into BATCH_BYTES batches per event type, staged as gzip JSON;
    returns the schema of the staged records."""
    ev = clean_events(fx.sparse_events(spark, sf, with_ts=True))
    payload = F.to_json(F.struct(*[F.col(c) for c in ev.columns]), JSON_TS_OPTIONS)
    batched = assign_byte_batch(ev, payload, ["ts", "event_id"], ["event_type"], max_bytes=BATCH_BYTES)
    stage_json(batched, path, batch_cols=("event_type", "batch_id"), batches_per_folder=BATCHES_PER_FOLDER)
    return batched.schema


def _cleaned_view(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more,
        "event_id",
        F.date_format("ts", TS_TEXT).alias("ts"),
        "host",
        "pad",
        F.size("tags").alias("tag_count"),
        F.array_join("tags", "|").alias("tags"),
        F.col("nested.note").alias("note"),
    )


def q_stage_json(spark, sf):
    """K2 then R5: staged gzip JSON read back (timestamps keep microseconds)."""
    path = work_path(spark, "staged-json")
    schema = _staged_events(spark, sf, path)
    return _cleaned_view(read_staged_json(spark, path, schema), "batch_id")


def q_eligible_files(spark, sf):
    """R6 over a listing derived from orders: one file an order, size and time by rule, and a fixed time."""
    return fx.file_listing(spark, sf).select("name", "length", is_eligible(fx.LISTED_AT).alias("eligible"))


# --- parsing -----------------------------------------------------------------

def q_parse_raw(spark, sf):
    parsed = parse_raw(fx.raw_payloads(spark, sf), "k INT", "_raw", mode="permissive")
    return parsed.select("event_id", F.col("parsed.k").alias("k"), F.col("_corrupt").isNotNull().alias("bad"))


def q_route_failures(spark, sf):
    """D1 in one pass: every row labelled good/dead (what ``append_routed`` writes);
    the good rows keep the parsed value, the dead rows their original text."""
    parsed = parse_raw(fx.raw_payloads(spark, sf), "k INT", "_raw", mode="permissive")
    good = F.col("_corrupt").isNull()
    return parsed.select(
        "event_id",
        route_label().alias("route"),
        F.when(good, F.col("parsed.k")).alias("k"),
        F.when(~good, F.col("_corrupt")).alias("raw"),
    )


def q_infer_rows(spark, sf):
    return infer_rows(fx.event_json(spark, sf), "json")


def q_apply_mapping_json(spark, sf):
    mapping = [
        ("id", "$.event_id", "bigint"),
        ("kind", "$.event_type", "string"),
        ("user_key", "$.user_id", "bigint"),
        ("amount", "$.amount", "double"),
        ("code", "$.code", "int"),
    ]
    return apply_mapping(fx.event_json(spark, sf), mapping, "json", kind="json")


def q_apply_mapping_csv(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    line = F.concat_ws(
        ",",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_quantity").cast("string"),
        F.concat(F.lit('"'), F.col("l_returnflag"), F.lit(","), F.col("l_linestatus"), F.lit('"')),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
    )
    mapping = [
        ("orderkey", 0, "bigint"),
        ("linenumber", 1, "int"),
        ("quantity", 2, "double"),
        ("flags", 3, "string"),
        ("shipdate", 4, "date"),
    ]
    out = apply_mapping(li.select(line.alias("line")), mapping, "line", kind="csv")
    return out.withColumn("shipdate", F.date_format("shipdate", "yyyy-MM-dd"))


def q_encode_json(spark, sf):
    """T4 by value: encode the cleaned events, decode with the same schema."""
    ev = clean_events(fx.sparse_events(spark, sf, with_ts=True))
    enc = encode_json(ev)
    dec = enc.select(F.from_json("payload", ev.schema, JSON_TS_OPTIONS).alias("e")).select("e.*")
    return _cleaned_view(dec)


def q_encode_csv_line(spark, sf):
    ql = fx.quoted_lines(spark, sf)
    return ql.select("page_id", "line_no", encode_csv_line("line").alias("field"))


def q_tag_run(spark, sf):
    return tag_run(fx.table(spark, sf, "events"), RUN_ID).select("event_id", "run_id")


# --- cleaning ----------------------------------------------------------------

def _flat(fn):
    def q(spark, sf):
        return fx.flatten_paths(fn(fx.sparse_events_map(spark, sf)), "event_id")

    q.__name__ = f"q_{fn.__name__}"
    return q


def q_clean_events_struct(spark, sf):
    return fx.flatten_paths(clean_events(fx.sparse_events(spark, sf)), "event_id")


def q_drop_blank_lines(spark, sf):
    return drop_blank_lines(fx.raw_text(spark, sf), "raw", "line", "line_no").select("doc_id", "line_no", "line")


# --- batching ----------------------------------------------------------------

def q_assign_byte_batch(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "source", F.octet_length("text").alias("bytes"))
    b = assign_byte_batch(docs, None, "doc_id", "source", max_bytes=256 * 1024, size_col="bytes")
    return b.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("bytes").cast("long").alias("n_bytes"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


def q_assign_count_batch(spark, sf):
    orders = fx.table(spark, sf, "orders")
    b = assign_count_batch(orders, "o_orderkey", "o_orderpriority", n=1000)
    return b.groupBy("o_orderpriority", "batch_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


def q_assign_count_batch_lineitem(spark, sf):
    """B3 at the largest table: two status values share all rows (hot keys)."""
    li = fx.table(spark, sf, "lineitem")
    b = assign_count_batch(li, ["l_shipdate", "l_orderkey", "l_linenumber"], "l_linestatus", n=1000)
    return b.groupBy("l_linestatus", "batch_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.sum("l_orderkey").alias("orderkey_sum"),
    ).withColumn("first_ship", F.date_format("first_ship", "yyyy-MM-dd")).withColumn(
        "last_ship", F.date_format("last_ship", "yyyy-MM-dd")
    )


def q_assign_time_batch(spark, sf):
    ev = fx.table(spark, sf, "events")
    return assign_time_batch(ev, "ts").select("event_id", "batch_name")


# --- accounting / lifecycle --------------------------------------------------

def q_search_funnel(spark, sf):
    return search_funnel(fx.table(spark, sf, "events"), _is_error(), 50)


def q_delivery_summary(spark, sf):
    return delivery_summary(fx.ledger(spark, sf))


def q_retain(spark, sf):
    ev = fx.table(spark, sf, "events")
    return retain(ev, "ts", "2024-01-31 00:00:00", days=1).select("event_id", "user_id", "event_type")


def q_retain_lineitem(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return retain(li, "l_shipdate", "2001-11-04 00:00:00", days=365).select("l_orderkey", "l_linenumber")


def q_alert_windows(spark, sf):
    return _window_view(alert_windows(fx.table(spark, sf, "events"), "ts", _is_error(), "1 hour", min_count=3))


def _window_view(w: DataFrame) -> DataFrame:
    return w.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "n_matches",
    )


def q_alert_events(spark, sf):
    return alert_events(fx.table(spark, sf, "events"), "ts", _is_error(), "1 hour", min_count=3).select(
        "event_id", "user_id"
    )


# --- sinks / streaming -------------------------------------------------------

def q_append_table(spark, sf):
    target = work_path(spark, "append")
    ev = tag_run(fx.table(spark, sf, "events"), RUN_ID)
    append_table(ev.where(F.col("event_type") == "error"), target)
    append_table(ev, target)
    return spark.read.parquet(target).select("event_id", "event_type", "run_id")


def q_deliver_direct(spark, sf):
    """K5 as a stream: the events file -> clean -> append (no staging)."""
    schema = fx.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    target = work_path(spark, "direct")
    deliver_direct(clean_events(tag_run(stream, RUN_ID)), target, checkpoint=work_path(spark, "direct-ckpt"))
    return spark.read.parquet(target).select("event_id", "event_type", "run_id")


def q_load_staged(spark, sf):
    """K2 -> K4: staged gzip JSON loaded exactly once by a stream, read via the ledger."""
    staged = work_path(spark, "staged-json")
    schema = _staged_events(spark, sf, staged)
    target = work_path(spark, "loaded")
    load_staged(spark, staged, target, schema, checkpoint=work_path(spark, "load-ckpt"), run_id=RUN_ID)
    return _cleaned_view(committed_rows(spark, target), "batch_id")


def q_alert_delivery(spark, sf):
    """Alert action, durable mode: clean -> tag run -> stage -> load once ->
    per-run delivery account from the load ledger (A2 over real deliveries)."""
    account = alert_action(
        fx.sparse_events(spark, sf, with_ts=True),
        work_path(spark, "alert-target"),
        RUN_ID,
        durable="1",
        remove_extra_fields="1",
        order_by=("ts", "event_id"),
        partition_by=("event_type",),
        staging_dir=work_path(spark, "alert-staged"),
        checkpoint=work_path(spark, "alert-ckpt"),
        max_bytes=BATCH_BYTES,
    )
    return account.select("run_id", "sent", "failed")


def q_alert_delivery_stream(spark, sf):
    """Alert action, durable mode, on a stream of event files: every micro-batch
    is cleaned, rotated and staged replay-safely, then loaded exactly once."""
    events = spark.readStream.schema(fx.table(spark, sf, "events").schema).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(sf)
    sparse = fx.sparse_from(events, with_ts=True)
    account = alert_action(
        sparse,
        work_path(spark, "alert-stream-target"),
        RUN_ID,
        durable="1",
        remove_extra_fields="1",
        order_by=("ts", "event_id"),
        partition_by=("event_type",),
        staging_dir=work_path(spark, "alert-stream-staged"),
        checkpoint=work_path(spark, "alert-stream-ckpt"),
        max_bytes=BATCH_BYTES,
    )
    return account.select("run_id", "sent", "failed")


def q_alert_direct(spark, sf):
    """Alert action, direct mode (no staging), events cleaned."""
    account = alert_action(
        fx.sparse_events(spark, sf, with_ts=True), work_path(spark, "alert-direct"), RUN_ID, durable="0"
    )
    return account.select("run_id", "sent", "failed")


def _alert_into(spark, events, target, **more):
    return alert_action(
        events, target, RUN_ID, durable="1", order_by=("ts", "event_id"), partition_by=("event_type",), max_bytes=BATCH_BYTES,
        staging_dir=work_path(spark, "alert-staged"), checkpoint=work_path(spark, "alert-ckpt"), **more,
    )


def q_alert_delivered_rows(spark, sf):
    """What durable alerts deliver, row by row with its batch: two runs share the staging folder, the target and the
    checkpoint, each is run twice, and all is delivered once."""
    target, staged, ckpt = (work_path(spark, f"alert-{x}") for x in ("target", "staged", "ckpt"))
    events = fx.sparse_events(spark, sf, with_ts=True)
    for _ in range(2):
        for run, part in ((RUN_ID, F.col("event_id") % 2 == 0), ("run-0002", F.col("event_id") % 2 == 1)):
            alert_action(
                events.where(part), target, run, durable="1", order_by=("ts", "event_id"),
                partition_by=("event_type",), max_bytes=BATCH_BYTES, staging_dir=staged, checkpoint=ckpt,
            )
    return _cleaned_view(committed_rows(spark, target), "batch_id", "run_id")


def q_load_mapped(spark, sf):
    """K4 through a mapping, from a folder with malformed records and a truncated buffer: the good records, the dead
    letters with their text, and the buffer, dead after five tries (its records are those of another buffer). Every
    buffer ends after ``BUFFER_LINES``, as a delivery tool rotates them: one is read by one task, whatever its size."""
    staged, target, ckpt = (work_path(spark, f"mapped-{x}") for x in ("staged", "target", "ckpt"))
    fx.staged_lines(spark, sf).write.partitionBy("event_type").option("maxRecordsPerFile", BUFFER_LINES).option("compression", "gzip").text(f"{staged}-text")
    _publish_buffers(spark, f"{staged}-text", staged)
    mapping = [("id", "$.id", "bigint"), ("kind", "$.sub.kind", "string"), ("user", "$.user", "bigint"), ("value", "$.value", "string")]
    for _ in range(RETRY_TIMES):
        load_staged(spark, staged, target, "id BIGINT", ckpt, run_id=RUN_ID, mapping=mapping)
    good = committed_rows(spark, target).select(F.lit("good").alias("route"), "id", "kind", "user", F.col("value") == "NaN", F.lit(None).cast("string"))
    none = [F.lit(None).cast(t) for t in ("bigint", "string", "bigint", "boolean")]
    dead = dead_letters(spark, target).select(F.when(F.col("record").isNull(), "lost").otherwise("dead"), *none, "record")
    return good.unionAll(dead).toDF("route", "id", "kind", "user", "is_nan", "record")


def _publish_buffers(spark, text_dir, staged):
    """Rename text buffers to staged JSON ones, and add the first half of the largest as a buffer of its own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(conf)
    found = [(f.length, f.path) for f in list_files(spark, text_dir, "*.txt.gz").collect()]
    fs.mkdirs(path(staged))
    for n, (_, name) in enumerate(sorted(found)):
        fs.rename(path(name), path(f"{staged}/{n}.json.gz"))
    length = max(found)[0]
    source, out = fs.open(path(f"{staged}/{len(found) - 1}.json.gz")), fs.create(path(f"{staged}/cut.json.gz"))
    out.write(jvm.org.apache.commons.io.IOUtils.toByteArray(source, length // 2))
    out.close()
    source.close()


def q_load_mapped_csv(spark, sf):
    """K3 then K4 through a CSV mapping: whole texts, line ends and quotes included, as single records."""
    staged, target = work_path(spark, "mapped-csv"), work_path(spark, "mapped-csv-target")
    stage_csv(fx.table(spark, sf, "documents").select(F.col("text").alias("line")), staged)
    load_staged(spark, staged, target, "line STRING", work_path(spark, "mapped-csv-ckpt"), kind="csv", mapping=[("line", 0, "string"), ("more", 1, "string")])
    return committed_rows(spark, target).select("line", "more")


def q_unchanged_files(spark, sf):
    """R6 by two derived listings: large files, and those of equal size in both."""
    after = fx.file_listing(spark, sf)
    found = unchanged_files(fx.earlier_listing(spark, sf), after, fx.LISTED_AT, path_col="name")
    return found.select("name", "length")


def q_clean_json_events(spark, sf):
    """C5 on JSON events without a common schema."""
    return clean_json_events(fx.any_key_events(spark, sf), "event", corrupt_col="bad").select("event_id", "event", F.col("bad").isNotNull().alias("bad"))


def q_assign_greedy_batch(spark, sf):
    """B1 with greedy rotation: a batch ends once it holds more than 64 KiB."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "source", F.octet_length("text").alias("bytes"))
    b = assign_greedy_batch(docs, None, "doc_id", "source", max_bytes=64 * 1024, size_col="bytes")
    return b.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("bytes").cast("long").alias("n_bytes"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


def q_search_progress(spark, sf):
    """A1 with percent done: the funnel of a search, and the last row of its progress."""
    with SearchProgress(spark, RUN_ID, work_path(spark, "progress")) as progress:
        funnel = search_funnel(fx.table(spark, sf, "events"), _is_error(), 50).first()
    last = progress.rows().where("is_done").select("run_id", "percent_done")
    return last.withColumns({name: F.lit(n).cast("bigint") for name, n in funnel.asDict().items()})


def _parsed_events(spark, sf):
    """Events whose payloads have been parsed; bad and empty ones are marked."""
    return parse_raw(fx.sparse_events(spark, sf, with_ts=True).select("event_id", "event_type", "ts", "_raw"), "k INT", "_raw")


def q_alert_failures(spark, sf):
    """D1 in the alert action: events with bad payloads are not delivered and count as failed."""
    account = _alert_into(spark, _parsed_events(spark, sf), work_path(spark, "alert-target"), corrupt_col="_corrupt")
    return account.select("run_id", "sent", "failed")


def q_dead_letters(spark, sf):
    """The dead letters of that delivery, with their original text."""
    target = work_path(spark, "alert-target")
    _alert_into(spark, _parsed_events(spark, sf), target, corrupt_col="_corrupt")
    return dead_letters(spark, target).select("record", "run_id")


def q_alert_program(spark, sf):
    """L2 to the action: the events of firing windows, delivered durably and mapped to destination columns."""
    target = work_path(spark, "alert-target")
    mapping = [("id", "$.event_id", "bigint"), ("host", "$.host", "string"), ("note", "$.nested.note", "string"), ("run", "$.run_id", "string")]
    run_alert(
        fx.sparse_events(spark, sf, with_ts=True), "ts", _is_error(), target, RUN_ID, every="1 hour", min_count=3, durable="1",
        order_by=("ts", "event_id"), partition_by=("event_type",), max_bytes=BATCH_BYTES, mapping=mapping,
        staging_dir=work_path(spark, "alert-staged"), checkpoint=work_path(spark, "alert-ckpt"),
    )
    return committed_rows(spark, target).select("id", "host", "note", "run")


def q_alert_stream_program(spark, sf):
    """L2 to the action on a stream: event files in any order of time, two a micro-batch; windows fire once they have three."""
    source, target = work_path(spark, "alert-source"), work_path(spark, "alert-target")
    events = fx.table(spark, sf, "events")
    events.repartition(7, "event_id").write.parquet(source)  # every file spans all days
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    mapping = [("id", "$.event_id", "bigint"), ("host", "$.host", "string"), ("note", "$.nested.note", "string"), ("run", "$.run_id", "string")]
    run_alert(
        fx.sparse_from(stream, with_ts=True), "ts", _is_error(), target, RUN_ID, every="1 hour", min_count=3, watermark="400 days", durable="1",
        order_by=("ts", "event_id"), partition_by=("event_type",), max_bytes=BATCH_BYTES, mapping=mapping,
        staging_dir=work_path(spark, "alert-staged"), checkpoint=work_path(spark, "alert-ckpt"),
    )
    return committed_rows(spark, target).select("id", "host", "note", "run")


def q_alert_windows_stream(spark, sf):
    """L2 on a stream of event files; every trigger rewrites the table of windows."""
    events = spark.readStream.schema(fx.table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    windows = alert_windows_stream(events, "ts", _is_error(), "1 hour", min_count=3)
    out = work_path(spark, "windows")
    q = (
        windows.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
        .option("checkpointLocation", work_path(spark, "windows-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return _window_view(spark.read.parquet(out))


def q_search_head_large(spark, sf):
    """R1 with a head far beyond one page: 150,000 of the line items taken four times, found by selection."""
    rows = fx.repeated_lines(spark, sf)
    order = [F.col(c).desc() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "copy")]
    head = search_head(rows, F.col("l_quantity") >= 2, 150_000, order, direct_rows=10_000)
    return head.select("l_orderkey", "l_linenumber", "copy")


def q_forwarder(spark, sf):
    """Forwarder end to end: raw text -> intake stream -> staged CSV -> exactly-once load."""
    raw = work_path(spark, "fwd-raw")
    fx.raw_text(spark, sf).select(F.col("raw").alias("value")).write.text(raw)
    rows = forwarder(
        spark, raw, work_path(spark, "fwd-staged"), work_path(spark, "fwd-target"),
        work_path(spark, "fwd-intake-ckpt"), work_path(spark, "fwd-load-ckpt"),
    )
    return rows.select("line")


def q_stream_intake(spark, sf):
    """Forwarder: raw text files -> stream (blank lines dropped) -> staged CSV -> read back."""
    raw = work_path(spark, "intake-raw")
    fx.raw_text(spark, sf).select(F.col("raw").alias("value")).write.text(raw)
    staged = work_path(spark, "intake-csv")
    stage_intake(spark, raw, staged, checkpoint=work_path(spark, "intake-ckpt"))
    return read_staged_csv(spark, staged, "line STRING", line_sep="\n")


def q_backfill(spark, sf):
    """Backfill job: head 50 errors -> strip/parse payloads -> inferred table -> append."""
    js = fx.event_json(spark, sf, keep=("ts", "event_id", "event_type"))
    return backfill(
        js, _is_error(), 50, _newest_first(), raw_col="json", target=work_path(spark, "backfill")
    )


QUERIES: dict[str, Query] = {
    "search_head": q_search_head,
    "explode_results": q_explode_results,
    "read_raw_lines": q_read_raw_lines,
    "stage_csv": q_stage_csv,
    "stage_json": q_stage_json,
    "eligible_files": q_eligible_files,
    "parse_raw": q_parse_raw,
    "route_failures": q_route_failures,
    "infer_rows": q_infer_rows,
    "apply_mapping_json": q_apply_mapping_json,
    "apply_mapping_csv": q_apply_mapping_csv,
    "encode_json": q_encode_json,
    "encode_csv_line": q_encode_csv_line,
    "tag_run": q_tag_run,
    "drop_mv_fields": _flat(drop_mv_fields),
    "drop_empty_fields": _flat(drop_empty_fields),
    "drop_empty_mv_fields": _flat(drop_empty_mv_fields),
    "drop_raw_field": _flat(drop_raw_field),
    "clean_events": _flat(clean_events),
    "clean_events_struct": q_clean_events_struct,
    "drop_blank_lines": q_drop_blank_lines,
    "assign_byte_batch": q_assign_byte_batch,
    "assign_count_batch": q_assign_count_batch,
    "assign_count_batch_lineitem": q_assign_count_batch_lineitem,
    "assign_time_batch": q_assign_time_batch,
    "search_funnel": q_search_funnel,
    "delivery_summary": q_delivery_summary,
    "retain": q_retain,
    "retain_lineitem": q_retain_lineitem,
    "alert_windows": q_alert_windows,
    "alert_events": q_alert_events,
    "append_table": q_append_table,
    "deliver_direct": q_deliver_direct,
    "load_staged": q_load_staged,
    "alert_delivery": q_alert_delivery,
    "alert_delivery_stream": q_alert_delivery_stream,
    "alert_direct": q_alert_direct,
    "alert_delivered_rows": q_alert_delivered_rows,
    "load_mapped": q_load_mapped,
    "load_mapped_csv": q_load_mapped_csv,
    "unchanged_files": q_unchanged_files,
    "clean_json_events": q_clean_json_events,
    "assign_greedy_batch": q_assign_greedy_batch,
    "search_progress": q_search_progress,
    "alert_failures": q_alert_failures,
    "dead_letters": q_dead_letters,
    "alert_program": q_alert_program,
    "alert_stream_program": q_alert_stream_program,
    "alert_windows_stream": q_alert_windows_stream,
    "search_head_large": q_search_head_large,
    "forwarder": q_forwarder,
    "stream_intake": q_stream_intake,
    "backfill": q_backfill,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill slice: head 50 newest errors -> strip+parse payload -> clean."""
    ev = fx.table(spark, sf_dir, "events")
    head = search_head(ev, _is_error(), 50, _newest_first()).select("event_id", "ts", F.col("props").alias("_raw"))
    parsed = parse_raw(head, "k INT", "_raw", mode="failfast")
    return clean_events(parsed.select("event_id", "ts", "_raw", F.col("parsed.k").alias("k"))).select(
        "event_id", "ts", "k"
    )
