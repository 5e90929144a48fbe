"""File sources (R3-R6): raw lines and staged CSV / gzip-JSON buffers."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime
from fnmatch import fnmatchcase
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.parse import JSON_TS_OPTIONS
from tidewater.session import Store, work_path

from tidewater.constants import MAX_BUFFER_BYTES, QUIET_SECONDS

DEFAULT_MAX_BYTES = MAX_BUFFER_BYTES   # a buffer this big is complete
DEFAULT_QUIET_SECONDS = QUIET_SECONDS  # else its size must be stable this long

# Options shared by the staged-CSV writer and reader: quotes are escaped by
# doubling (RFC 4180, as Python's csv module writes them), blanks are data.
CSV_OPTIONS = {
    "header": "false",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_raw_lines(spark: SparkSession, path: str, streaming: bool = False,
                   line_sep: str | None = "\n", max_files_per_trigger: int | None = None) -> DataFrame:
    """One row (``value``) per text line of the files under ``path``.

    Lines end at ``\\n`` alone, so a carriage return is part of its line; ``line_sep=None`` also
    ends lines at ``\\r`` and ``\\r\\n``."""
    reader = spark.readStream if streaming else spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def _settled(reader, streaming: bool, modified_before):
    """Batch reads can skip files still being written (``modifiedBefore``);
    streaming file sources track files through their log instead."""
    if modified_before is None:
        return reader
    if streaming:
        raise ValueError("modified_before applies to batch reads only")
    value = modified_before.isoformat(timespec="seconds") if isinstance(modified_before, datetime) else str(modified_before)
    return reader.option("modifiedBefore", value)


def read_staged_csv(spark: SparkSession, path: str, schema: StructType | str = "value STRING",
                    streaming: bool = False, modified_before: datetime | str | None = None,
                    line_sep: str | None = None) -> DataFrame:
    """Staged CSV buffers (``*.csv``, no header, quoted fields may span lines).

    ``line_sep="\\n"`` reads our own buffers (K3) without loss, carriage returns included; the default
    also takes rows that end in ``\\r\\n``, as other programs write them, and folds such ends inside fields."""
    reader = _settled(spark.readStream if streaming else spark.read, streaming, modified_before)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return (
        reader.schema(schema)
        .options(**CSV_OPTIONS)
        .option("multiLine", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )


def read_staged_json(spark: SparkSession, path: str, schema: StructType | str,
                     streaming: bool = False, modified_before: datetime | str | None = None) -> DataFrame:
    """Staged gzip JSON-lines buffers (``*.json.gz``).  Blank lines and
    multi-member gzip files read correctly; timestamps keep microseconds.
    The columns are those of ``schema``, folder columns that it names included.
    ``modified_before`` skips files modified at or after that time (batch)."""
    reader = _settled(spark.readStream if streaming else spark.read, streaming, modified_before)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = reader.schema(fields).options(**JSON_TS_OPTIONS).option("pathGlobFilter", "*.json.gz").json(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in fields.fields])


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File metadata (``path``, ``length``, ``modificationTime``) under ``path``.

    The ``binaryFile`` source only reads file contents when ``content`` is
    selected, so this lists and does not read; Spark holds the file index on the driver.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


#: What a walk finds: a file, or a folder that is still to be listed.
_WALKED = "path STRING, length BIGINT, modificationTime TIMESTAMP, folder BOOLEAN"


def walk_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path``, ``length``, ``modificationTime`` of the files under ``path``, listed by tasks: no path comes to the driver.

    Level by level every folder is one row that some task lists; the levels are written below the shared folder. Names
    that start with ``_`` or ``.`` are left out, as Spark's own readers do. Executors reach the store through
    Arrow's file systems (local and shared folders, HDFS, object stores)."""
    root = Store(spark, path).full(path)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                store, inside = fs.FileSystem.from_uri(_uri(folder))
                found = [i for i in store.get_file_info(fs.FileSelector(inside, allow_not_found=True)) if not i.base_name.startswith(("_", "."))]
                found = [i for i in found if i.type == fs.FileType.Directory or fnmatchcase(i.base_name, glob)]
                # names below the folder as it was given, so that paths read like Spark's
                paths = [f"{folder}/{i.base_name}" for i in found]
                columns = [pa.array(paths, pa.string()), pa.array([i.size or 0 for i in found], pa.int64()), pa.array([i.mtime for i in found], pa.timestamp("us", "UTC")), pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "modificationTime", "folder"])

    level, found = spark.createDataFrame([(root,)], "path STRING"), None
    while True:
        place = work_path(spark, "listing")
        level.repartition(max(1, min(spark.sparkContext.defaultParallelism * 4, 1024)), "path").mapInArrow(listed, _WALKED).write.parquet(place)
        here = spark.read.schema(_WALKED).parquet(place)
        files = here.where(~F.col("folder")).drop("folder")
        found = files if found is None else found.unionAll(files)
        level = here.where("folder").select("path")
        if level.isEmpty():
            return found


def _uri(path: str) -> str:
    """A Hadoop path as the URI that Arrow takes: escaped, and with an authority part."""
    from urllib.parse import quote

    scheme, _, rest = path.partition(":")
    return f"file://{quote(rest if rest.startswith('/') else path)}" if scheme == "file" and not rest.startswith("//") else f"{scheme}:{quote(rest)}"


def delete_files(paths: DataFrame, path_col: str = "path") -> int:
    """Delete these files, each in the task that has its row; only counts come back. A file that has gone meanwhile counts as none."""

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        n = 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inside = fs.FileSystem.from_uri(_uri(path))
                try:
                    store.delete_file(inside)
                    n += 1
                except FileNotFoundError:
                    pass
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return paths.select(path_col).mapInArrow(delete, "n BIGINT").agg(F.sum("n")).first()[0] or 0


def _instant(now: datetime | str | None):
    """``now`` as a TIMESTAMP: None -> current time; an aware datetime -> that
    instant; a naive datetime or text -> read in the session time zone."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, datetime) and now.tzinfo is not None:
        return F.timestamp_micros(F.lit(int(now.timestamp() * 1_000_000)))
    return F.lit(now.isoformat(sep=" ") if isinstance(now, datetime) else str(now)).cast("timestamp")


def is_eligible(
    now: datetime | str | None = None,
    quiet_seconds: int = DEFAULT_QUIET_SECONDS,
    max_bytes: int = DEFAULT_MAX_BYTES,
    length_col: str = "length",
    mtime_col: str = "modificationTime",
):
    """R6 as a Column: modified before ``now`` and either larger than
    ``max_bytes`` or unchanged for ``quiet_seconds``."""
    now_ts = _instant(now)
    mtime = F.col(mtime_col).cast("timestamp")
    settled = mtime <= now_ts - F.expr(f"INTERVAL {int(quiet_seconds)} SECONDS")
    return (mtime < now_ts) & ((F.col(length_col) > F.lit(max_bytes)) | settled)


def eligible_files(
    files: DataFrame,
    now: datetime | str | None = None,
    quiet_seconds: int = DEFAULT_QUIET_SECONDS,
    max_bytes: int = DEFAULT_MAX_BYTES,
    length_col: str = "length",
    mtime_col: str = "modificationTime",
) -> DataFrame:
    """Files that are safe to load: modified before ``now`` and either
    larger than ``max_bytes`` or unchanged for ``quiet_seconds``."""
    return files.where(is_eligible(now, quiet_seconds, max_bytes, length_col, mtime_col))


def unchanged_files(
    before: DataFrame,
    after: DataFrame,
    now: datetime | str | None = None,
    max_bytes: int = DEFAULT_MAX_BYTES,
    path_col: str = "path",
    length_col: str = "length",
    mtime_col: str = "modificationTime",
) -> DataFrame:
    """R6 by two listings of a folder: the files of the later one that are larger than ``max_bytes``, or whose size is the
    same in the earlier one; modified before ``now`` in any case.

    A file that grows is left alone whatever its modification time says, and so is one that has just come. The listings are
    :func:`list_files` some time apart (``QUIET_SECONDS`` in the delivery tool), or a snapshot written in the
    last cycle and a new listing; the join is by path."""
    was = before.select(F.col(path_col).alias("_tw_path"), F.col(length_col).alias("_tw_length"))
    same = (F.col(path_col) == F.col("_tw_path")) & (F.col(length_col) == F.col("_tw_length"))
    young = F.col(mtime_col).cast("timestamp") < _instant(now)
    return after.where(young & (F.col(length_col) > max_bytes)).unionAll(
        after.where(young & (F.col(length_col) <= max_bytes)).join(was, same, "left_semi")
    )


def literal_path(path: str) -> str:
    """``path`` as a reader takes it that would expand patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def unreadable(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Which of these files cannot be read to their end, and why.

    Spark's line reader goes through them in its usual blocks, whatever their size. Sound files take one job; otherwise
    the halves are tested until the damaged ones stand alone."""
    def error(some: Sequence[str]) -> str | None:
        try:
            spark.read.option("lineSep", "\n").schema("value STRING").text([literal_path(p) for p in some]).agg(F.sum(F.length("value"))).collect()
        except Exception as e:  # noqa: BLE001 - any failure counts; a sound file does not fail alone
            causes = [x.strip() for x in str(e).splitlines() if x.startswith("Caused by:") or "Exception" in x]
            return (causes[-1] if causes else str(e))[:300]
        return None

    bad: dict[str, str] = {}
    open_ = [list(paths)]
    while open_:
        some = open_.pop()
        why = error(some) if some else None
        if why and len(some) == 1:
            bad[some[0]] = why
        elif why:
            open_ += [some[: len(some) // 2], some[len(some) // 2 :]]
    return bad


#: Files of one block of the intake.
ADMIT_FILES = 1_000


#: Where an intake keeps its last listing, below the incoming folder.
SNAPSHOT_DIR = "_snapshot"


def _ready(spark: SparkSession, incoming_dir: str, glob: str, now: datetime | str | None, wait_seconds: float) -> DataFrame:
    """The files that can be moved, oldest first: quiet long enough by their time, and of the same size in two listings.

    The earlier listing is the snapshot of the last cycle where there is one, for files that were there; else one taken ``wait_seconds`` ago."""
    place = f"{incoming_dir}/{SNAPSHOT_DIR}"

    def listing() -> DataFrame:
        found = list_files(spark, incoming_dir, glob).where(~F.col("path").contains("/_bad/"))
        return spark.createDataFrame(found.toArrow())  # as it is now; the file index is on the driver too

    before = listing()
    if Store(spark, place).exists(place):
        known = spark.createDataFrame(spark.read.schema(before.schema).parquet(place).toArrow())  # the file is overwritten below
        before = known.unionAll(before.join(known, "path", "left_anti"))
    time.sleep(wait_seconds)
    after = listing()
    ready = unchanged_files(before, eligible_files(after, now), now)
    after.coalesce(1).write.mode("overwrite").parquet(place)
    return ready.orderBy("modificationTime", "path").select("path", "length")


def _admit(spark: SparkSession, files: Iterable[tuple[str, int]], incoming_dir: str, staged_dir: str) -> dict[str, int]:
    """Test and move these files; one whose size is no longer the listed one stays."""
    length = dict(files)
    paths = list(length)
    bad = unreadable(spark, [p for p in paths if p.endswith(".gz")])
    counts, store = {"admitted": 0, "bad": 0}, Store(spark, incoming_dir)
    folders = {status: f"{incoming_dir}/_bad" if status == "bad" else staged_dir for status in counts}
    for folder in folders.values():
        store.fs.mkdirs(store.path(folder))
    for path in paths:
        status = "bad" if path in bad else "admitted"
        if store.fs.getFileStatus(store.path(path)).getLen() == length[path] and store.move(path, f"{folders[status]}/{path.rsplit('/', 1)[1]}"):
            counts[status] += 1
    return counts


def admit_files(spark: SparkSession, incoming_dir: str, staged_dir: str, glob: str = "*", now: datetime | str | None = None,
                max_files: int = ADMIT_FILES, wait_seconds: float = 0) -> dict[str, int]:
    """One block of a load cycle's intake: move the eligible files (R6) of ``incoming_dir`` into ``staged_dir``.

    Files that are still being written stay for a later cycle: those that changed within the quiet time, and those whose
    size differs from the last cycle's listing, or from one taken ``wait_seconds`` before. Truncated or damaged gzip files go to
    ``<incoming_dir>/_bad`` instead, so one of them never holds up the others. Of more than ``max_files``
    eligible files the oldest are moved; the rest wait for the next call (:func:`admit_all` moves all).
    Returns the counts."""
    ready = _ready(spark, incoming_dir, glob, now, wait_seconds).limit(max_files).collect()
    return _admit(spark, [(r.path, r.length) for r in ready], incoming_dir, staged_dir)


def admit_all(spark: SparkSession, incoming_dir: str, staged_dir: str, glob: str = "*", now: datetime | str | None = None,
              max_files: int = ADMIT_FILES, wait_seconds: float = 0) -> dict[str, int]:
    """A load cycle's whole intake: every eligible file, listed once and moved as :func:`admit_files` does,
    ``max_files`` at a time. A file that cannot be moved does not hold up those after it."""
    counts = {"admitted": 0, "bad": 0}
    ready = [(r.path, r.length) for r in _ready(spark, incoming_dir, glob, now, wait_seconds).collect()]  # the file index is on the driver too
    for block in batched(ready, max_files):
        for status, n in _admit(spark, block, incoming_dir, staged_dir).items():
            counts[status] += n
    return counts
