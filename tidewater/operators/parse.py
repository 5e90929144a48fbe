"""Parsing and projection (T1-T3) and failure routing."""

from __future__ import annotations

import json
import re
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions.text import py_strip
from tidewater.session import work_path

CORRUPT_COL = "_corrupt"

# JSON timestamps are written and read with microseconds; Spark's default
# cuts them to milliseconds.
JSON_TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _schema(schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


def parse_raw(
    df: DataFrame,
    schema: StructType | str,
    raw_col: str = "_raw",
    out_col: str = "parsed",
    mode: str = "permissive",
) -> DataFrame:
    """Strip ``raw_col`` (Python whitespace) and parse it as one JSON object.

    mode
      ``failfast``   any missing or malformed payload fails the job (the
                     reference behaviour);
      ``permissive`` bad payloads give a null ``out_col`` and the original text
                     in ``_corrupt`` (ready for :func:`route_failures`);
      ``deadletter`` the same as ``permissive`` (the name used by the
                     delivery jobs that route bad events to a dead-letter table).
    An empty or missing payload counts as bad.  Duplicate keys: last wins.
    """
    st = _schema(schema)
    text = py_strip(F.col(raw_col))
    if mode == "failfast":
        parsed = F.from_json(text, st, {"mode": "FAILFAST", **JSON_TS_OPTIONS})
        checked = F.when(
            text.isNull() | parsed.isNull(),
            F.raise_error(F.concat(F.lit("unparseable payload in "), F.lit(raw_col))),
        ).otherwise(parsed)
        return df.withColumn(out_col, checked)
    if mode not in ("permissive", "deadletter"):
        raise ValueError(f"unknown mode {mode!r}")
    with_corrupt = StructType(st.fields + [StructField(CORRUPT_COL, StringType(), True)])
    parsed = F.from_json(
        text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, **JSON_TS_OPTIONS}
    )
    tmp = "__tw_parsed"
    out = df.withColumn(tmp, parsed)
    bad = F.col(tmp).isNull() | F.col(f"{tmp}.{CORRUPT_COL}").isNotNull()
    return (
        out.withColumn(CORRUPT_COL, F.when(bad, F.coalesce(F.col(raw_col), F.lit(""))))
        .withColumn(out_col, F.when(~bad, F.col(tmp).dropFields(CORRUPT_COL)))
        .drop(tmp)
    )


def route_failures(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """Split into (good, dead-letter) by the corrupt marker of :func:`parse_raw`.

    Both sides are lazy plans over the same input; to deliver both in one
    scan use :func:`tidewater.sinks.tables.append_routed`.
    """
    good = df.where(F.col(corrupt_col).isNull()).drop(corrupt_col)
    dead = df.where(F.col(corrupt_col).isNotNull())
    return good, dead


def route_label(corrupt_col: str = CORRUPT_COL) -> Column:
    """``'good'`` / ``'dead'`` per row, for one-pass partitioned delivery."""
    return F.when(F.col(corrupt_col).isNull(), F.lit("good")).otherwise(F.lit("dead"))


def infer_rows(df: DataFrame, json_col: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON text -> typed table with a schema inferred over all rows.

    The schema comes from one distributed pass of the JSON reader over the column itself,
    the rows from a second one that parses each payload with it. An input that is only read and filtered is
    read twice and not copied; of one that is computed (a head, a join, an aggregate) the payloads are
    written once below the shared folder, so that it is computed once.
    Fields come out in alphabetical order; int+float widen to double, int+string to string,
    objects become structs. Under ``FAILFAST`` a missing, blank or malformed payload aborts
    the job; ``PERMISSIVE`` gives it a row of nulls, so no row is ever lost.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    # folded like the parser sees it: valid JSON has no raw line ends inside strings
    text = py_strip(F.col(json_col))
    lines = df.select(text.alias("value"))
    if _is_computed(lines):
        place = work_path(spark, "payloads")
        lines.write.parquet(place)
        lines = spark.read.schema(lines.schema).parquet(place)
    present = lines.where("value IS NOT NULL AND value != ''")
    reader = spark._jsparkSession.read().option("mode", "PERMISSIVE" if mode.upper() != "FAILFAST" else mode)
    for k, v in JSON_TS_OPTIONS.items():
        reader = reader.option(k, v)
    strings = getattr(present._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
    schema = StructType.fromJson(json.loads(reader.json(strings).schema().json()))
    corrupt = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    schema = StructType([f for f in schema.fields if f.name != corrupt])
    if not schema.fields:
        bad = lines.where("value IS NULL OR value = ''")
        return bad.select() if mode.upper() != "FAILFAST" else _abort_on(bad)
    parsed = F.from_json("value", schema, {"mode": mode, **JSON_TS_OPTIONS})
    if mode.upper() == "FAILFAST":
        missing = F.raise_error(F.concat(F.lit("missing payload in "), F.lit(json_col)))
        parsed = F.when(F.col("value").isNull() | (F.col("value") == ""), missing).otherwise(parsed)
    return lines.select(parsed.alias("_tw_row")).select("_tw_row.*")


def _is_computed(df: DataFrame) -> bool:
    """Whether the plan does more than read and map rows."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.search(r"^[\s:+-]*(GlobalLimit|LocalLimit|Sort|Aggregate|Join|Window|Distinct|Repartition|RepartitionByExpression|MapInArrow|MapInPandas|FlatMap\w*)\b", plan, re.M) is not None


def _abort_on(rows: DataFrame) -> DataFrame:
    """No rows, or an error where there are some."""
    return rows.select(F.raise_error(F.lit("missing payload")).alias("x")).drop("x")


def apply_mapping(
    df: DataFrame,
    mapping: Sequence[tuple[str, str | int, str]],
    source_col: str,
    kind: str = "json",
    keep: Iterable[str] = (),
    csv_options: dict | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Project a text payload to destination columns by a mapping.

    ``mapping`` is a list of ``(column, path_or_ordinal, type)``:
      kind ``json`` -> path is a JSONPath such as ``$.a`` or ``$.a.b[0]``;
      kind ``csv``  -> ordinal is the 0-based field number.
    Values that do not fit the type become null (``try_cast``), never an error; find malformed
    payloads first with :func:`parse_raw`, or deliver through ``load_staged(mapping=...)``, which routes them.
    ``corrupt_col``: a further column with the text of JSON payloads that are no object, null for the others.

    The payload is parsed once per row: top-level JSON keys come from one
    ``from_json`` into STRING fields (numbers keep their text, objects their
    JSON, exactly as ``get_json_object`` returns them); CSV records from one
    ``from_csv``.  The record is projected in its own step so that the
    optimizer does not clone the parser into every output column.
    """
    keep = list(keep)
    src = F.col(source_col)
    rec = "_tw_rec"
    if kind == "json":
        top = {}
        for _, path, _ in mapping:
            m = _TOP_LEVEL.fullmatch(str(path)) or _BELOW.fullmatch(str(path))
            if m:
                top.setdefault(m.group(1), None)
        marker = "_tw_corrupt"  # no mapping takes a key of this name from the record
        rec_schema = StructType([StructField(k, StringType(), True) for k in (*top, marker)])
        parsed = F.from_json(src, rec_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": marker})
        stage = df.select(*keep, src.alias("_tw_src"), parsed.alias(rec))
        out = []
        if corrupt_col is not None:
            bad = F.col(rec).isNull() | F.col(rec).getField(marker).isNotNull()
            out.append(F.when(bad, F.col("_tw_src")).alias(corrupt_col))
        # NaN and infinities, which the record parser takes: it quotes them, and get_json_object does not read the text
        odd = F.col("_tw_src").rlike(_ODD_NUMBER)
        for name, path, dtype in mapping:
            m = _TOP_LEVEL.fullmatch(str(path))
            if m:
                value = F.col(rec).getField(m.group(1))
                value = F.when(odd & value.rlike(f'^"{_ODD}"$'), F.replace(value, F.lit('"'), F.lit(""))).otherwise(value)
            else:
                value = F.get_json_object(F.col("_tw_src"), str(path))
                below = _BELOW.fullmatch(str(path))
                if below:
                    value = F.when(odd, F.get_json_object(F.col(rec).getField(below.group(1)), f"${below.group(2)}")).otherwise(value)
            out.append(value.try_cast(dtype).alias(name))
    elif kind == "csv":
        width = max(int(o) for _, o, _ in mapping) + 1
        ddl = ", ".join(f"_c{i} STRING" for i in range(width))
        # quotes are escaped by doubling (RFC 4180, as Python's csv module writes)
        opts = {"quote": '"', "escape": '"', **(csv_options or {})}
        stage = df.select(*keep, F.from_csv(src, ddl, opts).alias(rec))
        out = [F.col(rec).getField(f"_c{int(o)}").try_cast(dtype).alias(name) for name, o, dtype in mapping]
    else:
        raise ValueError(f"unknown mapping kind {kind!r}")
    return stage.select(*[F.col(k) for k in keep], *out)


_TOP_LEVEL = re.compile(r"\$\.([A-Za-z_][A-Za-z0-9_]*)")
_BELOW = re.compile(r"\$\.([A-Za-z_][A-Za-z0-9_]*)([.\[].*)")
_ODD = "[+-]?(?:NaN|Infinity|INF)"
_ODD_NUMBER = r"[:,\[]\s*" + _ODD
