"""Event cleaning.

C1-C5 accept any event schema: top-level columns are the event's keys;
nested values may be structs, maps or arrays at any depth.  Use a MAP column
where the presence of a key must stay visible (C1, C3, C4 alone keep null
values; in a struct, absent and null look the same).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from tidewater.functions.cleaning import (
    C1_DROP_MV,
    C2_DROP_EMPTY,
    C3_DROP_EMPTY_MV,
    C4_DROP_RAW,
    C5_ALL,
    LEVELS,
    CleanRules,
    clean_frame,
    clean_variant,
    json_depth,
)
from tidewater.functions.text import is_blank
from tidewater.session import work_path


def drop_mv_fields(df: DataFrame) -> DataFrame:
    """Drop every key starting ``__mv_`` at any depth; lists keep length."""
    return clean_frame(df, C1_DROP_MV)


def drop_empty_fields(df: DataFrame) -> DataFrame:
    """Drop keys and list elements whose value is null or ``''``."""
    return clean_frame(df, C2_DROP_EMPTY)


def drop_empty_mv_fields(df: DataFrame) -> DataFrame:
    """Drop ``__mv_`` keys when null/``''``; drop null/``''`` list elements."""
    return clean_frame(df, C3_DROP_EMPTY_MV)


def drop_raw_field(df: DataFrame) -> DataFrame:
    """C4: drop key ``_raw`` at any depth; lists keep length."""
    return clean_frame(df, C4_DROP_RAW)


def clean_events(df: DataFrame, enabled: bool | str = True) -> DataFrame:
    """C1, C2, C3, C4 in one traversal when enabled, else identity.

    ``enabled`` accepts the alert option's ``"1"``/``"0"`` form as well.
    """
    if isinstance(enabled, str):
        enabled = enabled == "1"
    return clean_frame(df, C5_ALL) if enabled else df


def clean_json_events(df: DataFrame, event_col: str, rules: CleanRules = C5_ALL, depth: int | None = None,
                      corrupt_col: str | None = None) -> DataFrame:
    """C1-C5 on events without a common schema: ``event_col`` is JSON text or a VARIANT with any keys, nested to any depth.

    Same rules as the typed cleaners (``rules``: C5, or one of C1-C4), so ``[""]`` becomes ``[]`` and ``{"a": ""}`` becomes
    ``{}``; a key with a kept null stays visible. Text comes back as JSON text with sorted keys and without blanks.
    ``depth`` bounds the nesting (a deeper event fails the job, none is cut); by default one aggregate pass over the input
    measures it. Text that is no JSON gives null and, if asked for, its text in ``corrupt_col``; a null event
    stays null. Row-local. One expression takes LEVELS levels; rows of deeper events are written below the shared
    folder, and what is below those levels is cleaned from there, the same number of levels at a time.
    """
    event, is_text = F.col(f"`{event_col}`"), isinstance(df.schema[event_col].dataType, StringType)
    if depth is None:
        text = event if is_text else F.to_json(event)
        depth = df.agg(F.max(json_depth(text)).alias("d")).first()["d"] or 0
    parsed = F.try_parse_json(event) if is_text else event
    if corrupt_col is not None and is_text:
        df = df.withColumn(corrupt_col, F.when(event.isNotNull() & parsed.isNull(), event))
    deeper = uuid.uuid4().hex if depth > LEVELS else None
    value = F.when(parsed.isNotNull(), clean_variant(parsed, rules, min(depth, LEVELS), deeper))
    if deeper is None:
        return df.withColumn(event_col, F.to_json(value) if is_text else value)
    out = df.withColumn(event_col, F.to_json(value))
    while depth > LEVELS:
        depth -= LEVELS
        path = work_path(df.sparkSession, "deep-events")
        out.write.parquet(path)
        out = _clean_below(df.sparkSession.read.schema(out.schema).parquet(path), event_col, rules, min(depth, LEVELS), deeper, depth <= LEVELS)
    return out if is_text else out.withColumn(event_col, F.parse_json(event))


def _clean_below(df: DataFrame, event_col: str, rules: CleanRules, depth: int, mark: str, last: bool) -> DataFrame:
    """Put the cleaned values in place of the strings that hold what nests deeper."""
    event, held = F.col(f"`{event_col}`"), f'"{mark}(?:[^"\\\\]|\\\\.)*+"'

    def cleaned(string: Column) -> Column:
        text = F.substring(F.variant_get(F.parse_json(string), "$", "string"), F.lit(len(mark) + 1), F.length(string))
        return F.to_json(clean_variant(F.parse_json(text), rules, depth, None if last else mark))

    found = F.array_append(F.transform(F.regexp_extract_all(event, F.lit(held), F.lit(0)), cleaned), F.lit(""))
    whole = F.array_join(F.zip_with(F.split(event, held, -1), found, lambda a, b: F.concat(a, b)), "")
    return df.withColumn(event_col, F.when(event.contains(mark), whole).otherwise(event))


def drop_blank_lines(
    df: DataFrame,
    text_col: str,
    line_col: str = "line",
    pos_col: str | None = "line_no",
    sep: str = "\n",
) -> DataFrame:
    """One row per non-blank line of ``text_col``.

    A line is blank when ``line.strip() == ''`` (Python whitespace); kept lines
    are *not* stripped.  ``pos_col`` keeps the line's original 0-based position
    so the text can be re-joined in order.  Runs per row (generator), no shuffle.
    """
    keep = [c for c in df.columns if c != text_col]
    exploded = df.select(
        *keep, F.posexplode(F.split(F.col(text_col), _regex_literal(sep), -1)).alias("_pos", line_col)
    )
    out = exploded.where(~is_blank(F.col(line_col)))
    if pos_col:
        return out.withColumnRenamed("_pos", pos_col)
    return out.drop("_pos")


def _regex_literal(s: str) -> str:
    import re

    return re.escape(s)
