"""Encoding (T4, T5)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.parse import JSON_TS_OPTIONS


def encode_json(df: DataFrame, cols: Sequence[str] | None = None, out_col: str = "payload",
                keep: Sequence[str] = (), keep_nulls: bool = False) -> DataFrame:
    """T4: event -> one JSON object text per row.

    Null struct fields are omitted (absent and null coincide after cleaning), or with
    ``keep_nulls`` written as ``null``, as events are that have not been cleaned;
    timestamps keep microseconds.  Compare payloads by value, not by text.
    """
    names = list(cols) if cols is not None else [c for c in df.columns if c not in keep]
    options = {**JSON_TS_OPTIONS, "ignoreNullFields": "false" if keep_nulls else "true"}
    body = F.struct(*[F.col(f"`{c}`") for c in names])
    return df.select(*[F.col(k) for k in keep], F.to_json(body, options).alias(out_col))


def encode_csv_line(c: Column | str) -> Column:
    """T5: a line as one CSV field, quoted the way Python's ``csv.writer`` does
    (minimal quoting): quote when the line holds ``"``, ``,``, CR or LF and
    double the inner quotes; a lone empty field is written as ``""``."""
    c = F.col(c) if isinstance(c, str) else c
    needs = c.contains('"') | c.contains(",") | c.contains("\r") | c.contains("\n")
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(needs, quoted).when(c == F.lit(""), F.lit('""')).otherwise(c)
