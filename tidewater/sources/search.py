"""Search-result sources."""

from __future__ import annotations

import math
import re
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that the one task which merges every task's own head may get.
DIRECT_ROWS = 4_000_000
#: Rows of the sample that narrows a large head down.
SAMPLE_ROWS = 16_384


def search_head(
    df: DataFrame,
    predicate: Column | None,
    n: int,
    order_by: Sequence[Column | str],
    cap: int | None = None,
    direct_rows: int = DIRECT_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``search <predicate> | head n`` -- the first ``n`` matching events in
    ``order_by`` order (newest first in the usual setup); with a ``cap``, as a search
    service's page size (``RESULT_PAGE_CAP``), at most that many.

    Catalyst pushes the predicate into the Parquet scan and plans a
    ``TakeOrderedAndProject``: every task keeps its own top ``k`` rows and one
    task merges them.  That merge holds ``tasks x k`` rows, fine for ``head 50``
    but not for a million rows on thousands of tasks. Where it would hold more than ``direct_rows``, the k-th
    row is first narrowed down by selection (:func:`_narrow`): all rows before a pivot are taken as they are, only
    the rest of the head is merged in one task, and the result is put in order by a distributed sort. The
    answer is the same. Rows tied on every order column are interchangeable, as in any head.
    """
    k = int(n) if cap is None else min(int(n), int(cap))
    out = df.where(predicate) if predicate is not None else df
    keys = _order_keys(df, order_by)
    if keys is None or k * _tasks(out) <= direct_rows:
        return out.orderBy(*order_by).limit(k)
    taken, rest, need = _narrow(out, keys, order_by, k, direct_rows, sample_rows)
    parts = [] if taken is None else [out.where(taken)]
    if need:
        between = out if rest is None else out.where(rest)
        parts.append(between.orderBy(*order_by).limit(need))
    return (parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])).orderBy(*order_by)


class _Key(NamedTuple):
    """An order column: its type, direction and where nulls go."""

    name: str
    type: T.DataType
    descending: bool
    nulls_first: bool


_PLAIN = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _order_keys(df: DataFrame, order_by: Sequence[Column | str]) -> list[_Key] | None:
    """The order as plain columns, or None if it has expressions."""
    keys = []
    for o in order_by:
        found = re.fullmatch(r"Column<'(\w+)(?: (ASC|DESC))?(?: NULLS (FIRST|LAST))?'>", str(o)) if not isinstance(o, str) else re.fullmatch(r"(\w+)()()", o)
        if not found or found[1] not in df.columns or not isinstance(df.schema[found[1]].dataType, _PLAIN):
            return None
        descending = found[2] == "DESC"
        keys.append(_Key(found[1], df.schema[found[1]].dataType, descending, found[3] == "FIRST" if found[3] else not descending))
    return keys


def _tasks(df: DataFrame) -> int:
    """About how many tasks read the input, by the planner's size estimate."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, size // (128 * 1024 * 1024)) if size < 1 << 60 else 1_000  # the planner may have no estimate


def _value(key: _Key) -> Column:
    """What of an order value goes to the driver: instants as numbers, free of any time zone."""
    return F.unix_micros(F.col(key.name)) if isinstance(key.type, T.TimestampType) else F.col(key.name)


def _literal(key: _Key, value) -> Column:
    if isinstance(key.type, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(key.type, (T.TimestampNTZType, T.DateType)):
        return F.lit(value.isoformat()).cast(key.type)
    if isinstance(key.type, T.DecimalType):
        return F.lit(str(value)).cast(key.type)
    return F.lit(value)


def _up_to(keys: Sequence[_Key], pivot: Sequence) -> Column:
    """Rows that are not after ``pivot`` in the order. Never null."""
    whole = F.lit(True)
    for key, value in reversed(list(zip(keys, pivot))):
        c = F.col(key.name)
        if value is None:
            before, same = F.lit(False) if key.nulls_first else c.isNotNull(), c.isNull()
        else:
            p = _literal(key, value)
            before = F.coalesce(c > p if key.descending else c < p, F.lit(key.nulls_first))
            same = F.coalesce(c == p, F.lit(False))
        whole = before | (same & whole)
    return whole


def _narrow(df: DataFrame, keys: list[_Key], order_by, k: int, direct_rows: int, sample_rows: int) -> tuple[Column | None, Column | None, int]:
    """Selection of the k-th row: (condition of rows that are in the head for sure, condition of those that the rest of
    the head is among, how many rows that rest has).

    In each round a uniform sample of the remaining rows, at most ``sample_rows``, gives two pivots about the k-th row's
    expected place; exact counts up to both (one aggregate pass) tell which part the k-th row is in. Two
    rounds take a table to a few rows in a thousand, whatever the values look like; ties go by the next order columns.
    """
    taken = rest = None
    need, n = k, df.count()
    while True:
        if n <= need:  # all that remains
            return (rest if taken is None else taken | rest) if rest is not None else F.lit(True), rest, 0
        tasks = max(1, n // 1_000_000)  # a task's rows at most, about, that are still in the running
        if n <= direct_rows or need * tasks <= direct_rows // 8:
            return taken, rest, need
        left = df if rest is None else df.where(rest)
        sample = left.select(*[F.col(key.name) for key in keys]).orderBy(F.rand(17)).limit(sample_rows).orderBy(*order_by)
        pivots = [tuple(r) for r in sample.select(*[_value(key) for key in keys]).collect()]
        at, margin = len(pivots) * need / n, 3 * math.sqrt(len(pivots))
        low, high = int(at - margin) - 1, min(len(pivots) - 1, int(at + margin) + 1)
        lower = _up_to(keys, pivots[low]) if low >= 0 else None
        upper = _up_to(keys, pivots[high])
        below, upto = left.agg(F.count_if(lower if lower is not None else F.lit(False)), F.count_if(upper)).first()
        and_ = lambda c: c if rest is None else rest & c
        or_ = lambda c: and_(c) if taken is None else taken | and_(c)
        before = n
        if below > need:
            rest, n = and_(lower), below
        elif upto >= need:
            if below:
                taken, need = or_(lower), need - below
            rest, n = and_(upper if lower is None or not below else upper & ~lower), upto - below
        else:
            taken, need = or_(upper), need - upto
            rest, n = and_(~upper), n - upto
        if not need:
            return taken, rest, 0
        if n == before:  # rows that no order column tells apart
            return taken, rest, need


def explode_results(
    df: DataFrame,
    doc_col: str,
    result_schema: T.StructType | str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """R2: open a ``{"results": [...]}`` envelope, one row per result.

    A document without a ``results`` array is an error (the job fails), as in
    the backfill job.  Row-local: a generator, no shuffle; each document is
    parsed inside one task, so a document is bounded by the search service's
    result page.
    """
    rs = result_schema if isinstance(result_schema, T.StructType) else T.StructType.fromDDL(result_schema)
    env = T.StructType([T.StructField("results", T.ArrayType(rs), True)])
    parsed = F.from_json(F.col(doc_col), env).getField("results")
    checked = F.when(
        parsed.isNull(), F.raise_error(F.lit("search result envelope without a 'results' array"))
    ).otherwise(parsed)
    return df.select(*[F.col(k) for k in keep], F.explode(checked).alias("_tw_r")).select(
        *[F.col(k) for k in keep], "_tw_r.*"
    )
