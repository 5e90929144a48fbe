"""Derived inputs, built from the given tables by deterministic rules on the
key (the same rules appear in the DuckDB oracle, see ``oracle.py``).

The plain tables hold no empty fields, reserved keys, blank lines or bad
payloads, so these derivations add them; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

PATH_VALUE = "array<struct<path:string,value:string>>"


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table (lazy).  The resolved relation is reused per session so
    that repeated queries do not list files and read footers again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def _id(c: str = "event_id") -> Column:
    return F.col(c)


def sparse_columns() -> dict[str, Column]:
    i = _id()
    et = F.col("event_type")
    return {
        "host": F.when(i % 7 == 0, F.lit("")).when(i % 11 == 0, F.lit(None).cast("string")).otherwise(et),
        "pad": F.when(i % 5 == 0, F.lit(" ")).otherwise(F.lit("0")),
        "__mv_user": F.when(i % 3 == 0, F.lit("")).when(i % 3 == 1, F.lit(None).cast("string")).otherwise(
            F.lit("$a$;$b$")
        ),
        "_raw": F.when(i % 97 == 0, F.lit("not json"))
        .when(i % 89 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("\t "), F.col("props"), F.lit("\n"))),
    }


def sparse_tags() -> Column:
    return F.array(F.lit("a"), F.lit(""), F.lit(None).cast("string"), F.col("event_type"))


def sparse_nested() -> Column:
    i = _id()
    return F.struct(
        F.lit("").alias("__mv_x"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.col("event_type")).alias("note"),
        F.lit("r").alias("_raw"),
    )


def sparse_from(ev: DataFrame, with_ts: bool = False) -> DataFrame:
    """The struct-form derivation applied to an events DataFrame (batch or stream)."""
    cols = [F.col("event_id"), F.col("event_type")]
    if with_ts:
        cols.append(F.col("ts"))
    cols += [c.alias(n) for n, c in sparse_columns().items()]
    return ev.select(*cols, sparse_tags().alias("tags"), sparse_nested().alias("nested"))


def sparse_events(spark: SparkSession, sf_dir: str, with_ts: bool = False) -> DataFrame:
    """Struct form: the flat fields are top-level columns."""
    return sparse_from(table(spark, sf_dir, "events"), with_ts)


def sparse_events_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map form: the flat fields go into ``attrs`` so key presence stays visible."""
    ev = table(spark, sf_dir, "events")
    kv = []
    for n, c in sparse_columns().items():
        kv += [F.lit(n), c]
    return ev.select("event_id", "event_type", F.create_map(*kv).alias("attrs"), sparse_tags().alias("tags"),
                     sparse_nested().alias("nested"))


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, _raw): padded JSON payloads with bad and empty ones mixed in."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", sparse_columns()["_raw"].alias("_raw"))


def event_json(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(…keep, json): events as JSON objects whose keys vary by event type."""
    ev = table(spark, sf_dir, "events")
    body = F.struct(
        F.col("event_id"),
        F.col("event_type"),
        F.col("user_id"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k").cast("long")).alias("code"),
    )
    return ev.select(*keep, F.to_json(body).alias("json"))


def envelopes(spark: SparkSession, sf_dir: str, page_size: int = 500) -> DataFrame:
    """Search-result envelopes: one JSON document per (event type, day, page),
    ``{"results": [{"event_id": …, "_raw": props}, …]}`` ordered by event_id.
    Pages bound each document to ``page_size`` results."""
    ev = table(spark, sf_dir, "events")
    keyed = ev.select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.floor(F.col("event_id") / F.lit(page_size)).alias("page"),
        F.struct(F.col("event_id"), F.col("props").alias("_raw")).alias("r"),
    )
    return keyed.groupBy("event_type", "day", "page").agg(
        F.to_json(F.struct(F.sort_array(F.collect_list("r")).alias("results"))).alias("doc")
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents.text with two blank lines before each newline and a blank
    (whitespace-only) plus an empty line appended; every third text has a carriage return
    after each full stop, every fifth ends its lines in CR LF."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    text = F.when(i % 3 == 0, F.replace(F.col("text"), F.lit("."), F.lit(".\r"))).when(i % 5 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
    return docs.select("doc_id", F.concat(F.replace(text, F.lit("\n"), F.lit("\n\n\n")), F.lit("\n \t\n")).alias("raw"))


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, line_no, line): every line of pages.html; pages with
    id % 4 = 0 get a leading space, else id % 5 = 0 a ``a,"b"`` prefix with a carriage return."""
    pages = table(spark, sf_dir, "pages")
    lines = pages.select("page_id", F.posexplode(F.split(F.col("html"), "\n", -1)).alias("line_no", "line"))
    pid = F.col("page_id")
    return lines.select(
        "page_id",
        "line_no",
        F.when(pid % 4 == 0, F.concat(F.lit(" "), F.col("line")))
        .when(pid % 5 == 0, F.concat(F.lit('a,"b"\r'), F.col("line")))
        .otherwise(F.col("line"))
        .alias("line"),
    )


#: When the derived listing is looked at.
LISTED_AT = "1998-08-02 00:00:00"


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for every order: 40 bytes a unit of its price, last changed in the seconds about LISTED_AT
    for orders of that day and at its date otherwise."""
    o = table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderkey") % 3 == 0, F.lit(LISTED_AT).cast("timestamp")).otherwise(F.col("o_orderdate").cast("timestamp"))
    return o.select(
        F.concat(F.lit("buffer-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.floor(F.col("o_totalprice") * 40).alias("length"),
        F.timestamp_add("SECOND", F.col("o_orderkey") % 41 - 30, day).alias("modificationTime"),
    )


def earlier_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files some time before: every fifth is not there yet, every fourth is a byte shorter."""
    key = F.regexp_extract("name", r"\d+", 0).cast("bigint")
    return file_listing(spark, sf_dir).where(key % 5 != 0).withColumn("length", F.col("length") - (key % 4 == 0).cast("int"))


def any_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event): JSON events whose keys differ from event to event, with reserved and empty ones at every depth;
    every 101st is no JSON."""
    i, kind = _id(), F.col("event_type")
    text = F.format_string(
        '{"id": %d, "k%d": "%s", "__mv_k%d": "x", "_raw": "r", "e%d": "", "n%d": null, "deep": {"l%d": {"_raw": {"x": 1}, "v%d": ["", null, "a", ["", {"__mv_q": 1, "w": ""}], %d], "z": {}}}}',
        i, i % 13, kind, i % 5, i % 3, i % 4, i % 7, i % 11, i % 2,
    )
    return table(spark, sf_dir, "events").select("event_id", F.when(i % 101 == 0, F.concat(F.lit("{"), text)).otherwise(text).alias("event"))


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, line): events as JSON lines; some are no JSON or no object, some name a key twice or hold NaN."""
    i, value = _id(), F.col("value").cast("string")
    line = F.concat(F.lit('{"id": '), i.cast("string"), F.lit(', "sub": {"kind": "'), F.col("event_type"), F.lit('"}, "user": '), F.col("user_id").cast("string"))
    line = F.when(i % 97 == 0, F.concat(F.lit("not json "), i.cast("string"))).when(i % 89 == 0, F.concat(F.lit("["), i.cast("string"), F.lit("]"))).when(
        i % 83 == 0, F.concat(line, F.lit(', "user": -1}'))
    ).when(i % 79 == 0, F.concat(line, F.lit(', "value": NaN}'))).otherwise(F.concat(line, F.lit(', "value": '), value, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_type", line.alias("line"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item four times, numbered by ``copy``."""
    return table(spark, sf_dir, "lineitem").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(3))))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event delivery ledger: run = user_id % 5, failed when type = error."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("run-"), (F.col("user_id") % 5).cast("string")).alias("run_id"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.col("ts"),
    )


# ---------------------------------------------------------------------------
# Flattening nested results to scalar rows (event_id, path, value) so that
# they can be compared with SQL: struct fields "a.b", map keys "m.k", list
# elements "l[i]" plus the list length "l#".


def _is_nested(dtype) -> bool:
    return isinstance(dtype, (StructType, ArrayType, MapType))


def _pv(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.cast("string").alias("value"))


def _paths(c: Column, dtype, prefix: Column) -> Column:
    if isinstance(dtype, StructType):
        if not dtype.fields:
            return F.array().cast(PATH_VALUE)
        parts = [_paths(c.getField(f.name), f.dataType, F.concat(prefix, F.lit("." + f.name))) for f in dtype.fields]
        return parts[0] if len(parts) == 1 else F.concat(*parts)
    if isinstance(dtype, ArrayType):
        elem = dtype.elementType
        size_row = F.array(_pv(F.concat(prefix, F.lit("#")), F.size(c)))

        def at(i):
            return F.concat(prefix, F.lit("["), i.cast("string"), F.lit("]"))

        if _is_nested(elem):
            elems = F.flatten(F.transform(c, lambda x, i: _paths(x, elem, at(i))))
        else:
            elems = F.transform(c, lambda x, i: _pv(at(i), x))
        return F.concat(size_row, F.coalesce(elems, F.array().cast(PATH_VALUE)))
    if isinstance(dtype, MapType):
        vt = dtype.valueType

        def key(e):
            return F.concat(prefix, F.lit("."), e["key"])

        if _is_nested(vt):
            elems = F.flatten(F.transform(F.map_entries(c), lambda e: _paths(e["value"], vt, key(e))))
        else:
            elems = F.transform(F.map_entries(c), lambda e: _pv(key(e), e["value"]))
        return F.coalesce(elems, F.array().cast(PATH_VALUE))
    return F.array(_pv(prefix, c))


def _simple_parts(df: DataFrame):
    """Split a schema of scalars, structs of scalars, and maps/arrays of scalars
    into (scalar (path, column) pairs, [(path, map column)], [(path, array column)]);
    None when something is nested deeper."""
    scalars, maps, arrays = [], [], []

    def walk(c, dtype, path):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                if not walk(c.getField(f.name), f.dataType, f"{path}.{f.name}"):
                    return False
            return True
        if isinstance(dtype, MapType):
            if _is_nested(dtype.valueType):
                return False
            maps.append((path, c))
            return True
        if isinstance(dtype, ArrayType):
            if _is_nested(dtype.elementType):
                return False
            scalars.append((f"{path}#", F.size(c)))
            arrays.append((path, c))
            return True
        scalars.append((path, c))
        return True

    for f in df.schema.fields:
        if not walk(F.col(f"`{f.name}`"), f.dataType, f.name):
            return None
    return scalars, maps, arrays


def flatten_paths(df: DataFrame, id_col: str) -> DataFrame:
    """(id, path, value) rows of every leaf of every row.

    Simple shapes use code-generated generators (``stack`` for scalars,
    ``explode``/``posexplode`` for maps and arrays), one branch each, unioned;
    deeper nesting falls back to one ``inline`` over a built path array.
    """
    parts = _simple_parts(df)
    if parts is None:
        paths = [_paths(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in df.schema.fields]
        return df.select(F.col(id_col), F.inline(F.concat(*paths)))
    scalars, maps, arrays = parts
    idc = F.col(id_col)
    args = []
    for path, c in scalars:
        args += [F.lit(path), c.cast("string")]
    out = df.select(idc, F.stack(F.lit(len(scalars)), *args).alias("path", "value"))
    for path, c in maps:
        kv = df.select(idc, F.explode(c).alias("k", "v"))
        out = out.unionByName(
            kv.select(idc, F.concat(F.lit(path + "."), F.col("k")).alias("path"), F.col("v").cast("string").alias("value"))
        )
    for path, c in arrays:
        pv = df.select(idc, F.posexplode(c).alias("i", "v"))
        out = out.unionByName(
            pv.select(
                idc,
                F.concat(F.lit(path + "["), F.col("i").cast("string"), F.lit("]")).alias("path"),
                F.col("v").cast("string").alias("value"),
            )
        )
    return out
