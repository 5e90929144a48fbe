"""Schema-driven builder for the event cleaners.

The cleaners take any JSON-shaped value (objects, lists, scalars, any depth)
and drop keys or list elements.  On a Spark schema that becomes one
expression tree, built once on the driver by walking the ``DataType``:

* struct  -> rebuild the struct without statically dropped field names;
             a field whose value is dropped when *empty* becomes null
             (absent and null coincide in a struct; only strings need the
             test, other values are empty only when already null)
* map     -> ``map_filter`` on (key, value), then ``transform_values``
* array   -> ``filter`` of empty elements, then ``transform``
* scalar  -> unchanged

The emptiness test always looks at the *original* child value, before the
child itself is cleaned, so removal does not cascade: ``[""]`` becomes
``[]`` and ``{"a": ""}`` becomes ``{}``; both are kept.

Depth is bounded by the schema; everything stays inside the JVM (higher
order functions), so whole-stage codegen and column pruning still apply.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from tidewater.functions.text import is_empty_value

from tidewater.constants import MV_PREFIX, RAW_KEY


@dataclass(frozen=True)
class CleanRules:
    """Which keys/elements a cleaner removes.

    drop_key(name)        -> remove the key whatever its value
    drop_if_empty(name)   -> remove the key when its original value is empty
    drop_empty_elements   -> remove null / '' list elements
    The ``*_col`` variants are the same tests on a map-key Column.
    """

    name: str
    drop_key: Callable[[str], bool]
    drop_key_col: Callable[[Column], Column]
    drop_if_empty: Callable[[str], bool]
    drop_if_empty_col: Callable[[Column], Column]
    drop_empty_elements: bool


def _never(_name):
    return False


def _never_col(_k):
    return F.lit(False)


def _always(_name):
    return True


def _always_col(_k):
    return F.lit(True)


def _is_mv(name: str) -> bool:
    return name.startswith(MV_PREFIX)


def _is_mv_col(k: Column) -> Column:
    return k.startswith(MV_PREFIX)


C1_DROP_MV = CleanRules("drop_mv_fields", _is_mv, _is_mv_col, _never, _never_col, False)
C2_DROP_EMPTY = CleanRules("drop_empty_fields", _never, _never_col, _always, _always_col, True)
C3_DROP_EMPTY_MV = CleanRules("drop_empty_mv_fields", _never, _never_col, _is_mv, _is_mv_col, True)
C4_DROP_RAW = CleanRules(
    "drop_raw_field", lambda n: n == RAW_KEY, lambda k: k == F.lit(RAW_KEY), _never, _never_col, False
)
# C5 = C4 . C3 . C2 . C1 fused into one traversal: after C1 and C2 nothing is
# left for C3, and no pass turns a non-empty value into an empty one.
C5_ALL = CleanRules(
    "clean_events",
    lambda n: _is_mv(n) or n == RAW_KEY,
    lambda k: _is_mv_col(k) | (k == F.lit(RAW_KEY)),
    _always,
    _always_col,
    True,
)


def _is_nested(dtype: DataType) -> bool:
    return isinstance(dtype, (StructType, ArrayType, MapType, VariantType))


def clean_column(c: Column, dtype: DataType, rules: CleanRules) -> Column:
    """Return the cleaned value of ``c`` (whose type is ``dtype``).

    A struct that has only reserved fields becomes an empty map, at any depth: no table format
    can hold a struct without fields.
    """
    if isinstance(dtype, StructType):
        fields = []
        for f in dtype.fields:
            if rules.drop_key(f.name):
                continue
            child = c.getField(f.name)
            value = clean_column(child, f.dataType, rules) if _is_nested(f.dataType) else child
            if rules.drop_if_empty(f.name) and isinstance(f.dataType, StringType):
                value = F.when(is_empty_value(child, f.dataType), F.lit(None)).otherwise(value)
            fields.append(value.alias(f.name))
        # a struct without fields cannot be written to any table: an empty map stands for it
        rebuilt = F.struct(*fields) if fields else F.create_map().cast("map<string,string>")
        return F.when(c.isNull(), F.lit(None)).otherwise(rebuilt)

    if isinstance(dtype, ArrayType):
        elem = dtype.elementType
        out = c
        if rules.drop_empty_elements:
            out = F.filter(out, lambda x: ~is_empty_value(x, elem))
        if _is_nested(elem):
            out = F.transform(out, lambda x: clean_column(x, elem, rules))
        return out

    if isinstance(dtype, MapType):
        vt = dtype.valueType
        out = F.map_filter(
            c,
            lambda k, v: ~(
                rules.drop_key_col(k) | (rules.drop_if_empty_col(k) & is_empty_value(v, vt))
            ),
        )
        if _is_nested(vt):
            out = F.transform_values(out, lambda k, v: clean_column(v, vt, rules))
        return out

    if isinstance(dtype, VariantType):
        raise TypeError("a VARIANT has no schema to clean by: use clean_json_events, which measures its depth, or give it a schema")
    return c


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


#: Levels of nesting that one expression takes: each is a few lambdas, and the analyzer resolves so many at most.
LEVELS = 5


def clean_variant(v: Column, rules: CleanRules, depth: int, deeper: str | None = None) -> Column:
    """The cleaned value of a VARIANT whose objects and lists nest at most ``depth`` deep.

    Each level of nesting is one step of the same expression: the value's entries (an object's keys, or a list's
    elements without key) are cleaned, tested and put together again, so the expression grows with the depth, not
    with the number of different keys. Numbers, strings and booleans stay as they are. What nests deeper becomes a string of
    ``deeper`` and its JSON text, or fails the job without ``deeper``.
    """
    return _bound(_clean_node(v, rules, depth, deeper), lambda n: n["value"])


def _clean_node(v: Column, rules: CleanRules, depth: int, deeper: str | None) -> Column:
    """struct(empty: the original is null or '', value: the cleaned one)."""
    if depth == 0:
        nested = F.coalesce(F.try_variant_get(v, "$", "map<string,variant>").isNotNull() | F.try_variant_get(v, "$", "array<variant>").isNotNull(), F.lit(False))
        instead = F.raise_error(F.lit("an event nests deeper than the depth given")).cast("variant") if deeper is None else F.to_variant_object(F.array(F.concat(F.lit(deeper), F.to_json(v))))
        if deeper is not None:
            instead = F.variant_get(instead, "$[0]", "variant")
        return _bound(nested, lambda x: F.struct((~x & _is_empty(v)).alias("empty"), F.when(x, instead).otherwise(v).alias("value")))
    keyed = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    listed = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    parts = F.struct(keyed.isNotNull().alias("object"), F.coalesce(keyed, listed).alias("entries"))

    def node(p: Column) -> Column:
        scalar = p["entries"].isNull()
        cleaned = F.transform(p["entries"], lambda e: F.struct(e["key"].alias("key"), _clean_node(e["value"], rules, depth - 1, deeper).alias("node")))

        def gone(e: Column) -> Column:
            by_key = rules.drop_key_col(e["key"]) | (rules.drop_if_empty_col(e["key"]) & e["node"]["empty"])
            return F.when(p["object"], by_key).otherwise(e["node"]["empty"] if rules.drop_empty_elements else F.lit(False))

        kept = F.transform(F.filter(cleaned, lambda e: ~gone(e)), lambda e: F.struct(e["key"].alias("key"), e["node"]["value"].alias("value")))
        whole = _bound(
            kept,
            lambda k: F.when(p["object"], F.to_variant_object(F.map_from_entries(F.when(p["object"], k)))).otherwise(F.to_variant_object(F.transform(k, lambda e: e["value"]))),
        )
        return F.struct((scalar & _is_empty(v)).alias("empty"), F.when(scalar, v).otherwise(whole).alias("value"))

    return _bound(parts, node)


def _is_empty(scalar: Column) -> Column:
    return scalar.isNull() | F.is_variant_null(scalar) | F.coalesce(F.try_variant_get(scalar, "$", "string") == "", F.lit(False))


def json_depth(text: Column) -> Column:
    """How deep objects and lists nest in a JSON text: its brackets outside strings, counted in one pass; 0 for a scalar."""
    brackets = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"|[^\[\]{}"]++', "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, c: Column) -> Column:
        now = s["now"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), zero, step, lambda s: s["most"])


def clean_frame(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Apply ``rules`` to every column of ``df`` (the row is the event)."""
    cols = []
    for f in df.schema.fields:
        if rules.drop_key(f.name):
            continue
        child = F.col(f"`{f.name}`")
        value = clean_column(child, f.dataType, rules) if _is_nested(f.dataType) else child
        if rules.drop_if_empty(f.name) and isinstance(f.dataType, StringType):
            value = F.when(is_empty_value(child, f.dataType), F.lit(None)).otherwise(value)
        cols.append(value.alias(f.name))
    return df.select(*cols)
