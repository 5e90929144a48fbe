"""Mixing sources to target weights.

Words are summed per source, a capped weighted share gives each source's
target, target / size is the source's repetition rate, and every document is
emitted ``floor(rate)`` times plus one more copy when a hash-seeded draw falls
below the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, materialize

#: A word: a run of characters other than space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
#: 2**32, the range of the draw.
DRAW_RANGE = 4294967296


def word_count(text: Column) -> Column:
    """Words of the text as BIGINT; null text has none.

    Separators are folded to one space and trimmed from the ends, so the number of
    words is the number of spaces plus one (no array of words is built).
    """
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(F.length(flat) == 0, F.lit(0)).otherwise(spaces + 1), F.lit(0)).cast("bigint")


def draw(seed: str, key: Column, fallback: Column) -> Column:
    """Uniform integer in [0, 2**32) from the row key (``fallback`` where the key is null)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.concat(F.lit("null:"), F.coalesce(fallback, F.lit("")))))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def source_rates(
    sizes: DataFrame,
    source_col: str = "source",
    size_col: str = "size",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    cap: int = 3,
) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``rate``.

    Sources in code-point order (null last) take the weights in turn. A target
    never exceeds ``cap`` times the source's size; what a capped source leaves is
    reshared by weight until none is above. That fixed point is found in closed
    form: with sources sorted by cap * size / weight, the capped ones are a prefix.
    Sources without words keep target 0 and rate 0. An empty input has no rows.
    The windows here run over one narrow row per *source*, never per document.
    """
    per = sizes.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).cast("bigint").alias("source_size"))
    weight = F.array(*[F.lit(int(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = per.withColumn("weight", F.get(weight, F.pmod(rank - 1, F.lit(len(weights)))).cast("bigint"))
    w = w.withColumn("full", F.lit(int(cap)).cast("bigint") * F.col("source_size"))
    order = Window.orderBy((F.col("full") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("left_words", F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("full").over(before), F.lit(0)))
    w = w.withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # The k-th source in this order is capped when the level that would hold without capping it exceeds its own cap.
    w = w.withColumn("level", F.col("left_words") / F.col("left_weight"))
    w = w.withColumn("open", F.col("level") * F.col("weight") < F.col("full"))
    w = w.withColumn("place", F.row_number().over(order))
    w = w.withColumn("final_level", F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)["level"])
    target = F.when(
        F.col("final_level").isNull() | (F.col("final_level") * F.col("weight") >= F.col("full")), F.col("full").cast("double")
    ).otherwise(F.col("final_level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return w.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate")


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    **options,
) -> DataFrame:
    """What the mix takes of each row: id, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken``.

    One row per input row. The text is read once, into a narrow table; the rest
    works on that. Null or empty texts have size 0; a null source is a source of its
    own; equal rows draw alike; a null id draws by its text. Other columns are ignored,
    whatever their names.
    """
    narrow = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            draw(seed, F.col(id_col), F.col(text_col)).alias("draw"),
        ),
        "mix-sizes",
    )
    rates = materialize(source_rates(narrow, **options), "mix-rates")
    planned = _with_rates(narrow, "source", rates)
    return planned.select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "source_size",
        "target",
        "rate",
        copies(F.col("rate"), F.col("draw")).alias("copies"),
        (F.col("size") * copies(F.col("rate"), F.col("draw"))).alias("taken"),
    )


def copies(rate: Column, drawn: Column) -> Column:
    """floor(rate) plus one when the draw falls below the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(drawn.cast("double") / F.lit(float(DRAW_RANGE)) < rate - whole, 1).otherwise(0)).cast("bigint")


def _with_rates(rows: DataFrame, source_col: str, rates: DataFrame) -> DataFrame:
    """Join the per-source table; null sources match. Not hinted: the planner broadcasts it only if its
    measured size is small, else a sort-merge join whose hot source adaptive execution splits."""
    r = rates.withColumnsRenamed({"source": "__rate_source"})
    return rows.join(r, F.col(source_col).eqNullSafe(F.col("__rate_source")), "left").drop("__rate_source")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    **options,
) -> DataFrame:
    """The mixed corpus: every row of ``docs`` repeated as often as the mix takes it, columns unchanged."""
    narrow = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rates = materialize(source_rates(narrow, **options), "mix-rates")
    owner, rate, taken, copy = (fresh(n, docs.columns) for n in ("__source", "__rate", "__copies", "__copy"))
    rates = rates.select(F.col("source").alias(owner), F.col("rate").alias(rate))
    rows = docs.join(rates, F.col(f"`{source_col}`").eqNullSafe(F.col(owner)), "left")
    rows = rows.withColumn(taken, copies(F.col(rate), draw(seed, F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))).cast("int"))
    rows = rows.where(F.col(taken) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(taken))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
