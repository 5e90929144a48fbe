"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor repeats only what came after, and
    gives the planner measured sizes for the joins that follow.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_bucket(col: Column | str, modulus: int) -> Column:
    """``crc32(value as text) mod modulus``; null for a null value."""
    return F.pmod(F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")), F.lit(modulus))


def fresh(base: str, taken: list[str]) -> str:
    """A column name starting with ``base`` that clashes with none of ``taken`` (case-insensitively)."""
    low = {t.lower() for t in taken}
    return base if base.lower() not in low else f"{base}_{uuid.uuid4().hex[:8]}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bits of the largest bit table: 16 MiB in at most 2 ** 21 rows, however many keys there are.
MOST_BITS = 1 << 27


def bit_table(keys: DataFrame, key: str, n: int) -> DataFrame:
    """Which low bits of the 64-bit ``key`` occur, as rows ``__at``, ``__bits`` of 64 bits each; ``n``: how many keys there
    are. 16 bits a key up to MOST_BITS; the rows' number is bounded by that, so the table can be broadcast at any size."""
    bits = table_bits(n)
    low = F.col(key).bitwiseAND(F.lit(bits - 1))
    rows = keys.select(F.shiftright(low, 6).alias("__at"), F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))").alias("__bit"))
    return rows.groupBy("__at").agg(F.bit_or("__bit").alias("__bits"))


def table_bits(n: int) -> int:
    return min(MOST_BITS, 1 << max(10, (16 * n).bit_length()))


def maybe_in(rows: DataFrame, id_col: str, wanted: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false only if the row's id is surely not among the ids of ``wanted`` (one column;
    null ids are not). One plan for all sizes: a broadcast of bounded size, and no row moves."""
    keys = wanted.select(F.xxhash64(F.col(wanted.columns[0]).cast("bigint")).alias("__key"))
    n = wanted.count()
    table = materialize(bit_table(keys, "__key", n), "bit-table")
    key = F.xxhash64(F.col(f"`{id_col}`").cast("bigint"))
    at = F.shiftright(key.bitwiseAND(F.lit(table_bits(n) - 1)), 6)
    hit = F.getbit(F.col("__bits"), key.bitwiseAND(F.lit(63)).cast("int")) == 1
    out = rows.join(F.broadcast(table), at == F.col("__at"), "left")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], (F.coalesce(hit, F.lit(False)) & F.col(f"`{id_col}`").isNotNull()).alias(flag))
