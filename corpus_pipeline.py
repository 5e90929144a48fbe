"""Corpus pipeline: quality, near-duplicates, privacy, mixing, tokenization, in this order.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, the result of the
stage before it. All but the last return the columns that they were given; the last returns a row
for each sampled segmentation. Empty tables pass through; nulls, repeated rows and extra columns
are treated as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard, mixing, pieces, pii, quality
from tidewater.llm.common import fresh, id_bucket, materialize, maybe_in

#: Documents that score less are rejected.
QUALITY_LEAST = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores QUALITY_LEAST or more; every fifth id teaches nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_bucket("doc_id", 5) != 0)
    model = quality.fit(docs, labels)
    score = fresh("score", docs.columns)
    return quality.score(docs, model, keep=docs.columns, score_col=score).where(F.col(score) >= QUALITY_LEAST).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id. Rows without an id link with
    nothing and stay; rows equal in id (or both without one) and text are one document. Different texts of
    one id are documents of their own, the first text the smallest."""
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return _first_of_groups(docs, "doc_id")
    place = fresh("__place", docs.columns)
    once = docs.dropDuplicates(["doc_id", "text"]).orderBy("doc_id", "text")
    once = once.withColumn(place, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id()))
    return _first_of_groups(materialize(once, "documents-once"), place).select(docs.columns)


def _first_of_groups(docs: DataFrame, id_col: str) -> DataFrame:
    """The rows that are the smallest by ``id_col``, which tells them apart, of their group; those without one stay."""
    groups = materialize(jaccard.jaccard_join(docs, id_col, size=5, percent=80).select(id_col, "component_id"), "groups")
    gone = materialize(groups.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), "groups-gone")
    # Only the texts that may go take part in the join.
    may = fresh("__may", docs.columns)
    seen = maybe_in(docs, id_col, gone, may)
    doubtful = seen.where(may).join(gone, id_col, "left_anti")
    return seen.where(~F.col(may)).select(docs.columns).unionAll(doubtful.select(docs.columns))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses replaced by pseudonyms; ``n_chars`` follows the new text."""
    found = fresh("__found", docs.columns)
    rows = pii.pseudonymize(docs, "text", key=pii.session_key(spark), found_col=found)
    changed = F.size(found) > 0
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks."""
    return mixing.mix_sources(docs, weights=(5, 2, 1), share=1.0, cap=3)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document."""
    return pieces.encode_samples(docs, k=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("pseudonyms", hide_personal),
    ("mixing", mix),
    ("segmentations", tokenize),
]

#: The quality model, the verified links and the samplers cannot be written in SQL;
#: the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
