"""Every registered query against its DuckDB twin (sf0.001), like the driver."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from tidewater.functions.text import is_blank
from tidewater.plans import fixtures as fx
from tidewater.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    qs, sql = se.queries(), se.oracle_sql()
    assert set(sql) <= set(qs) and set(QUERIES) <= set(qs)
    assert set(QUERIES) <= set(sql)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    otypes = dict(zip(rel.columns, [DUCK_TO_SPARK.get(str(t), str(t)) for t in rel.types]))
    assert dict(df.dtypes) == otypes
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["event_id", "ts", "k"]
    assert df.count() == 50


def test_negative_control_trim_is_caught(spark, con):
    """A blank-line rule built on Spark's trim keeps ' \\t' lines: the oracle must disagree."""
    wrong = (
        fx.raw_text(spark, SF)
        .select(F.explode(F.split("raw", "\n", -1)).alias("line"))
        .where(F.trim("line") != "")
    )
    right = fx.raw_text(spark, SF).select(F.explode(F.split("raw", "\n", -1)).alias("line")).where(~is_blank("line"))
    n_oracle = con.sql(se.oracle_sql()["stream_intake"]).fetchall()
    assert right.count() == len(n_oracle)
    assert wrong.count() != len(n_oracle)
