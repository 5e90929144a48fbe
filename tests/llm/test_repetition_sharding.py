import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, extra, frame, odd_rows, row, words
from tidewater.llm import repetition, sharding, textarrays

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "covered_words"]


def brute(text, least):
    """The measures of one text, by comparing every two positions."""
    t = text or ""
    w = words(t)
    best = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            n = 0
            while i != j and i + n < len(w) and j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            best[i] = max(best[i], n)
    covered = lambda m: {p for i, b in enumerate(best) if b >= m for p in range(i, i + b)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), again, len(covered(5)), max(best, default=0), len(covered(least)))


def test_measures_equal_brute_force():
    rng = random.Random(3)
    parts = ["a", "b ", " ", "\n", "é#", "cc ", "dog ", "x y z w v u ", "\t", "日 "]
    rows = [None, "", " ", "a b", "\n\nx\nx\n", "a b c d e f a b c d e f", "a " * 90]
    rows += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(250)]
    found = repetition.measure(textarrays.texts(pa.array(rows)), 7)
    for i, text in enumerate(rows):
        assert tuple(int(found[c][i]) for c in COLUMNS) == brute(text, 7), repr(text)
        spans = found["repeat_spans"][i].as_py()
        assert sum(s["words"] for s in spans) == found["covered_words"][i]
        assert all(s["word"] + s["words"] <= found["n_words"][i] for s in spans)


def test_words_and_slices():
    column = pa.array(["a b", None, "", "  c ", "d" * 50, "e\x0bf"]).slice(1)
    t = textarrays.texts(column)
    w = textarrays.words(t)
    got = [bytes(t.data[b:e]).decode() for b, e in zip(w.begin, w.end)]
    assert got == ["c", "d" * 50, "e", "f"] and np.diff(w.first).tolist() == [0, 0, 1, 1, 2]
    assert [b - a for a, b in textarrays.slices(column, 8)] == [3, 1, 1]
    same = textarrays.range_hashes(t.data, w.begin, w.end)
    assert len(set(same.tolist())) == 4


def test_repetition_on_odd_rows(spark):
    df = extra(frame(spark, odd_rows()), "kept", "n_words", "__text")
    got = repetition.repetition(df, min_words=7).select("doc_id", *COLUMNS, "base_failed", "kept").collect()
    assert len(got) == len(odd_rows())
    want = Counter((r[0], *brute(r[1], 7)) for r in odd_rows() if r[0] != 6)
    assert Counter(tuple(r)[:8] for r in got if r["doc_id"] != 6) == want
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    assert repetition.repetition(spark.createDataFrame([], DOCS)).count() == 0


def test_long_repeat_is_rejected(spark):
    rng = random.Random(1)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = fresh(60)
    rows = [row(1, f"{fresh(900)} {passage} {fresh(900)} {passage}"), row(2, fresh(2000))]
    got = {r["doc_id"]: r for r in repetition.repetition(frame(spark, rows)).collect()}
    assert not got[1]["base_failed"] and not got[1]["kept"] and got[1]["longest_repeat"] == 60
    assert [(s["word"], s["words"]) for s in got[1]["repeat_spans"]] == [(900, 60), (1860, 60)]
    assert got[2]["kept"]


def shards_of(df, shards=16, **kw):
    return sharding.external_shuffle(df, shards=shards, **kw)


def test_shards_are_a_balanced_permutation(spark):
    rows = [row(i, f"text {i} " * (i % 7)) for i in range(503)]
    out = shards_of(frame(spark, rows), bucket_bytes=2000).collect()
    assert Counter(tuple(r)[:5] for r in out) == Counter(rows)
    per = Counter(r["shard"] for r in out)
    assert set(per) == set(range(16)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(per[s]))
    in_order = [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert in_order != sorted(in_order)


def test_shuffle_ignores_the_input_layout(spark):
    rows = [row(i % 40, f"text {i % 40}") for i in range(200)]  # every row five times
    a = shards_of(frame(spark, rows).repartition(1), bucket_bytes=300)
    b = shards_of(frame(spark, rows[::-1]).repartition(7), bucket_bytes=300)
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    assert a.count() == 200
    where = a.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).agg(F.avg("n")).first()[0]
    assert where > 3  # copies scatter


def test_shuffle_of_odd_rows_and_clashing_names(spark):
    df = extra(frame(spark, odd_rows()), "shard", "__bucket", "__pos")
    out = shards_of(df, shards=4)
    assert out.columns == [*df.columns, "shard_", "slot"]
    assert Counter(tuple(r)[:8] for r in out.collect()) == Counter(map(tuple, df.collect()))
    assert shards_of(spark.createDataFrame([], DOCS)).count() == 0


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, seed, 0).tolist()) for seed in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, 1, 1).tolist() == []


def test_written_shards_keep_the_order(spark, tmp_path):
    rows = [row(i, f"t{i}") for i in range(50)]
    out = shards_of(frame(spark, rows), shards=3)
    path = str(tmp_path / "shards")
    sharding.write_shards(out, path)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(out.columns).collect())) == Counter(map(tuple, out.collect()))


def test_query_three(spark):
    from tidewater.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_external_shuffle"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["law"] == "rows" and r["grown_shard"] is None
        assert r["text_crc32"] == zlib.crc32(raw)


@pytest.mark.parametrize("name", ["op7_repetition"])
def test_query_seven(spark, name):
    from tidewater.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 2500").collect()}
    for r in QUERIES[name](spark, sf).where(F.col("doc_id").isin(list(docs))).collect():
        want = brute(docs[r["doc_id"]], repetition.MIN_WORDS)
        assert tuple(r[c] for c in COLUMNS) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and want[6] <= 0.1 * want[0] and want[5] <= 50)
