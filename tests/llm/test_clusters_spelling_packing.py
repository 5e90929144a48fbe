"""Shallot clustering, spelling variants and sum-of-squares packing against plain versions."""

import base64
import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tests.llm.helpers import extra, frame, odd_rows, row
from tidewater.llm import common, packing, shallot, spelling
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- clustering ----------------------------------------------------------------------------------


def plain_means(rows, k, rounds, salt):
    """(id, cluster, distance) of every vector and the centroids, by full scans."""
    kept = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in kept[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(near(x)[1], []).append(x)
        centroids = [[sum(v) // len(groups[i]) for v in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    return Counter((i, *reversed(near(x))) for i, x in kept), centroids


@pytest.mark.parametrize("k, rounds", [(1, 2), (23, 6), (500, 2)])
def test_clusters_equal_full_scans(spark, k, rounds):
    rng = random.Random(k)
    rows = [(i, [rng.randrange(-8, 9) / 4 for _ in range(5)]) for i in range(200)]
    rows += [(300 + i, [0.25] * 5) for i in range(80)]  # a group of copies, and ties
    rows += [(7, rows[7][1]), (None, rows[8][1]), (None, rows[8][1])]
    useless = [(900, None), (901, []), (902, [1.0] * 4), (903, [None] + [1.0] * 4), (904, [float("nan")] * 5), (905, [float("inf")] + [0.0] * 4)]
    df = extra(spark.createDataFrame(rows + useless, "vec_id bigint, embedding array<double>"), "cluster", "x", "first", "sums")
    got, centroids = shallot.cluster(df.repartition(3), k=k, rounds=rounds, width=5, scale=4, salt="s")
    want, plain = plain_means([(i, [int(np.floor(4 * v)) for v in x]) for i, x in rows], k, rounds, "s")
    got = got.collect()
    assert centroids == plain and Counter((r.vec_id, r.cluster, r.distance) for r in got) == want
    per = Counter()
    for r in got:
        per[r.cluster] += r.distance
    assert all(r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values()) for r in got)


def test_no_vectors_no_clusters_and_too_large_ones_fail(spark):
    rows, centroids = shallot.cluster(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), width=2)
    assert rows.collect() == [] and centroids == [] and rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]
    with pytest.raises(Exception, match="would not fit"):
        shallot.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>"), width=2)


def test_the_search_measures_few_distances():
    rng = np.random.default_rng(3)
    middles = rng.integers(-4000, 4000, (64, 8))
    x = (middles[rng.integers(0, 64, 6000)] + rng.integers(-60, 60, (6000, 8))).astype(np.int32)
    c = x[rng.choice(len(x), 64, replace=False)].astype(np.int64)
    first, second, upper, lower = np.zeros(len(x), np.int32), np.ones(len(x), np.int32), np.full(len(x), np.inf), np.zeros(len(x))
    before, measured = None, []
    for _ in range(8):
        s = shallot.prepare(c, before)
        first, second, upper, lower, n = shallot.assign(s, x, first, second, upper, lower)
        every = ((x[:, None].astype(np.int64) - c[None]) ** 2).sum(axis=2)
        assert (first == every.argmin(axis=1)).all()
        assert (upper >= np.sqrt(every[np.arange(len(x)), first])).all()
        every[np.arange(len(x)), first] = 1 << 40
        assert (lower <= np.sqrt(every.min(axis=1))).all()
        measured.append(n / (len(x) * len(c)))
        before, c = c, np.array([x[first == j].sum(axis=0, dtype=np.int64) // max(1, (first == j).sum()) if (first == j).any() else c[j] for j in range(64)])
    assert measured[0] < 0.75 and measured[-1] < 0.05


# --- spelling ------------------------------------------------------------------------------------


def plain_words(docs, least=7, every=31):
    found = Counter()
    for r in docs:
        i, text = r[0], r[1] or ""
        run = ""
        for c in text + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= least:
                    found[run] += 1
            run = ""
    return found


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times):
    near = {w: sorted((v for v in counts if one_apart(w, v)), key=lambda v: (-counts[v], v)) for w in counts}
    form = {w: near[w][0] if near[w] and counts[near[w][0]] >= times * n else None for w, n in counts.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def test_words_equal_a_plain_scan(spark):
    rng = random.Random(2)
    rows = odd_rows() + [row(100 + i, " ".join("".join(rng.choice("abÀÿÜ×éZQ") for _ in range(rng.randrange(5, 11))) for _ in range(60))) for i in range(20)]
    rows += [row(200, "Straßenbahn STRASSENBAHN straßenbahn's ÉCOLES écoles2écoles_naïvetés " * 40), row(200, "a" * 5000 + "-" + "b" * 6)]
    df = extra(frame(spark, rows), "word", "n", "run", "id", "h")
    assert dict(map(tuple, spelling.words(df).collect())) == dict(plain_words(rows))
    assert dict(map(tuple, spelling.words(df, least=2, every=3).collect())) == dict(plain_words(rows, 2, 3))
    assert spelling.words(frame(spark, [])).collect() == []


@pytest.mark.parametrize("symbols, bits", [(None, 1 << 27), (2, 64)])
def test_variants_equal_all_pairs(spark, monkeypatch, symbols, bits):
    monkeypatch.setattr(common, "MOST_BITS", bits)
    rng = random.Random(5)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 10)))
        counts[word] = rng.choice([1, 2, 3, 1000])
        for _ in range(6):
            at = rng.randrange(len(word) + 1)
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcdeñ") + word[at:], word[:at] + rng.choice("abÿ") + word[at + 1 :]]) or "x"
            counts[word] = rng.choice([1, 2, 10, 20, 100])
    counts |= {"l" * 300: 50, "l" * 299: 500, "l" * 298 + "m": 5, "": 4}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), times=10, symbols=symbols).collect()
    assert len(got) == len(counts) and set(map(tuple, got)) == plain_variants(counts, 10)


def test_neighbourhoods_are_full_and_distinct():
    for symbols in (1, 2, 3):
        for word in ([1], [1, 1, 2], [2, 1, 1, 3, 1]):
            word = [min(c, symbols) for c in word]
            letters = range(1, symbols + 1)
            want = {tuple(word)} | {(*word[:i], *word[i + 1 :]) for i in range(len(word))}
            want |= {(*word[:i], c, *word[i + 1 :]) for i in range(len(word)) for c in letters} | {(*word[:i], c, *word[i:]) for i in range(len(word) + 1) for c in letters}
            got = np.concatenate([k for _, k in spelling.neighbours(np.array([word], dtype=np.uint64), symbols)])
            power = spelling._powers(9)
            assert sorted(got.tolist()) == sorted(spelling.mix64(np.array([np.sum(np.array(w, np.uint64) * power[: len(w)], dtype=np.uint64)])).item() for w in want)
    words = pa.array(["abc", "", "é"])
    assert len(spelling.reduced_keys(words, 5)) == 3


def test_an_empty_vocabulary_and_whole_query(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n bigint")).collect() == []
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in plain_words(docs).items() if n >= 2}
    got = QUERIES["op12_spelling_variants"](spark, SF).collect()
    assert set(map(tuple, got)) == plain_variants(counts, 10) and len(got) == len(counts)


# --- packing -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def check_packing(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity; returns how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def check_cuts(rows, texts, tokenizer, capacity):
    """Pieces of every (id, text), as a multiset, equal the cut ids of the tokenizer."""
    want = Counter()
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_odd_documents_are_cut_and_packed(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 500)
    rng = random.Random(9)
    rows = odd_rows() + [row(20, "a <|endoftext|> b<|endoftext|>"), row(21, "no-space " * 3 + "x" * 3000), row(22, "tabs\t\t and  spaces \n\n\n end " * 200), row(23, "Ünïcödé 漢字 😀 " * 150)]
    rows += [row(100 + i, " ".join(rng.choice(["it's", "we'll", "12", "x!", " ", " ", "né"]) for _ in range(rng.randrange(400)))) for i in range(40)]
    rows += [row(300, "equal rows of one id and one text")] * 30
    df = extra(frame(spark, rows), "piece", "sequence_id", "offset", "id", "start")
    for capacity, group in ((64, 50), (1, 1000), (5000, 7)):
        cut = packing.cut_documents(df, BPE, capacity=capacity, ids=True)
        got = packing.pack(cut, capacity=capacity, group_pieces=group)
        out = got.collect()
        check_cuts(out, [(r[0], r[1]) for r in rows], tokenizer, capacity)
        check_packing(out, capacity)
        assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in out)
    whole = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    for r in out:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    empty = packing.pack(packing.cut_documents(frame(spark, []), BPE))
    assert empty.collect() == [] and empty.columns[-2:] == ["sequence_id", "offset"]


def test_columns_that_clash_ride_along(spark):
    df = spark.createDataFrame([(i, 5 + i % 7, "old") for i in range(50)], "doc_id int, length bigint, sequence_id string")
    out = packing.pack(df, capacity=16, group_pieces=10)
    assert out.count() == 50 and out.columns[:3] == ["doc_id", "length", "sequence_id"] and len(out.columns) == 5
    assert out.where("sequence_id = 'old'").count() == 50


def plain_sum_of_squares(sizes, capacity):
    """The rule by trying every choice; a filled sequence is not open."""
    gaps, where = [], []
    for s in sizes:
        best = None
        for gap in sorted({g for g in gaps if g >= s}) + [capacity]:
            new = gap == capacity and capacity not in gaps
            after = [*gaps, capacity] if new else list(gaps)
            after[len(after) - 1 if new else after.index(gap)] -= s
            cost = sum(n * n for g, n in Counter(after).items() if g)
            if best is None or cost < best[0]:
                best = (cost, gap, new)
        gaps, to = ([*gaps, capacity - s], len(gaps)) if best[2] else (gaps, gaps.index(best[1]))
        if not best[2]:
            gaps[to] -= s
        where.append(gaps[to])
    return sorted(gaps), where


def test_the_rule_equals_trying_every_choice():
    rng = random.Random(1)
    for capacity in (7, 12, 30):
        sizes = [rng.randrange(1, capacity + 1) for _ in range(150)]
        where, begin, gaps = packing.sum_of_squares(np.array(sizes), capacity)
        want, left = plain_sum_of_squares(sizes, capacity)
        assert sorted(gaps.tolist()) == want
        assert [capacity - b - s for b, s in zip(begin.tolist(), sizes)] == left


def test_few_sequences_in_any_grouping(spark):
    rng = np.random.default_rng(4)
    sizes = [*rng.integers(1, 1024, 6000).tolist(), *[1024] * 500, *[700] * 3000]  # a third of one size
    rows = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "doc_id int, length bigint").repartition(4)
    big, bound = sum(s > 512 for s in sizes), -(-sum(sizes) // 1024)
    for group in (500, 100_000):
        out = packing.pack(rows, group_pieces=group).collect()
        assert len(out) == len(sizes) and {r.doc_id for r in out} == set(range(len(sizes)))
        assert check_packing(out, 1024) <= 1.03 * max(big, bound)


def test_query_packs_all_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op13_sum_of_squares"](spark, SF).collect()
    check_cuts(out, [tuple(r) for r in docs], tokenizer, 1024)
    assert check_packing(out, 1024) <= 1.05 * -(-sum(r.length for r in out) // 1024)


def test_ranks_equal_the_rank_file():
    ranks, special = packing.load_ranks(BPE)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    assert special == {"<|endoftext|>": 50256} and packing.PATTERN == public_tokenizers.PATTERN
    with open(BPE, encoding="utf-8") as f:
        assert json.load(f)["pre_tokenizer"]["type"] == "ByteLevel"
