import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, extra, frame, odd_rows, row
from tidewater.llm import pieces, ppm, quality, textarrays
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def segmentations(v, text):
    """Every segmentation of a short text with its exact probability."""
    logp = {p: (i, lp) for p, i, lp in zip(v.pieces, v.ids.tolist(), v.logp.tolist())}
    text, out = " " + text, []

    def go(at, ids, lp):
        if at == len(text):
            out.append((tuple(ids), lp))
            return
        for to in range(at + 1, len(text) + 1):
            if (p := text[at:to].encode()) in logp:
                go(to, [*ids, logp[p][0]], lp + logp[p][1])
        if text[at].encode() not in logp:
            raw = text[at].encode()
            go(at + 1, [*ids, *(int(v.byte_ids[b]) for b in raw)], lp + v.byte_logp * len(raw))

    go(0, [], 0.0)
    total = sum(math.exp(lp) for _, lp in out)
    return {ids: math.exp(lp) / total for ids, lp in out}


@pytest.mark.parametrize("text", ["the cat", "é日\n x", "a  b", "tion"])
def test_samples_follow_the_law_without_replacement(vocabulary, text):
    law, n = segmentations(vocabulary, text), 12_000
    seeds = textarrays.mix64(np.arange(n, dtype=np.uint64) + np.uint64(77))
    plain = textarrays.texts(pa.array([text] * n))
    found, following = pieces.sample(pieces.Lattices(vocabulary), pieces.with_prefix(plain), seeds, 3)
    rows = [[tuple(s.ids[a:b].tolist()) for a, b in zip(s.first[:-1], s.first[1:])] for s in found]
    for i, ids in enumerate(rows[0][:50]):
        assert math.exp(found[0].log_prob[i]) == pytest.approx(law[ids])
    second = {b: sum(p * law[b] / (1 - p) for a, p in law.items() if a != b) for b in law}
    for got, want in ((rows[0], law), (rows[1], second)):
        count = collections.Counter(got)
        for ids, p in want.items():
            assert abs(count[ids] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 3
    by_text = collections.defaultdict(list)
    for s, ids in zip(found, rows):
        for x, i, t in zip(s.text.tolist(), ids, s.log_time.tolist()):
            by_text[x].append((t, i))
    for x, drawn in by_text.items():
        times = [t for t, _ in drawn]
        assert len({i for _, i in drawn}) == len(drawn) and times == sorted(times) and following[x] >= times[-1]


def test_inclusion_scores_estimate_totals(vocabulary):
    """Importance weights exp(log_prob - log_inclusion) of a sample of two give unbiased sums."""
    law, n = segmentations(vocabulary, "tion"), 20_000
    seeds = textarrays.mix64(np.arange(n, dtype=np.uint64))
    found, following = pieces.sample(pieces.Lattices(vocabulary), pieces.with_prefix(textarrays.texts(pa.array(["tion"] * n))), seeds, 2)
    total = sum((np.diff(s.first) * np.exp(s.log_prob - pieces.log_inclusion(s.log_prob, following[s.text]))).sum() for s in found) / n
    assert total == pytest.approx(sum(len(ids) * p for ids, p in law.items()), rel=0.02)


def test_encode_odd_rows_and_decode(spark):
    df = extra(frame(spark, odd_rows()), "sample", "__seed", "__text")
    out = pieces.encode_samples(df, k=3, keep=["doc_id", "text", "__seed"])
    got = pieces.decode_pieces(out.withColumn("decoded", F.lit(1))).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[(r["doc_id"], r["text"])].append(r)
    assert set(by) == {(r[0], r[1]) for r in odd_rows()}
    for (_, text), rows in by.items():
        if text is None:
            assert len(rows) == 1 and rows[0]["pieces"] is None and rows[0]["decoded"] is None
            continue
        assert all(r["decoded"] == text and r["round_trip"] and r["n_pieces"] == len(r["pieces"]) for r in rows)
        assert {r["sample"] for r in rows} == set(range(len({tuple(r["pieces"]) for r in rows})))
    assert [r["pieces"] for r in by[(3, "")]] == [[]]
    same = by[(1, odd_rows()[0][1])]
    assert len(same) == 6 and len({tuple(r["pieces"]) for r in same}) == 3  # repeated rows sample alike
    assert pieces.encode_samples(spark.createDataFrame([], DOCS)).count() == 0
    bad = spark.createDataFrame([([1, 2, 99999, None, 3 + 255],), (None,)], "pieces array<int>")
    assert [r["decoded"] for r in pieces.decode_pieces(bad).collect()] == ["�", None]


def test_sampling_ignores_the_input_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    draw = lambda df: {(r["doc_id"], r["sample"]): r["pieces"] for r in pieces.encode_samples(df).collect()}
    assert draw(docs.coalesce(1)) == draw(docs.repartition(7))


def ppm_bits(train, text):
    """PPM-C with full exclusion over the counts of one language's texts, byte by byte."""
    counts = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
    for t in train:
        raw = bytes(ppm.ORDER) + t.encode()
        for i in range(ppm.ORDER, len(raw)):
            for k in range(ppm.ORDER + 1):
                counts[k][raw[i - k : i]][raw[i]] += 1
    raw, bits = bytes(ppm.ORDER) + text.encode(), 0.0
    for i in range(ppm.ORDER, len(raw)):
        out, done = set(), False
        for k in range(ppm.ORDER, -1, -1):
            ctx = counts[k].get(raw[i - k : i])
            if not ctx:
                continue
            left = {b: n for b, n in ctx.items() if b not in out}
            whole = sum(left.values()) + len(left)
            if raw[i] in left:
                bits -= math.log2(left[raw[i]] / whole)
                done = True
                break
            if left:
                bits -= math.log2(len(left) / whole)
            out |= set(ctx)
        if not done:
            bits += math.log2(max(1, 256 - len(out)))
    return bits


def test_code_lengths_equal_byte_by_byte_coding():
    rng = random.Random(2)
    make = lambda letters: ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(30)]
    train = {"a": make("aab ce"), "b": make("xyz éa"), "c": ["q"]}
    counts = {}
    for lang, rows in train.items():
        keys, n = np.unique(ppm.grams(textarrays.texts(pa.array(rows))), return_counts=True)
        counts[lang] = keys, n
    model = ppm.Model(counts)
    rows = ["", "abc", "zéa", "totally other 日本", *make("abxyé q")]
    got = model.code_lengths(textarrays.texts(pa.array(rows)))
    for i, text in enumerate(rows):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(ppm_bits(train[lang], text), abs=1e-6), (text, lang)


def test_ppm_probabilities_sum_to_one():
    keys, n = np.unique(ppm.grams(textarrays.texts(pa.array(["banana band", "bandana"]))), return_counts=True)
    tree = ppm.Tree(keys, n.astype(float))
    for ctx in (b"ana", b"xan", b"xxa", b"xxx", b"\0\0b"):
        base = np.uint32(int.from_bytes(ctx, "big") << 8)
        assert np.exp2(-tree.bits(base + np.arange(256, dtype=np.uint32))).sum() == pytest.approx(1.0)


def test_ppm_odd_rows_and_no_languages(spark):
    df = extra(frame(spark, odd_rows()), "lang_pred", "__text")
    model = ppm.fit(df)
    got = ppm.predict(df, model, keep=["doc_id", "text"]).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        lettered = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
    nothing = ppm.fit(df.where("false"))
    assert {r["lang_pred"] for r in ppm.predict(df, nothing).collect()} == {"und"}
    assert ppm.predict(spark.createDataFrame([], DOCS), model).count() == 0


def test_ppm_keeps_a_rare_language_beside_a_hot_one(spark):
    rng = random.Random(3)
    make = lambda letters, n: ["".join(rng.choice(letters) for _ in range(60)) for _ in range(n)]
    hot, rare = make("abcdefgh ", 300), make("abcxyz ", 3)
    df = frame(spark, [row(i, t, "hot" if i < 300 else "rare") for i, t in enumerate([*hot, *rare])])
    tests = [*make("abcdefgh ", 5), *make("abcxyz ", 5), rare[0], "é", "a"]
    asked = frame(spark, [row(i, t) for i, t in enumerate(tests)])
    model = ppm.fit(df, max_nodes=100)
    assert model.langs == ["hot", "rare"] and len(model.parts) > 3 and len(ppm.fit(df).parts) == 1
    for m in (model, ppm.fit(df)):
        got = ppm.predict(asked, m).orderBy("doc_id").collect()
        assert [r["lang_pred"] for r in got[:11]] == ["hot"] * 5 + ["rare"] * 6
        for r, text in zip(got, tests):
            assert r["bits_per_byte"] * len(text.encode()) == pytest.approx(min(ppm_bits(hot, text), ppm_bits(rare, text)), abs=1e-6)


def test_ppm_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_ppm_language"](spark, sf).where("held_out")
    both = got.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert both.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_trees_equal_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit_trees(x, y)
    got = trees.score(x)
    assert ((got > 0.5) == y).mean() > 0.97
    for r in range(0, 3000, 301):
        margin = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (1 if x[r, f[node]] <= t[node] else 2)
            margin += leaf[node - len(f)]
        assert got[r] == pytest.approx(1 / (1 + math.exp(-margin)))
    assert quality.fit_trees(x[:0], y[:0]).score(x[:2]) == pytest.approx([0.5, 0.5])
    assert quality.fit_trees(x[:100], np.ones(100)).score(x[:2]).min() > 0.9


def test_splits_are_the_best_of_all(monkeypatch):
    """Every split against a plain search over all features and bin edges, and every leaf's value."""
    monkeypatch.setattr(quality, "ROUNDS", 3)
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 4, 600), rng.normal(size=600) ** 3, np.zeros(600)])
    y = (x[:, 0] + (x[:, 1] == 2) + rng.normal(size=600) * 0.5 > 0.4).astype(float)
    trees = quality.fit_trees(x, y)
    inner = 2**quality.DEPTH - 1
    edges = [sorted({np.sort(x[:, f])[int(np.floor(q * (len(x) - 1)))] for q in np.linspace(0, 1, quality.BINS + 1)[1:-1]}) for f in range(x.shape[1])]

    def gain(rows, g, h, f, edge):
        low = rows[x[rows, f] <= edge]
        high = rows[x[rows, f] > edge]
        if min(len(low), len(high)) < quality.LEAST_LEAF:
            return -1.0
        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + quality.RIDGE)
        return score(low) + score(high) - score(rows)

    margin = np.full(len(y), trees.base)
    for t in range(3):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = {0: np.arange(len(y))}
        for node in range(inner):
            rows, f, edge = at[node], trees.feature[t, node], trees.threshold[t, node]
            best = max((gain(rows, g, h, k, e) for k in range(x.shape[1]) for e in edges[k]), default=-1.0)
            if np.isinf(edge):
                assert best <= 1e-6
            else:
                assert edge in edges[f] and gain(rows, g, h, f, edge) == pytest.approx(best, rel=1e-9)
            at[2 * node + 1], at[2 * node + 2] = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
        for k in range(2**quality.DEPTH):
            rows = at[inner + k]
            value = -quality.RATE * g[rows].sum() / (h[rows].sum() + quality.RIDGE)
            assert trees.leaf[t, k] == pytest.approx(value)
            margin[rows] += trees.leaf[t, k]


def test_statistics_of_odd_texts():
    s = quality.statistics(textarrays.texts(pa.array([None, "", " ", "Ab ab! 12 ##", "é" * 5])))
    assert np.isfinite(s).all() and (s[0] == s[1]).all() and (s[0] == 0).all()
    of = dict(zip(quality.FEATURES, s[3]))
    assert of["log_words"] == pytest.approx(math.log(5)) and of["symbols"] == pytest.approx(2 / 12) and of["unique_words"] == 1
    assert of["caps_words"] == 0.25 and of["digit_words"] == 0.25 and of["symbol_words"] == 0.25


def test_quality_on_held_out_and_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_trees"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    both = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert both.select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], "doc_id bigint, quality int")
    df = extra(frame(spark, odd_rows()), "score", "label", "log_bytes")
    model = quality.fit(df, labels)
    out = quality.score(df, model, keep=df.columns).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    empty = spark.createDataFrame([], DOCS)
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0
    assert quality.score(frame(spark, [row(1, "a")]), quality.fit(empty, labels.limit(0))).first()["score"] == 0.5
