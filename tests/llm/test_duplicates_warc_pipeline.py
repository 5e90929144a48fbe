import base64
import gzip
import hashlib
import html
import itertools
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DOCS, Groups, extra, frame, odd_rows, row, words
from tidewater.llm import components, jaccard, multi_index, pii, textarrays, warc
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 470)] + [(7, 7), (3, 9), (9, 3)]
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    rng.shuffle(links)
    groups = Groups({x for link in links for x in link})
    for a, b in links:
        groups.join(a, b)
    got = dict(components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {i: groups.find(i) for i in groups.up if i in got} and set(got) == {x for a, b in links if a != b for x in (a, b)}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(n=260, dim=10, seed=1):
    """Random vectors, near copies around some of them, exact copies, and useless ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((i, rng.normal(size=dim).tolist(), i % 3))
    for i in range(n, n + 120):
        base = np.array(rows[i % 5][1])
        rows.append((i, (base + rng.normal(size=dim) * 0.12).tolist(), rows[i % 5][2]))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * dim, 1), (2002, [float("nan")] + [1.0] * (dim - 1), 1), (2003, [None] + [1.0] * (dim - 1), 1)]
    rows += [(2004, [float("inf")] * dim, 1), (2005, rows[7][1], None), (2006, rows[7][1][:4], rows[7][2]), (None, rows[7][1], rows[7][2]), (2007, [], 1)]
    rows += [(2008, [1e200 * x for x in rows[7][1]], rows[7][2]), (2009, [-0.0, 1.0], 0), (2010, [0.0, 1.0], 0)]
    rng.shuffle(rows)
    return [(None if a is None else int(a), b, None if c is None else int(c)) for a, b, c in rows]


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "LEAST_BLOCK", 16)
    monkeypatch.setattr(multi_index, "MOST_BLOCK", 16)  # several blocks a cell
    rows = vectors()
    df = extra(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), "n_links", "node", "cell")
    got = {r["vec_id"]: r for r in multi_index.near_duplicates(df).collect()}
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links, groups = Counter(), Groups([r[0] for r in rows if r[0] is not None])
    for a, b in itertools.combinations(ok, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = (multi_index.unit_rows(np.array([v])) for v in (a[1], b[1]))
            if (x @ y.T).item() >= 0.98:
                links[a[0]] += 1
                links[b[0]] += 1
                groups.join(a[0], b[0])
    assert len(got) == len(rows) and sum(links.values()) > 2000
    for i, r in got.items():
        want = None if i is None else groups.find(i)
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], want, i == want), i
    assert multi_index.near_duplicates(df.where("false")).count() == 0


def test_traversal_visits_cells_in_order():
    x = multi_index.unit_rows(np.random.default_rng(0).normal(size=(300, 8)))
    index = multi_index.fit(x, np.zeros(300), 6, 0.98)
    one, two = index.bounds(x[:20])
    for a, b in zip(one[1], two[1]):
        seen = index.visits(a, b)
        cost = [a[i] + b[j] for i, j in seen]
        assert cost == sorted(cost)
        assert set(seen) == {(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] + b[j] <= index.reach}
    # the distance to a cell never exceeds the distance to a vector in it
    near = index.bounds(x)[0][0]
    part = multi_index.halves(x)[0]
    for i in range(20):
        assert (one[1][i][near] <= ((part - part[i]) ** 2).sum(1) + 1e-9).all()


def shingle_set(text, size):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_rows(seed=8):
    """Texts with near copies of several distances, a large group of them, shared passages and copies."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(30)
    texts = [fresh(rng.randint(1, 160)) + (passage if i % 4 == 0 else []) for i in range(60)]
    for _ in range(150):
        t = list(rng.choice(texts[:3] + texts[40:44]))
        for _ in range(rng.randint(0, max(1, len(t) // 40))):
            t[rng.randrange(len(t))] = f"n{rng.randrange(10**6)}"
        texts.append(t)
    texts += [texts[5]] * 30 + [[w.upper() for w in texts[5]]]
    return [row(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 50)])
def test_text_links_equal_brute_force(spark, monkeypatch, size, percent):
    monkeypatch.setattr(jaccard, "LEAST_BLOCK", 8)
    monkeypatch.setattr(jaccard, "MOST_BLOCK", 8)  # several blocks a neighbourhood
    rows = [*[(i and i + 1000, *rest) for i, *rest in odd_rows() if i != 6], *near_rows()]
    rows = rows[:1] + rows[2:]
    df = extra(frame(spark, rows), "n", "s1", "node", "near", "component")
    got = {r["doc_id"]: r for r in jaccard.jaccard_join(df, size=size, percent=percent).collect() if r["doc_id"] is not None}
    sets = {r[0]: shingle_set(r[1], size) for r in rows if r[0] is not None}
    links, groups = Counter(), Groups(sets)
    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            links[a] += 1
            links[b] += 1
            groups.join(a, b)
    assert len(got) == len(sets) and sum(links.values()) > 500
    for i, r in got.items():
        assert (r["n_shingles"], r["n_links"], r["component_id"]) == (len(sets[i]), links[i], groups.find(i)), i
    assert jaccard.jaccard_join(df.where("false")).count() == 0


def test_rows_without_an_id_and_repeated_rows(spark):
    df = frame(spark, [*odd_rows(), row(11, "one two")])
    got = Counter((r["doc_id"], r["component_id"], r["n_links"]) for r in jaccard.jaccard_join(df).collect())
    assert got[(None, None, 0)] == 2 and got[(1, 1, 1)] == 2  # the repeated row links with its copy
    assert got[(9, 9, 2)] == got[(10, 9, 2)] == got[(11, 9, 2)] == 1
    assert got[(7, 7, 1)] == got[(8, 7, 1)] == 1  # x and X


@pytest.mark.parametrize("light", [0, 64])
def test_texts_of_one_id_and_size_keep_their_links(spark, monkeypatch, light):
    monkeypatch.setattr(jaccard, "LIGHT", light)
    a, b = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    rows = [row(5, a), row(5, b), row(7, a + " end"), row(9, b + " end"), row(11, "z " + a), row(20, "other words that link with nothing at all")]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_join(frame(spark, rows), size=3, percent=90).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 5), (20, 20)}


def test_a_chain_of_windows_makes_no_large_neighbourhood(spark, monkeypatch):
    rng = random.Random(6)
    seq = [f"w{rng.randrange(4000)}" for _ in range(1500)]
    rows = [row(i, " ".join(seq[i : i + 12])) for i in range(len(seq) - 12)]
    seen, real = [], jaccard._verify

    def verify(rows_, near, *rest):
        seen.append([r["c"] for r in near.groupBy("near").agg(F.count("*").alias("c")).collect()])
        return real(rows_, near, *rest)

    monkeypatch.setattr(jaccard, "_verify", verify)
    got = jaccard.jaccard_join(frame(spark, rows), size=3, percent=90).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and max(seen[0], default=0) < 100


def test_shared_values_are_counted():
    rng = np.random.default_rng(1)
    sets = [rng.choice(300, rng.integers(1, 200), replace=False) for _ in range(20)]
    got = jaccard.common_counts(np.concatenate(sets), np.repeat(np.arange(20), [len(s) for s in sets]), 20, width=64)
    for a, b in itertools.permutations(range(20), 2):
        assert got[a, b] == len(set(sets[a].tolist()) & set(sets[b].tolist()))


def test_warc_digests_and_references(spark):
    raw = "Tom &amp; J &lt;b&gt; &#233;&#x1F600; &nbsp;&nosuch; &#0; &amp;lt;"
    df = spark.createDataFrame([(1, "http://a/", f"<html><head><title>T &amp; t</title><style>p{{}}</style></head><body><!-- x > y --><p>{raw}<br>two<script>if (a<b) c()</script></p></body>"), (2, None, None), (3, "u", ""), (1, "http://a/", "same"), (1, "http://a/", "same")], "page_id int, url string, html string")
    df = df.withColumn("record", F.lit("mine"))
    got = warc.derive(warc.responses_from_pages(df), keep=["page_id"]).collect()
    assert len(got) == 10
    text = next(r for r in got if r["page_id"] == 1 and r["warc_type"] == "conversion" and "Tom" in r["block"])
    assert text["block"] == "T & t\nTom & J <b> é\U0001f600  &nosuch; &#0; &lt;\ntwo"
    for r in got:
        block = r["block"].encode()
        assert r["content_length"] == len(block)
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        other = next(x for x in got if x["record_id"] == r["concurrent_to"])
        assert other["refers_to"] == r["refers_to"] and other["warc_type"] != r["warc_type"]
        head, _, body = r["record"].partition("\r\n\r\n")
        assert body == r["block"] and f"WARC-Refers-To: {r['refers_to']}" in head and head.startswith("WARC/1.1\r\n")
        assert ("WARC-Target-URI" in head) == (r["target_uri"] is not None)
    meta = next(r for r in got if r["refers_to"] == text["refers_to"] and r["warc_type"] == "metadata")
    assert f"source-payload-digest: {text['payload_digest']}\r\n" in meta["block"] and "title: T & t\r\n" in meta["block"]
    assert "source-header: Content-Type: text/html; charset=utf-8\r\n" in meta["block"]
    assert warc.derive(warc.responses_from_pages(df.where("false"))).count() == 0


def test_the_linear_forms_equal_the_plain_patterns(spark):
    """What the SQL twin says with patterns that search to the end of the page from every opener."""
    rng = random.Random(3)
    bits = ["<!--", "-->", "<script>", "</script>", "<SCRIPT x='", "'>", "</sCript", "<style", "</style>", "<noscript>", "</noscript  >", "<template", "</template>", "<scripty>", "<", ">", "<a href="]
    bits += ["</p>", "<br>", "<p ", "<div ", "text", "&amp;", "&am", "p;", " ", "\n", " \n ", "<!", "<!-->", "<title>", "<title", "</title", "\ufdd0", "é", "<b> ", "<?x"]
    df = spark.createDataFrame([("".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))),) for _ in range(3000)], "html string")
    html = F.col("html")
    plain = F.regexp_replace(F.regexp_replace(html, warc.BLANKS, " "), warc.BREAKS, "\n")
    plain = F.btrim(F.regexp_replace(warc.unescape(F.regexp_replace(plain, warc.UNSEEN, "")), warc.LINES, "\n"), F.lit(" \n"))
    title = F.regexp_extract(html, "(?is)<title[^>]*>([^<]*)</title", 1)
    out = df.select("html", (warc.plain_text(html) == plain).alias("text"), (F.regexp_extract(html, warc.TITLE, 1) == title).alias("title"))
    assert out.where("NOT (text AND title)").collect() == []


def test_the_steps_of_the_text_equal_their_patterns(spark):
    """Blanks and line ends with one test a character, and more openers than are searched without marks."""
    rng = random.Random(5)
    rows = [("".join(rng.choice("\t\n\x0b\x0c\r   a") for _ in range(rng.randrange(30))), "".join(rng.choice("\n\n   a") for _ in range(rng.randrange(30)))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "x string, y string")
    blanks = F.regexp_replace("x", warc.BLANKS_ONCE, " ") == F.regexp_replace("x", warc.BLANKS, " ")
    lines = F.regexp_replace("y", warc.LINES_ONCE, "\n") == F.regexp_replace("y", warc.LINES, "\n")
    assert df.where(~blanks | ~lines).count() == 0
    bits = ["<!--", "<script>", "</script>", "-->", "<STYLE ", "<template>", "x", ">", "<b>", "</style>"]
    pages = spark.createDataFrame([("".join(rng.choice(bits) for _ in range(n)),) for n in (*range(20, 80), *range(200, 260))], "html string")
    plain = F.btrim(F.regexp_replace("html", warc.UNSEEN, ""), F.lit(" \n"))
    assert pages.where(F.regexp_count("html", F.lit(warc.OPENERS)) > warc.FEW).count() > 60
    assert pages.where(warc.plain_text(F.col("html")) != plain).collect() == []


def test_hostile_pages_take_linear_time(spark):
    import time

    for bit in ("<!--", "<script>", "<a", "<title ", "<b> "):
        pages = spark.createDataFrame([(1, "u", bit * (1_000_000 // len(bit)) + end) for end in ("", ">")], "page_id int, url string, html string")
        began = time.time()
        assert warc.derive(warc.responses_from_pages(pages)).agg(F.sum("content_length")).first()[0] > 0
        assert time.time() - began < 30, bit


def test_warc_entities_are_html():
    assert {k: html.unescape(f"&{k};").replace("\xa0", " ") for k in warc.ENTITIES} == warc.ENTITIES


def test_warc_files_can_be_read_back(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(20)
    records = warc.derive(warc.responses_from_pages(pages)).coalesce(1)
    warc.write(records, str(tmp_path / "w"))
    data = b"".join(gzip.open(p).read() for p in Path(tmp_path / "w").glob("*.gz"))
    seen = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        seen.append(rest[:n].decode())
        assert rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
    assert Counter(seen) == Counter(r["block"] for r in records.collect())


def test_pipeline_stages(spark):
    """Every stage against a plain version of its rule, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pseudonyms", "mixing", "segmentations"]
    kept = corpus_pipeline.keep_quality(spark, docs, SF).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    low = lambda df: df.join(labels.where("quality = 0"), "doc_id").count()
    assert kept.columns == docs.columns and low(kept) < 0.5 * low(docs)
    assert kept.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * docs.join(labels.where("quality = 1"), "doc_id").count()

    apart = corpus_pipeline.drop_near_duplicates(spark, kept, SF).cache()
    sets = {r["doc_id"]: shingle_set(r["text"], 5) for r in kept.collect()}
    groups = Groups(sets)
    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            groups.join(a, b)
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(i for i in sets if groups.find(i) == i)

    hidden = corpus_pipeline.hide_personal(spark, apart, SF).cache()
    plain = {r["doc_id"]: r["text"] for r in pii.pseudonymize(apart, key=pii.TEST_KEY).collect()}
    assert hidden.columns == docs.columns and {r["doc_id"]: (r["text"], r["n_chars"]) for r in hidden.collect()} == {i: (t, len(t)) for i, t in plain.items()}

    mixed = corpus_pipeline.mix(spark, hidden, SF).cache()
    assert mixed.columns == docs.columns
    per = Counter(tuple(r) for r in mixed.collect())
    assert set(per) <= {tuple(r) for r in hidden.collect()} and max(per.values()) <= 3

    last = corpus_pipeline.tokenize(spark, mixed, SF)
    assert last.where("NOT round_trip").count() == 0
    assert last.where("sample = 0").count() == mixed.count()


def test_pipeline_stages_on_odd_rows(spark):
    df = extra(frame(spark, odd_rows()), "score", "component_id", "found", "rate", "sample")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.count() <= 3 * df.count(), name
        assert stage(spark, df.where("false"), SF).count() == 0, name
    last = corpus_pipeline.tokenize(spark, df, SF)
    assert last.where("text IS NULL").count() if "text" in last.columns else last.where("n_pieces IS NULL").count() == 1
    one = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert Counter(r["doc_id"] for r in one.collect()) == Counter([1, 2, 3, 4, None, 5, 6, 7, 9])


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    df = frame(spark, [row(1, a), row(5, a + " end"), row(5, b), row(5, b), row(7, b + " end"), row(8, "alone"), row(None, a)])
    got = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(1, a), (5, b), (8, "alone"), (None, a)])


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sample", "pieces", "log_inclusion"} <= set(out.columns)


def test_all_texts_of_the_column_types(spark):
    """Large string columns (64-bit offsets) work like plain ones."""
    t = textarrays.texts(pa.array(["ab", None, "c d"], pa.large_string()))
    assert t.n == 3 and bytes(t.data) == b"abc d"


def test_queries_two_and_six_run(spark):
    for name in ("op2_multi_index", "op6_grouped_prefix_join"):
        assert QUERIES[name](spark, SF).count() > 0
    assert frame(spark, []).schema == DOCS
