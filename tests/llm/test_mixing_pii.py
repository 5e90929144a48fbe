import datetime
import hashlib
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, extra, frame, odd_rows, row, words
from tidewater.llm import mixing, pii
from tidewater.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})")
    assert Counter(map(tuple, df.select(cols).collect())) == Counter(rel.fetchall())


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Resharing in rounds, as the rule says it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        if not over:
            break
        for s in over:
            full[s] = float(cap * sizes[s])
            left -= full[s]
        open_ -= over
    return {s: full[s] if s in full else level * weight[s] for s in names}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 7}, {"a": 0, "b": 3}, {"a": 5}, {"a": 0}, {"z": 1, "é": 1, "Z": 500, "b": 20, "q": 20}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r["source"]: r for r in mixing.source_rates(df).collect()}
    for s, want in targets(sizes).items():
        assert got[s]["target"] == pytest.approx(want)
        assert got[s]["rate"] <= 3 and got[s]["source_size"] == sizes[s]


def test_mix_takes_near_the_targets(spark):
    rows = [row(i, "w " * (1 + i % 9), source=f"s{0 if i % 3 else i % 5}") for i in range(6000)]
    df = frame(spark, rows)
    plan = mixing.mix_plan(df, seed="t")
    per = plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.15 for r in per)
    assert plan.where("taken > 3 * size").count() == 0
    again = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(df.repartition(5), seed="t").collect()}
    assert {r["doc_id"]: r["copies"] for r in plan.collect()} == again
    mixed = Counter(r["doc_id"] for r in mixing.mix_sources(df, seed="t").collect())
    assert mixed == {i: c for i, c in again.items() if c}


def test_mix_of_odd_rows(spark):
    df = extra(frame(spark, odd_rows()), "size", "rate", "target", "__copies")
    got = mixing.mix_plan(df).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in odd_rows())
    mixed = mixing.mix_sources(df)
    assert mixed.columns == df.columns
    taken = Counter()
    for r in got:
        taken[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({k: v for k, v in taken.items() if v})
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix_sources(empty).count() == 0


def network(left, right, a, b, kind, key="k"):
    """The Feistel network, in plain Python."""
    for rnd in range(1, pii.ROUNDS + 1):
        h = hashlib.sha256(f"{key}|{kind}|{rnd}|{right}".encode()).hexdigest()
        left, right, a, b = right, (left + int(h[:15], 16)) % a, b, a
    return left, right


def digits(d, kind):
    u = len(d) // 2
    left, right = network(int(d[:u] or 0), int(d[u:]), 10**u, 10 ** (len(d) - u), kind)
    return (str(left).zfill(u) if u else "") + str(right).zfill(len(d) - u)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def hide(spark, *lines):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id bigint, text string")
    return [r["text"] for r in pii.pseudonymize(df, key="k").orderBy("doc_id").collect()]


def test_digits_are_permuted(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    got = dict(df.select("d", pii.permute_digits(F.col("d"), "k", "x")).collect())
    assert sorted(got.values()) == sorted(got) and sum(a == b for a, b in got.items()) < 20
    assert all(digits(d, "x") == v for d, v in got.items())


def test_cards(spark):
    good, bad = "4845168114407329", "4845168114407328"
    out = hide(spark, f"pay {good}, {bad} now", f"{good} {good}", "4845-1681-1440-7329", f"x{good} {good}y 1{good}")
    body = digits(good[:-1], "card")
    want = next(body + c for c in "0123456789" if luhn(body + c))
    assert out[0] == f"pay {want}, {bad} now" and out[1] == f"{want} {want}"
    assert out[2].replace("-", "") == want and out[2][4::5] == "---"
    assert out[3].startswith(f"x{good} {good}y ")


def test_other_kinds(spark):
    out = hide(
        spark, "call +1 (017) 555-7713!! or 017-555-7713", "ssn 123-45-6789 and 000-45-6789, 666-11-1111", "ip 97.51.17.173, 1.2.3.4.5, v999.1.1.1",
        "born 1985-03-07, 03/07/1985, 07.03.1985; 31/12/1999; 1985-02-30", "mail Pa.90@mail2.example.com", "iban DE89 3704 0044 0532 0130 00, DE88370400440532013000",
    )
    national = digits("0175557713", "phone")
    assert out[0] == f"call +1 ({national[:3]}) {national[3:6]}-{national[6:]}!! or {national[:3]}-{national[3:6]}-{national[6:]}"
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4} and 000-45-6789, 666-11-1111", out[1]) and "123-45-6789" not in out[1]
    left, right = network(97 * 256 + 51, 17 * 256 + 173, 65536, 65536, "ip")
    assert out[2] == f"ip {left // 256}.{left % 256}.{right // 256}.{right % 256}, 1.2.3.4.5, v999.1.1.1"
    days = re.findall(r"[\d/.-]{10}", out[3])
    day = datetime.date.fromisoformat(days[0])
    n = (datetime.date(1985, 3, 7) - datetime.date(1900, 1, 1)).days
    a, b = network(n // 4297, n % 4297, 17, 4297, "date")
    assert day == datetime.date(1900, 1, 1) + datetime.timedelta(a * 4297 + b)
    assert days[1] == day.strftime("%m/%d/%Y") and days[2] == day.strftime("%d.%m.%Y")
    assert datetime.datetime.strptime(days[3], "%d/%m/%Y") and days[4] == "1985-02-30"
    assert re.fullmatch(r"mail [A-Z][a-z]\.\d\d@mail2\.example\.com", out[4]) and "Pa.90" not in out[4]
    iban = out[5].split(",")[0][5:].replace(" ", "")
    assert iban != "DE89370400440532013000" and int(iban[4:] + "1314" + iban[2:4]) % 97 == 1
    assert out[5].endswith(", DE88370400440532013000")


def test_days_and_numbers_in_other_notations(spark):
    out = hide(
        spark, "2024-03-05 10:11", "2024-03-05T10:11:12Z", "2024-03-05Tuesday", "3/5/2024", "2024-3-5", "5.3.2024", "13/25/2024", "1.2.3.2024x",
        "+44 20 7946 0958", "+44-20-7946-0958!", "call 555 123 4567 8901", "call 555 123 4567 2 times", "+12 34", "a+44 20 7946 0958",
    )
    day = datetime.date.fromisoformat(out[0][:10])
    assert out[0] == f"{day} 10:11" and out[1] == f"{day}T10:11:12Z" and out[2] == "2024-03-05Tuesday" and day != datetime.date(2024, 3, 5)
    assert out[3] == f"{day.month}/{day.day}/{day.year}" and out[4] == f"{day.year}-{day.month}-{day.day}" and out[5] == f"{day.day}.{day.month}.{day.year}"
    assert out[6] == "13/25/2024" and out[7] == "1.2.3.2024x"
    moved = digits("2079460958", "phone")
    assert out[8] == f"+44 {moved[:2]} {moved[2:6]} {moved[6:]}" and out[9] == f"+44-{moved[:2]}-{moved[2:6]}-{moved[6:]}!"
    assert out[10] == "call 555 123 4567 8901" and out[11] != "call 555 123 4567 2 times" and out[11].endswith(" 2 times")
    assert out[12] == "+12 34" and out[13] == "a+44 20 7946 0958"


def test_the_key_comes_from_the_session(spark):
    with pytest.raises(TypeError):
        pii.pseudonymize(frame(spark, []))
    assert pii.session_key(spark) == pii.TEST_KEY
    spark.conf.set(pii.KEY_SETTING, "secret")
    try:
        assert pii.session_key(spark) == "secret"
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    a, b = (pii.pseudonymize(frame(spark, [row(1, "97.51.17.173")]), key=k).first()["text"] for k in ("secret", pii.TEST_KEY))
    assert a != b


def iban_check(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_ibans_end_at_their_country_s_length(spark):
    ibans = ["NO93 8601 1117 947", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00"]
    after = ["BIC", "1332", "I paid", "A", "2024", "ABCD 1234"]
    assert all(iban_check(i) == 1 for i in ibans)
    shown = [(i, a) for i in ibans for a in after]
    out = hide(spark, *[f"to {i} {a}" for i, a in shown], *[f"to {i.replace(' ', '')} {a}" for i, a in shown])
    for (old, a), wide, narrow in zip(shown, out, out[len(shown) :]):
        new = wide.removeprefix("to ").removesuffix(f" {a}")
        assert len(new) == len(old) and new[:2] == old[:2] and new != old and iban_check(new) == 1, (old, a)
        assert wide == f"to {new} {a}" and narrow == f"to {new.replace(' ', '')} {a}"


def test_what_only_looks_like_an_iban_hides_nothing(spark):
    card, day, iban = "4845168114407329", "1985-03-07", "DE89 3704 0044 0532 0130 00"
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    new = dict(zip((card, spaced, day, iban), hide(spark, card, spaced, day, iban)))
    assert all(old != value for old, value in new.items())
    texts = ["XX12 {card}", "XX12 {spaced}", "BE12 {spaced}", "DE12 {spaced} {day}", "AT12 3456 7890 {iban}", "QQ12 3456 7890 {iban}, {iban}"]
    fill = lambda t, by: t.format(card=by(card), spaced=by(spaced), day=by(day), iban=by(iban))
    assert hide(spark, *[fill(t, str) for t in texts]) == [fill(t, new.get) for t in texts]
    assert "DE89370400440532013000" not in hide(spark, "DE89370400440532013000@bank.org")[0]


def test_text_around_is_untouched_and_odd_rows_pass(spark):
    rows = [*odd_rows(), row(20, "$1 \\1 97.51.17.173$2\n\n4845168114407329\n"), row(21, "12 March 2.0 @ home a@b 4845168114407329@x.org")]
    df = extra(frame(spark, rows), "__pii", "found")
    out = pii.pseudonymize(df, key=pii.TEST_KEY, found_col="replaced")
    assert out.columns == [*df.columns, "replaced"]
    for r in out.collect():
        old = next(x[1] for x in rows if x[0] == r["doc_id"])
        text = r["text"]
        for f in r["replaced"] or []:
            assert f["value"] in old and f["pseudonym"] in text
        if not r["replaced"]:
            assert text == old
        else:
            gaps = lambda s, vs: re.split("|".join(map(re.escape, vs)), s)
            assert gaps(text, [f["pseudonym"] for f in r["replaced"]]) == gaps(old, [f["value"] for f in r["replaced"]])
    assert pii.pseudonymize(spark.createDataFrame([], DOCS), key=pii.TEST_KEY).count() == 0


def test_query_ten_replaces_all_planted_values(spark):
    got = {r["doc_id"]: r["text"] for r in QUERIES["op10_pseudonyms"](spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        text = r["text"] or ""
        private = [c for c in re.findall(r"(?<!\w)\d{16}(?!\w)", text) if luhn(c)]
        private += re.findall(r"\+1 \(\d{3}\) 555-\d{4}", text) + re.findall(r"(?<![\w.])\d+\.\d+\.\d+\.\d+", text) + re.findall(r"[\w.]+@mail\d\.example\.com", text)
        assert not [p for p in private if p in got[r["doc_id"]]]
        if not re.search("[0-9@]", text):
            assert got[r["doc_id"]] == r["text"]
