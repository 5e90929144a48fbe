"""Compatibility with the formats the delivery tools write (Python stdlib)."""

import csv
import gzip
import io
import json
import random

from pyspark.sql import functions as F

from tidewater import drop_blank_lines, encode_csv_line, read_staged_csv, read_staged_json

ALPHABET = ['a', 'b', ' ', '\t', ',', '"', '\r', '\n', ' ', '　', '\x1c', 'é', "'"]


def _rand_text(r, n):
    return "".join(r.choice(ALPHABET) for _ in range(r.randint(0, n)))


def test_reads_multi_member_gzip_with_leading_blank_lines(spark, tmp_path):
    d = tmp_path / "buf"
    d.mkdir()
    events = [{"id": i, "msg": f"m{i}", "nested": {"x": [i, None]}} for i in range(20)]
    path = d / "ingest-20240101-000000.json.gz"
    for ev in events:  # one gzip member per event, each starting with a newline
        with gzip.open(path, "ab") as f:
            f.write(b"\n")
            f.write(json.dumps(ev).encode("utf-8"))
    (d / "ignored.txt").write_text("not staged")
    df = read_staged_json(spark, str(d), "id BIGINT, msg STRING, nested STRUCT<x: ARRAY<BIGINT>>")
    got = sorted((r.id, r.msg, list(r.nested.x)) for r in df.collect())
    assert got == [(i, f"m{i}", [i, None]) for i in range(20)]


def test_reads_csv_written_by_python_csv_module(spark, tmp_path):
    r = random.Random(5)
    lines = [t for t in (_rand_text(r, 12) for _ in range(300)) if t.strip() and "\r" not in t and "\n" not in t]
    lines += ['a,"b"', '"', "  lead", "x,y"]
    d = tmp_path / "buf"
    d.mkdir()
    with open(d / "ingest-20240101-000000.csv", "w", newline="") as f:
        w = csv.writer(f)  # default dialect: minimal quoting, \r\n line ends
        for line in lines:
            w.writerow([line])
    back = sorted(r.line for r in read_staged_csv(spark, str(d), "line STRING").collect())
    assert back == sorted(lines)


def test_encode_csv_line_matches_csv_writer(spark):
    r = random.Random(11)
    values = [_rand_text(r, 8) for _ in range(2000)] + ["", '"', ",", "\r", "\n", "plain"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [row[0] for row in df.select(encode_csv_line("v")).collect()]
    for v, g in zip(values, got):
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow([v])
        assert g == buf.getvalue(), repr(v)


def test_drop_blank_lines_matches_python(spark):
    r = random.Random(13)
    texts = [_rand_text(r, 60).replace("\r", "") for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = drop_blank_lines(df, "t").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("ls")
    )
    got = {row.id: [x.line for x in row.ls] for row in out.collect()}
    for i, t in enumerate(texts):
        want = [line for line in t.split("\n") if line.strip()]
        assert got.get(i, []) == want, repr(t)
