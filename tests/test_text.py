import sys

from pyspark.sql import functions as F

from tidewater.functions.text import is_blank, py_strip


def _all_bmp():
    return [chr(c) for c in range(0x10000) if not (0xD800 <= c <= 0xDFFF)]


def test_py_strip_matches_python_on_every_bmp_char(spark):
    chars = _all_bmp()
    rows = [(c + "x" + c + c,) for c in chars]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    want = [r[0].strip() for r in rows]
    assert got == want


def test_is_blank_matches_python(spark):
    chars = _all_bmp()
    rows = [(c * 2,) for c in chars] + [("",), (" a ",), ("\t\n",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(is_blank("s")).collect()]
    want = [r[0].strip() == "" for r in rows]
    assert got == want


def test_trim_is_not_strip(spark):
    """Negative control: Spark's trim is not Python's strip."""
    df = spark.createDataFrame([("\t a  ",)], "s string")
    trimmed, stripped = df.select(F.trim("s"), py_strip("s")).first()
    assert stripped == "a"
    assert trimmed != "a"
