"""Scalar functions against Python's own parsing/formatting (reference T13 cases + edges)."""
import math
import re
from datetime import datetime

from qualis.functions import parse as P

DATE_FORMATS = ["%Y-%m-%d", "%d.%m.%Y", "%Y/%m/%d", "%d-%m-%Y"]


def py_date(v):
    if v is None:
        return None
    s = str(v).strip()
    for f in DATE_FORMATS:
        try:
            return datetime.strptime(s, f).date()
        except ValueError:
            continue
    return None


def py_iso(v):
    if v is None or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", v):
        return False
    try:
        datetime.strptime(v, "%Y-%m-%d")
        return True
    except ValueError:
        return False


def py_float(v):
    if v is None:
        return None
    try:
        return float(str(v))
    except ValueError:
        return None


DATES = ["2024-01-05", "2024-1-5", "2024-02-30", " 2024-01-05", "15.03.2024", "garbage", "2024/03/15",
         "05-03-2024", "2024-01- 5", "1.1.2024", "0000-01-01", "2024-13-01", "31.04.2024", "2024-01-05\n",
         "\t2024-01-05 ", "29.02.2023", "29.02.2024", "2024-001-01", "1990-02-30", "5-3-2024", "2024/3/5",
         " 2024-01-05\x85", "20x4-01-05", None]
NUMS = ["69.29", "-5", "1,5", None, "1_000", "nan", "-inf", "Infinity", "1e5", ".5", "1.", "abc", "1.5d", "1f",
        " 7 ", "+3", "1__0", "_1", "0x10", "-0", "1e-7", "NaN", "inf ", "1e", ".", "e5", "+-1", "1.e5", "",
        "\x1c7", "7\x85", "1_0.5", "1._5", "400", "-12.50", "0.75", "0,5"]
FLOATS = [0.0, -0.0, 1.0, 0.5, -5.0, 1234567.0, 0.0001, 0.00001234, 123456.0, 999999.5, 1e16, -12.5, 0.75,
          1 / 3, 100.0, 2.5e-5, float("nan"), float("inf"), -float("inf"), 401.0, 0.1, 250.0]


def test_parse_date_and_iso_match_python(spark):
    df = spark.createDataFrame([(x,) for x in DATES], "v string")
    for r in df.select("v", P.parse_date("v").alias("p"), P.is_iso_date("v").alias("i")).collect():
        assert r.p == py_date(r.v), r.v
        assert bool(r.i) == py_iso(r.v), r.v


def test_parse_float_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in NUMS], "v string")
    for r in df.select("v", P.parse_float("v").alias("f")).collect():
        e = py_float(r.v)
        if e is None:
            assert r.f is None, r.v
        elif math.isnan(e):
            assert math.isnan(r.f), r.v
        else:
            assert r.f == e, r.v


def test_fmt_g_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in FLOATS], "v double")
    for r in df.select("v", P.fmt_g("v").alias("s")).collect():
        assert r.s == f"{r.v:g}", r.v


def test_error_id_padding(spark):
    df = spark.createDataFrame([(1,), (99999,), (100000,), (1234567,)], "n long")
    assert [r[0] for r in df.select(P.error_id("n")).collect()] == ["E00001", "E99999", "E100000", "E1234567"]


def test_round_half_up_and_cents(spark):
    df = spark.createDataFrame([(90.5, 0.125), (89.49, 2.675), (0.5, 1.005)], "x double, y double")
    rows = df.select(P.round_half_up("x").alias("a"), P.round_cents("y").alias("b")).collect()
    assert [r.a for r in rows] == [91, 89, 1]
    import numpy as np
    assert [r.b for r in rows] == [float(np.round(y, 2)) for y in (0.125, 2.675, 1.005)]


def test_fmt_g_of_ties_and_many_doubles(spark):
    import random
    import struct
    rng = random.Random(4)
    values = [(rng.randrange(100000, 1000000) * 10 + 5) / 10 ** k for k in range(0, 20) for _ in range(150)]
    values += [(rng.randrange(100000, 1000000) * 10 + 5) * 10.0 ** k for k in range(0, 20) for _ in range(100)]
    values += [0.5, 1.5, 2.5, 0.125, 999999.5, 9999995.0, 99999.95, 100000.5, 100001.5, 1e22, -1234565.0, 1.7976931348623157e308]
    while len(values) < 100_000:
        x = struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0]
        values += [x, rng.uniform(-1e7, 1e7), round(rng.uniform(0, 1e4), rng.randrange(8))]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    bad = [(r.v, r.s, format(r.v, "g")) for r in df.select("v", P.fmt_g("v").alias("s")).collect() if r.s != format(r.v, "g")]
    assert not bad, (len(bad), bad[:5])


def test_unicode_digits_match_python(spark):
    texts = ["\u0661\u0662", "\uff11\uff12.\uff15", "1\u0665_0", "\U0001d7d8\U0001d7d9", "\u00b2", "\u0661e\u0662", "-\u0967", "\u0661,5",
             "\u06f2\u06f0\u06f2\u06f4-01-05", "\u06f2\u06f0\u06f2\u06f4-\u06f0\u06f1-05", "2024-01-2\u0665", "2024-01-\u0662\u0665",
             "2\u0665.03.2024", "202\u0664/1/5", "\u0660\u0660\u0660\u0660-01-05", "1\u0665-3-\uff12\uff10\uff12\uff14", "\u0662024-02-30"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", P.parse_date("v").alias("d"), P.is_iso_date("v").alias("i"), P.parse_float("v").alias("f")).collect()
    for r in got:
        assert (r.v, r.d, bool(r.i), r.f) == (r.v, py_date(r.v), py_iso(r.v), py_float(r.v))
