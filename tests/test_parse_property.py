"""P2 parity: strict parses agree with the producer's int()/float() on ASCII text."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capture_lake.functions.metadata import parse_double, parse_int

ALPHABET = "0123456789_.eE+- \t\n\x0b\x0c\r\x1cinfatyINFATY"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=50, max_size=50)


def py_int(s):
    try:
        v = int(s)
    except ValueError:
        return None
    return v if -(2**31) <= v < 2**31 else None


def py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_parse_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", "s", parse_int(F.col("s")).alias("n"), parse_double(F.col("s")).alias("d")).collect()
    for r in rows:
        assert same(r.n, py_int(r.s)), (repr(r.s), r.n, py_int(r.s))
        assert same(r.d, py_float(r.s)), (repr(r.s), r.d, py_float(r.s))


def test_known_corner_cases(spark):
    cases = ["1.e5", "+inf", "-nan", "NaN", "Infinity", "1e1_0", "0012", "-0", "\x1c7\x1c", "1_", "_1", ".", "e1",
             "1e", "--1", "+-1", "1 2", "inF", "infinit", "2147483648", "-2147483648"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    rows = df.select("s", parse_int(F.col("s")).alias("n"), parse_double(F.col("s")).alias("d")).collect()
    for r in rows:
        assert same(r.n, py_int(r.s)), (repr(r.s), r.n, py_int(r.s))
        assert same(r.d, py_float(r.s)), (repr(r.s), r.d, py_float(r.s))


PAGE_ALPHABET = "ab-\n" + "".join(chr(c) for c in range(0x09, 0x0E)) + "\x1c\x1d\x1e\x1f \x85\xa0   ​    　﻿"
pages = st.lists(st.lists(st.one_of(st.none(), st.text(alphabet=PAGE_ALPHABET, max_size=5)), max_size=4),
                 min_size=30, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(pages)
def test_page_assembly_matches_python(spark, docs):
    from capture_lake.functions.text import join_pages

    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, pages array<string>")
    got = {r.i: r.t for r in df.select("i", join_pages(F.col("pages")).alias("t")).collect()}
    for i, d in enumerate(docs):
        assert got[i] == "\n---\n".join(p for p in d if p).strip(), (d, got[i])
