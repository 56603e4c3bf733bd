"""Column functions against small pure-Python models (hypothesis + edge rows)."""

import math
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotmarket.functions import core as fx


def _col(spark, values, t="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {t}")


def _py_cut(x, edges, labels):
    if x is None:
        return None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if x > lo and (hi is None or x <= hi):
            return labels[i]
    return None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-5, 200, allow_nan=False)), min_size=1, max_size=30))
def test_bins_right_closed_like_pd_cut(spark, values):
    edges, labels = [-1, 1, 10, None], ["own", "small", "inst"]
    df = _col(spark, values)
    got = {r.i: r.b for r in df.select("i", fx.bin_right_closed("v", edges, labels).alias("b")).collect()}
    for i, v in enumerate(values):
        assert got[i] == _py_cut(v, edges, labels)


def test_bin_edges_fixture(spark):
    # CV exactly 0, 80, 120: 0 is outside, 80 low, 120 medium
    vals = [0.0, 80.0, 80.01, 120.0, 120.5, None]
    df = _col(spark, vals)
    got = [r.b for r in df.orderBy("i").select(fx.bin_right_closed("v", [0, 80, 120, None],
                                                                     ["low", "medium", "high"]).alias("b")).collect()]
    assert got == [None, "low", "medium", "medium", "high", None]


def test_equal_width_bin_right_closed(spark):
    df = _col(spark, [100.0, 100.5, 300.0, 301.0, 4100.0, 4100.5])
    got = [r.b for r in df.orderBy("i").select(fx.equal_width_bin("v", 100, 200, 20).alias("b")).collect()]
    assert got == [None, 1, 1, 2, 20, None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=20))
def test_clip_keeps_null(spark, values):
    df = _col(spark, values)
    got = {r.i: r.c for r in df.select("i", fx.clip("v", 0.0, 200.0).alias("c")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (None if v is None else min(max(v, 0.0), 200.0))


def test_round_half_even_like_numpy(spark):
    import numpy as np
    vals = [0.125, 2.5, 3.5, 2469.885, 8375.165, -0.125, 1.005]
    df = _col(spark, vals)
    got2 = [r.r for r in df.orderBy("i").select(fx.round_half_even("v", 2).alias("r")).collect()]
    assert got2 == [float(np.round(v, 2)) for v in vals]
    got0 = [r.r for r in df.orderBy("i").select(fx.round_half_even("v", 0).alias("r")).collect()]
    assert got0 == [float(np.round(v, 0)) for v in vals]


# Latin-1 letters, digits, blanks and punctuation.  Left out: characters whose
# title case is several characters in Python ('ß' -> 'Ss') and letters newer
# than the JVM's Unicode tables.
TITLE_ALPHABET = st.characters(min_codepoint=0x20, max_codepoint=0xFF, whitelist_categories=("Lu", "Ll", "Nd", "Zs", "Po", "Pd"),
                               blacklist_characters="\u00df")


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=TITLE_ALPHABET, max_size=30))
def test_title_case_matches_python(spark, s):
    df = spark.createDataFrame([(s,)], "v string")
    assert df.select(fx.title_case("v").alias("t")).first().t == s.title()


def test_title_case_fixture(spark):
    df = spark.createDataFrame([("133-12 o'neil ST/WEST",), (None,)], "v string")
    got = [r.t for r in df.select(fx.title_case("v").alias("t")).collect()]
    assert got == ["133-12 O'Neil St/West", None]


@settings(max_examples=25, deadline=None)
@given(st.text(max_size=40))
def test_adler32_matches_zlib(spark, s):
    df = spark.createDataFrame([(s,)], "v string")
    assert df.select(fx.adler32("v").alias("h")).first().h == zlib.adler32(s.encode("utf-8"))


def test_adler32_known_value(spark):
    df = spark.createDataFrame([("BATHGATE",)], "v string")
    assert df.select(fx.adler32("v").alias("h")).first().h == 168493633


NUMBER_CASES = [
    # text, lenient (a), units (b), cut (c)
    ("1,664,862", 1664862.0, 1664862.0, 1664862.0),
    ("USD 62,098", 62098.0, 62098.0, 62098.0),
    ("38.9 yrs", 38.9, 38.9, 38.9),
    ("11.2%", 11.2, 11.2, 11.2),
    ("$2,212", 2212.0, 2212.0, 2212.0),
    ("137 per 100k", 137.0, 137.0, 137.0),
    ("N/A", 0.0, None, None),
    ("2025 (NYPD Q1-Q4)", 2025.0, None, None),
    ("7.8", 7.8, 7.8, 7.8),
    ("", 0.0, None, None),
]


@pytest.mark.parametrize("text,a,b,c", NUMBER_CASES)
def test_parse_numbers(spark, text, a, b, c):
    df = spark.createDataFrame([(text,)], "v string")
    r = df.select(fx.parse_number_lenient("v").alias("a"), fx.parse_number_units("v").alias("b"),
                  fx.parse_number_cut("v").alias("c")).first()
    assert (r.a, r.b, r.c) == (a, b, c)


def test_parse_date_day_first(spark):
    import datetime as dt
    vals = ["13/02/2025", "02/03/2025", "2025-03-02", "2025-03-02 00:00:00", "abc", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.d for r in df.orderBy("i").select(fx.parse_date("v", day_first=True).alias("d")).collect()]
    assert got == [dt.date(2025, 2, 13), dt.date(2025, 3, 2), dt.date(2025, 3, 2), dt.date(2025, 3, 2), None, None]


def test_guarded_ratio_and_scale(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 2.0), (5.0, -1.0)], "a double, b double")
    got = [r.x for r in df.select(fx.guarded_ratio("a", "b").alias("x")).collect()]
    assert got == [None, 2.5, None, None]
    s = spark.createDataFrame([(None,), (0.0,), (7500.0,), (20000.0,)], "v double")
    got = [r.x for r in s.select(fx.scale_anchors("v", 0, 15000).alias("x")).collect()]
    assert got == [0.5, 1.0, 0.5, 0.0]


def test_safe_int_and_code_text(spark):
    df = spark.createDataFrame([("12.9",), ("-3.7",), ("abc",), (None,)], "v string")
    got = [r.x for r in df.select(fx.safe_int("v").alias("x")).collect()]
    assert got == [12, -3, 0, 0]
    z = spark.createDataFrame([(11205.0,)], "v double")
    assert z.select(fx.code_as_text("v").alias("x")).first().x == "11205"
    assert math.isclose(1.0, 1.0)
