"""Scalar functions: literal trap cases and properties against Python."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applens import functions as fn


def one(spark, expr, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", dtype, True)]))
    return df.select(expr(F.col("c")).alias("r")).first().r


def many(spark, expr, values, dtype=T.StringType()):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               T.StructType([T.StructField("i", T.IntegerType()),
                                             T.StructField("c", dtype, True)]))
    return [r.r for r in df.select("i", expr(F.col("c")).alias("r")).orderBy("i").collect()]


def py_size(x):
    x = x.rstrip("M")
    if x[-1:] == "k":
        return round(float(x.rstrip("k")) / 1024, 1)
    if x.startswith("Varies"):
        return None
    return float(x)


def test_alnum(spark):
    assert many(spark, fn.alnum, ["Ab c#1", "#$%", "é😀x", None]) == ["Abc1", "", "x", None]
    assert one(spark, lambda c: fn.alnum(c, "0"), "ART_AND_DESIGN") == "ART0AND0DESIGN"
    # A supplementary-plane character counts as one character, as in Python.
    assert one(spark, lambda c: fn.alnum(c, "0"), "a😀b") == "a0b"


def test_size_rounding_traps(spark):
    vals = ["19M", "201k", "256k", "Varies with device", "1.0M", "8.5k", "MM", None]
    got = many(spark, fn.parse_size_mb, vals)
    assert got[:6] == [19.0, 0.2, 0.2, None, 1.0, 0.0]
    assert got[6] is None and got[7] is None  # empty after strip -> NULL, not an error
    assert got[2] == py_size("256k")  # half-even: 0.25 -> 0.2


def test_size_integer_k_matches_python(spark):
    ks = list(range(0, 20001, 7))
    got = many(spark, fn.parse_size_mb, [f"{k}k" for k in ks])
    assert got == [py_size(f"{k}k") for k in ks]


def test_count_and_price(spark):
    assert many(spark, fn.parse_count, ["10,000+", "0", "500+", "1,000,000+", "Free", "1.0"]) == [
        10000, 0, 500, 1000000, None, None]
    assert many(spark, fn.parse_price, ["$4.99 ", "0", "$0.99\t", "Everyone", None]) == [
        4.99, 0.0, 0.99, None, None]


def test_strip_unicode_whitespace(spark):
    vals = ["  app  ", "\t\nx y\x1f", "　", "plain"]
    assert many(spark, fn.strip, vals) == [v.strip() for v in vals]


def test_short_name(spark):
    assert many(spark, fn.short_name, ["com.a.b", "a.b", "abc", "com.x.y.z", None]) == [
        "a-b", "a-b", "abc", "y-z", None]


def test_literal_split_keeps_trailing(spark):
    assert one(spark, lambda c: fn.literal_split(c, "#"), "a#b##") == "a#b##".split("#")
    assert one(spark, lambda c: fn.literal_split(c, "."), "a.b") == ["a", "b"]


def test_remove_newlines(spark):
    assert one(spark, fn.remove_newlines, "a\nb") == "a b"
    assert one(spark, lambda c: fn.remove_newlines(c, ""), "a\nb") == "ab"


def test_ceil1_and_labels(spark):
    assert many(spark, fn.ceil1, [4.01, 4.0, -0.05, None], T.DoubleType()) == [4.1, 4.0, -0.0, None]
    assert many(spark, fn.sign_label, [-0.1, 0.0, 0.3, None], T.DoubleType()) == [
        "Negative", "Neutral", "Positive", None]
    assert one(spark, fn.category_label, "ART0AND0DESIGN0") == "ART-AND-DESIGN-"
    assert one(spark, lambda c: fn.prefix(c, "cat_"), "X") == "cat_X"


def test_nan_to_null(spark):
    got = many(spark, fn.nan_to_null, [float("nan"), 1.0, None], T.DoubleType())
    assert got == [None, 1.0, None]


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double")
    r = df.agg(fn.safe_corr("x", "y").alias("r"), fn.safe_corr("x", "x").alias("s")).first()
    assert r.r is None and abs(r.s - 1.0) < 1e-12


text = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=12)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text, min_size=1, max_size=20))
def test_alnum_property(spark, values):
    assert many(spark, fn.alnum, values) == [re.sub("[^a-zA-Z0-9]", "", v) for v in values]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10 ** 9), min_size=1, max_size=20))
def test_count_property(spark, values):
    texts = [f"{v:,}+" for v in values]
    assert many(spark, fn.parse_count, texts) == values


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet="ab.", max_size=4), min_size=1, max_size=4)
                .map(".".join), min_size=1, max_size=10))
def test_short_name_property(spark, values):
    assert many(spark, fn.short_name, values) == ["-".join(v.split(".")[-2:]) for v in values]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab# ", max_size=8), min_size=1, max_size=10))
def test_split_property(spark, values):
    got = many(spark, lambda c: fn.literal_split(c, "#"), values)
    assert got == [v.split("#") for v in values]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 99999).map(lambda k: f"{k}k") | st.integers(0, 999).map(lambda m: f"{m}M"),
                min_size=1, max_size=20))
def test_size_property(spark, values):
    assert many(spark, fn.parse_size_mb, values) == [py_size(v) for v in values]


def test_size_fractional_kilo_is_decimal_half_even(spark):
    # Known, accepted difference: '153.6k' / 1024 is 0.15 in decimal but just
    # below it in binary. Python rounds the binary value (0.1); Spark's bround
    # rounds the shortest decimal form half-even (0.2). Integer kilo values,
    # the catalogue's form, agree exactly (test_size_integer_k_matches_python).
    assert one(spark, fn.parse_size_mb, "153.6k") == 0.2
    assert py_size("153.6k") == 0.1


ws_text = st.text(alphabet=st.sampled_from(
    [chr(c) for c in list(range(0, 0x30)) + [0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x2007, 0x200B,
                                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]]
    + list("ab é")), max_size=10)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ws_text, min_size=1, max_size=20))
def test_strip_property(spark, values):
    assert many(spark, fn.strip, values) == [v.strip() for v in values]


def py_price(x):
    try:
        return float(x.lstrip("$").rstrip())
    except ValueError:
        return None


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.builds(lambda d, c, t: f"{'$' if d else ''}{c / 100:.2f}{t}",
                          st.booleans(), st.integers(0, 100000), st.sampled_from(["", " ", "\t", "  "])),
                min_size=1, max_size=20))
def test_price_property(spark, values):
    assert many(spark, fn.parse_price, values) == [py_price(v) for v in values]
