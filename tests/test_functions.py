"""Column helpers against Python / numpy semantics (property tests)."""
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.functions import columns as C

FINITE = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
DECIMALISH = st.builds(lambda k, d: round(k / 10 ** d, d), st.integers(-10 ** 9, 10 ** 9),
                       st.integers(0, 5))


def _collect(spark, values, *exprs):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return df.select("x", *exprs).collect()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(FINITE, DECIMALISH), min_size=1, max_size=60))
def test_py_round_and_format_match_python(spark, values):
    rows = _collect(spark, values, C.py_round("x", 2).alias("r2"), C.py_round("x", 1).alias("r1"),
                    C.py_format("x", 1).alias("f1"), C.py_format("x", 0, True).alias("f0"))
    for r in rows:
        assert r.r2 == round(r.x, 2)
        assert r.r1 == round(r.x, 1)
        assert r.f1 == f"{r.x:.1f}"
        assert r.f0 == f"{r.x:,.0f}"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(FINITE, DECIMALISH), min_size=1, max_size=60))
def test_np_round_matches_numpy(spark, values):
    rows = _collect(spark, values, C.np_round("x", 2).alias("r"))
    for r in rows:
        assert r.r == float(np.round(np.float64(r.x), 2))


def test_known_ties(spark):
    rows = _collect(spark, [20.15, 0.35, 0.25, 2.675, -0.04],
                    C.py_format("x", 1).alias("f"), C.py_round("x", 2).alias("r"))
    assert [r.f for r in rows] == ["20.1", "0.3", "0.2", "2.7", "-0.0"]
    assert [r.r for r in rows] == [20.15, 0.35, 0.25, 2.67, -0.04]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(FINITE, DECIMALISH), min_size=1, max_size=200))
def test_dsum_is_order_independent_and_accurate(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    a = df.agg(C.dsum("x")).first()[0]
    b = df.repartition(7).agg(C.dsum("x")).first()[0]
    c = df.orderBy(F.desc("x")).coalesce(1).agg(C.dsum("x")).first()[0]
    assert a == b == c
    assert math.isclose(a, math.fsum(values), rel_tol=1e-12, abs_tol=1e-6)


def test_null_discipline(spark):
    df = spark.createDataFrame([(None, 0.0), (2.0, 0.0), (float("nan"), 4.0)], "a double, b double")
    r = df.select(C.safe_div("a", "b").alias("q"), C.clip_keep_null("a").alias("c"),
                  C.nan_to_null("a").alias("n")).collect()
    assert [x.q for x in r[:2]] == [None, None]
    assert r[0].c is None and r[1].c == 1.0
    assert r[2].n is None


def test_month_short_name(spark):
    df = spark.createDataFrame([(1,), (12,), (13,)], "m int")
    assert [r[0] for r in df.select(C.month_short_name("m")).collect()] == ["Jan", "Dec", "13"]


def test_dsum_no_overflow_on_large_totals(spark):
    # 2000 × 1e13 = 2e16; scaled by 2^10 that is ~2e19, beyond a BIGINT sum
    df = spark.range(2000).select((F.lit(1e13) + F.col("id").cast("double") * 0.25).alias("x"))
    total = df.agg(C.dsum("x")).first()[0]
    assert total == 2000 * 1e13 + 0.25 * sum(range(2000))
