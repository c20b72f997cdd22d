"""Block extremes equal the sliding frame."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.sliding import Extreme, Moments, sliding_extremes, sliding_moments, sliding_sums


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_sliding_extremes_equal_the_frame(spark, n):
    r = random.Random(n)
    day = dt.date(2024, 1, 1)
    rows = [(s, day + dt.timedelta(days=i), r.choice([None, float(r.randint(-9, 9)), r.random()]))
            for s, size in (("A", 37), ("B", 1), ("C", 20), ("D", 0)) for i in range(size)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double")
    got = sliding_extremes(df, [Extreme("x", n, "hi"), Extreme("x", n, "lo", largest=False, strict=True),
                                Extreme("x", n, "prior", before=True), Extreme("x", 3, "hi3")])
    w = Window.partitionBy("symbol").orderBy("date")
    frame, frame3 = w.rowsBetween(-(n - 1), 0), w.rowsBetween(-2, 0)
    want = df.select("*", F.max("x").over(frame).alias("hi"), F.when(F.count("x").over(frame) >= n, F.min("x").over(frame)).alias("lo"),
                     F.max("x").over(w.rowsBetween(-n, -1)).alias("prior"), F.max("x").over(frame3).alias("hi3"))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_year_frames_are_gone_from_the_plans(spark):
    import os

    from conftest import SF001
    from ledgerline.plans import registry

    for name in ("w09_high_52w_proximity", "fe07_range_52w", "fe31_quant_extras", "s01_scanner", "flagship_latest_signals"):
        plan = registry()[name].fn(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert "-251, currentrow" not in plan and "-252, -1" not in plan, name
    assert os.path.isdir(SF001)


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_sliding_sums_equal_the_frame(spark, n):
    r = random.Random(n)
    day = dt.date(2024, 1, 1)
    # a huge value must leave no trace once it has left the frame
    rows = [(s, day + dt.timedelta(days=i), r.choice([None, r.random(), 1.0]) if i != 3 else 1e17)
            for s, size in (("A", 37), ("B", 1), ("C", 20)) for i in range(size)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double")
    got = sliding_sums(df, {"s": "x"}, n)
    frame = Window.partitionBy("symbol").orderBy("date").rowsBetween(-(n - 1), 0)
    want = {(x.symbol, x.date): x.s for x in df.select("*", F.coalesce(F.sum("x").over(frame), F.lit(0.0)).alias("s")).collect()}
    assert got.columns == [*df.columns, "s"]
    assert {(x.symbol, x.date): pytest.approx(x.s, rel=1e-12) for x in got.collect()} == want


def test_autocorrelations_read_no_frame_of_63_rows(spark):
    from conftest import SF001
    from ledgerline.plans import registry

    plan = registry()["fe31_quant_extras"].fn(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "-62, currentrow" not in plan


def test_constant_returns_have_no_autocorrelation(spark):
    from ledgerline.operators.spec_features import quant_extras

    day = dt.date(2024, 1, 1)
    rows = [(s, day + dt.timedelta(days=i), 1.0, ret) for i in range(12) for s, ret in (("flat", 0.1), ("moves", 0.1 * (i % 3)))]
    out = quant_extras(spark.createDataFrame(rows, "symbol string, date date, close double, return_1d double"), lags=(1,), window=4)
    got = {(r.symbol, r.date.day): (r.autocorr_lag1_4d, r.return_1d_capped) for r in out.collect()}
    assert all(got["flat", i] == (None, pytest.approx(0.1)) for i in range(1, 13))
    assert got["moves", 4][0] is None and got["moves", 5][0] is not None


@pytest.mark.parametrize("n", [1, 2, 7, 20, 21])
def test_sliding_moments_equal_those_of_the_frame(spark, n):
    r = random.Random(n)
    day = dt.date(2024, 1, 1)
    # C: far from zero and hardly varying, from row 20 on constant; B: a NULL empties the frames that hold it
    draw = {"A": lambda i: r.gauss(0, 1) * 10 ** (i % 4), "B": lambda i: None if i == 25 else r.random(),
            "C": lambda i: 1e6 + (r.random() * 1e-3 if i < 20 else 0.1)}
    rows = [(s, day + dt.timedelta(days=i), f(i)) for s, f in draw.items() for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double")
    got = sliding_moments(df, [Moments("x", n, "m", (2, 3, 4)), Moments("x", 5, "v")])
    assert got.columns == [*df.columns, "m2", "m3", "m4", "v2"]
    seen = {}
    for row in sorted(got.collect(), key=lambda q: (q.symbol, q.date)):
        held = seen.setdefault(row.symbol, [])
        held.append(row.x)
        frame = held[-n:]
        if len(frame) < n or None in frame:
            assert (row.m2, row.m3, row.m4) == (None, None, None)
            continue
        mean = math.fsum(frame) / n
        if min(frame) == max(frame):
            assert (row.m2, row.m3, row.m4) == (0.0, 0.0, 0.0)
            continue
        size = math.fsum((x - mean) ** 2 for x in frame)
        for p in (2, 3, 4):
            assert row[f"m{p}"] == pytest.approx(math.fsum((x - mean) ** p for x in frame), abs=1e-5 * size ** (p / 2)), (row, p)


def test_windows_of_a_symbol_share_their_sorts(spark):
    from ledgerline.operators import spec_features as SF
    from ledgerline.operators.features import technical_indicators

    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 1.0, 1.0)], "symbol string, date date, high double, low double, close double")
    assert _sorts(technical_indicators(df)) <= 2  # by date, by block
    assert _sorts(SF.drawdown(df)) == 1
    moments = SF.return_moments(df.withColumn("return_1d", F.col("close")))._jdf.queryExecution().optimizedPlan().toString()
    assert "skewness" not in moments and "kurtosis" not in moments


def _sorts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Sort [")
