"""Indicators against plain Python recursions of the public definitions."""

import math
import random

import pytest

from ledgerline.operators.features import price_features, technical_indicators


def _series(n, seed=1):
    rnd = random.Random(seed)
    c, rows = 100.0, []
    for i in range(n):
        o = c * (1 + rnd.gauss(0, 0.01))
        c = o * (1 + rnd.gauss(0, 0.02))
        h, lo = max(o, c) * (1 + abs(rnd.gauss(0, 0.01))), min(o, c) * (1 - abs(rnd.gauss(0, 0.01)))
        rows.append(("X", i, o, h, lo, c))
    return rows


def _ewm(xs, a, minp):
    out, e, n = [], None, 0
    for x in xs:
        if x is not None:
            n += 1
            e = x if e is None else (1 - a) * e + a * x
        out.append(e if e is not None and n >= minp else None)
    return out


def reference(rows):
    c = [r[5] for r in rows]
    h = [r[3] for r in rows]
    lo = [r[4] for r in rows]
    diff = [None] + [c[i] - c[i - 1] for i in range(1, len(c))]
    up = [d if d is not None and d > 0 else 0.0 for d in diff]
    dn = [-d if d is not None and d < 0 else 0.0 for d in diff]
    eu, ed = _ewm(up, 1 / 14, 14), _ewm(dn, 1 / 14, 14)
    rsi = [None if u is None else (100.0 if d == 0 else 100 - 100 / (1 + u / d)) for u, d in zip(eu, ed)]
    f, s = _ewm(c, 2 / 13, 12), _ewm(c, 2 / 27, 26)
    macd = [None if a is None or b is None else a - b for a, b in zip(f, s)]
    sig = _ewm(macd, 0.2, 9)
    tr = [h[0] - lo[0]] + [max(h[i] - lo[i], abs(h[i] - c[i - 1]), abs(lo[i] - c[i - 1])) for i in range(1, len(c))]
    atr = [None] * len(c)
    if len(c) >= 14:
        atr[13] = sum(tr[:14]) / 14
        for i in range(14, len(c)):
            atr[i] = (atr[i - 1] * 13 + tr[i]) / 14
    bbm = [None if i < 19 else sum(c[i - 19:i + 1]) / 20 for i in range(len(c))]
    sd = [None if i < 19 else math.sqrt(sum((x - bbm[i]) ** 2 for x in c[i - 19:i + 1]) / 20) for i in range(len(c))]
    return {"rsi_14": rsi, "macd_12_26_9": macd, "macds_12_26_9": sig, "atr_14": atr, "bbm_20_2_0": bbm,
            "bbu_20_2_0": [None if m is None else m + 2 * s_ for m, s_ in zip(bbm, sd)]}


@pytest.mark.parametrize("n", [10, 300])
def test_indicators_match_recursion(spark, n):
    rows = _series(n)
    df = spark.createDataFrame(rows, "symbol string, date int, open double, high double, low double, close double")
    got = technical_indicators(df).orderBy("date").collect()
    exp = reference(rows)
    for col, vals in exp.items():
        for r, e in zip(got, vals):
            g = r[col]
            if e is None:
                assert g is None, (col, r.date)
            else:
                assert g is not None and math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9), (col, r.date, g, e)


def test_price_features(spark):
    rows = _series(30)
    df = spark.createDataFrame(rows, "symbol string, date int, open double, high double, low double, close double")
    got = price_features(df).orderBy("date").collect()
    assert got[0].return_1d is None and got[0].high_52w == rows[0][3]
    assert math.isclose(got[5].return_5d, rows[5][5] / rows[0][5] - 1)
    assert math.isclose(got[29].high_52w, max(r[3] for r in rows))
