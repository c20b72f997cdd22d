import math
import random

from ledgerline.functions.ema import EmaSpec, ema_many


def recursion(xs, a, minp):
    out, e, n = [], None, 0
    for x in xs:
        if x is not None:
            n += 1
            e = x if e is None else (1 - a) * e + a * x
        out.append(e if (e is not None and n >= minp) else None)
    return out


def _frame(spark, series):
    rows = [(s, i, x) for s, xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "symbol string, date int, x double")


def test_ema_matches_recursion_across_blocks(spark):
    rnd = random.Random(7)
    series = {
        "A": [100 + rnd.gauss(0, 5) for _ in range(1400)],
        "B": [None] * 9 + [rnd.uniform(-3, 3) for _ in range(60)],
        "C": [5.0],
    }
    specs = [EmaSpec("x", 1 / 14, "w14", 14), EmaSpec("x", 2 / 13, "s12", 12), EmaSpec("x", 0.2, "s9", 1)]
    # 1400 rows cross the shared block size (621) twice
    got = ema_many(_frame(spark, series), specs).orderBy("symbol", "date").collect()
    for spec in specs:
        for sym, xs in series.items():
            exp = recursion(xs, spec.alpha, spec.min_periods)
            vals = [r[spec.out] for r in got if r.symbol == sym]
            for g, e in zip(vals, exp):
                if e is None:
                    assert g is None
                else:
                    assert math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9), (sym, spec, g, e)


def test_ema_default_block_long_series(spark):
    rnd = random.Random(3)
    xs = [50 + rnd.gauss(0, 1) for _ in range(3000)]
    got = ema_many(_frame(spark, {"L": xs}), [EmaSpec("x", 0.2, "e")]).orderBy("date").collect()
    exp = recursion(xs, 0.2, 1)
    assert max(abs(r.e - v) for r, v in zip(got, exp)) < 1e-9


def test_block_too_small_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        ema_many(_frame(spark, {"A": [1.0]}), [EmaSpec("x", 0.1, "e")], block=7)
