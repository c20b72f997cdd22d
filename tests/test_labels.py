"""Risk/reward label edge cases on synthetic bars (2.13)."""

from ledgerline.operators.labels import swing_labels

SCHEMA = ("symbol string, date int, open double, high double, low double, close double, atr_14 double, "
          "day_index int, split_flag int")


def label(spark, rows):
    out = swing_labels(spark.createDataFrame(rows, SCHEMA)).orderBy("date").collect()
    return {r.date: r for r in out}


def bars(n, over=None):
    over = over or {}
    rows = []
    for i in range(n):
        r = dict(symbol="X", date=i, open=100.0, high=101.0, low=99.0, close=100.0, atr_14=2.0, day_index=i,
                 split_flag=0)
        r.update(over.get(i, {}))
        rows.append(tuple(r.values()))
    return rows


def test_timeout_win_loss_and_tie(spark):
    assert label(spark, bars(8))[0].label_rr_outcome_5d == "timeout"
    win = label(spark, bars(8, {3: {"high": 105.0}}))[0]
    assert win.label_rr_outcome_5d == "win" and abs(win.label_rr_return_5d - 0.04) < 1e-12
    loss = label(spark, bars(8, {2: {"low": 97.0}}))[0]
    assert loss.label_rr_outcome_5d == "loss" and abs(loss.label_rr_return_5d + 0.02) < 1e-12
    tie = label(spark, bars(8, {2: {"low": 97.0, "high": 105.0}}))[0]
    assert tie.label_rr_outcome_5d == "loss"  # stop first on the same day


def test_halt_and_gaps_invalid(spark):
    rows = [r for r in bars(9) if r[1] != 1]  # T+1 missing for date 0
    out = label(spark, rows)
    assert out[0].is_label_valid is False and out[0].label_return_1d is None
    assert out[0].label_rr_outcome_5d == "invalid"
    rows = [r for r in bars(9) if r[1] != 3]  # T+3 missing: 1-day label valid, R:R invalid
    out = label(spark, rows)
    assert out[0].is_label_valid is True and out[0].label_rr_outcome_5d == "invalid"


def test_split_in_window_and_extreme(spark):
    out = label(spark, bars(12, {4: {"split_flag": 1}}))
    assert out[0].label_rr_outcome_5d == "invalid" and out[4].label_rr_outcome_5d == "timeout"
    ext = label(spark, bars(8, {1: {"close": 130.0}}))
    assert ext[0].label_extreme_flag is True and ext[0].label_direction_1d == 1
