"""Point-in-time reports, domain scores by weight tables, regime confidence, macro releases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline import config
from ledgerline.functions.asof import known_asof
from ledgerline.operators import regime as RG
from ledgerline.operators import scoring as SC
from ledgerline.operators import universe as U
from ledgerline.session import small_side

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_known_asof_against_brute_force(spark):
    r = random.Random(1)
    rows = [(s, day(i)) for s in "AB" for i in range(0, 400, 7)] + [("C", day(3))]
    reports = [(s, day(q), day(q + r.randint(5, 200)), float(r.randint(0, 9))) for s in "AB" for q in range(0, 360, 30) for _ in range(2)]
    left = spark.createDataFrame(rows, "symbol string, date date")
    right = spark.createDataFrame(reports, "symbol string, period date, known date, v double")
    got = {(x.symbol, x.date): (x.period, x.known, x.v) for x in known_asof(left, right, "symbol", "date", "period", "known", ["v"]).collect()}
    for s, d in rows:
        best = max(((p, k, v) for t, p, k, v in reports if t == s and k <= d), default=(None, None, None))
        assert got[s, d] == best


def base_rows(spark):
    rows = [(s, day(i), 10.0 + i, 5.0, 100.0 + i, 60.0, float(i)) for s in "AB" for i in range(40)]
    return spark.createDataFrame(rows, "symbol string, date date, close double, high double, volume double, volume_21d_avg double, obv double")


def report(symbol, quarter, known, revenue):
    return (symbol, quarter, known, revenue * 2, revenue / 2, 0.0, 10.0, revenue, revenue, revenue / 2, 1.0)


COLUMNS = ("symbol string, quarter_end date, known_date date, gross double, collected double, returned double, units double, "
           "first_revenue double, revenue double, net_income double, previous_revenue double")


def test_a_later_report_changes_no_earlier_score(spark):
    first = [report("A", day(-30), day(2), 100.0), report("B", day(-30), day(5), 3e6)]
    later = [*first, report("A", day(-30), day(20), 9e6), report("A", day(-200), day(25), 1.0), report("B", day(10), day(30), 50.0)]

    def scores(reports):
        x = U.point_in_time_fundamentals(base_rows(spark), spark.createDataFrame(reports, COLUMNS), 112.0, lambda c: F.lit("x"))
        return {(r.symbol, r.date): (r.manipulation_risk_score, r.market_cap, r.price_to_earnings, r.fundamental_presence_flag)
                for r in U.manipulation_risk(x).collect()}

    a, b = scores(first), scores(later)
    assert all(a[k] == b[k] for k in a if k[1] < day(20) or (k[0] == "B" and k[1] < day(30)))
    assert a["A", day(25)] != b["A", day(25)] and a["B", day(35)] != b["B", day(35)]
    assert b["A", day(26)][1] == 9e6 * 112 and b["A", day(0)][3] == 0 and b["A", day(3)][3] == 1


def test_weight_tables_add_up():
    weights = config.rows("domain_weights")
    for d in {r["domain"] for r in weights}:
        assert sum(float(r["weight"]) for r in weights if r["domain"] == d) == pytest.approx(1.0)
    regimes = config.rows("regime_weights")
    for g in {r["regime"] for r in regimes}:
        own = {r["domain"]: float(r["weight"]) for r in regimes if r["regime"] == g}
        assert sum(abs(w) for w in own.values()) == pytest.approx(1.0) and own["risk"] < 0


def test_domain_scores_follow_the_tables(spark):
    weights = [{"domain": "one", "metric": "a", "higher_is_better": "1", "weight": "0.6"},
               {"domain": "one", "metric": "b", "higher_is_better": "0", "weight": "0.4"},
               {"domain": "two", "metric": "c", "higher_is_better": "1", "weight": "1.0"},
               {"domain": "macro", "metric": "m", "higher_is_better": "1", "weight": "1.0"}]
    regimes = [{"regime": g, "domain": d, "weight": w} for g, ws in {"baseline": (0.5, 0.4, 0.0, -0.1), "up": (1.0, 0.0, 0.0, -1.0)}.items()
               for d, w in zip(("one", "two", "macro", "risk"), ws)]
    rows = [("A", "us", day(0), 1.0, 5.0, 7.0, 0.5), ("B", "us", day(0), 3.0, 1.0, 7.0, 0.0), ("C", "us", day(0), 2.0, None, 7.0, None),
            ("D", "us", day(0), None, 3.0, None, 0.0), ("A", "us", day(9), 4.0, 1.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "symbol string, market_context string, date date, a double, b double, c double, manipulation_risk_score double")
    labels = spark.createDataFrame([("us", day(5), "up")], "market_context string, date date, regime_label_buffered string")
    macro = spark.createDataFrame([(day(0), 0.7, 1.0), (day(9), None, 0.0)], "date date, macro_score double, macro_known_weight double")
    got = {(r.symbol, r.date): r for r in SC.domain_scores(df, macro, labels, weights=weights, regime_weights=regimes).collect()}
    a, b, c, d, late = (got[k] for k in (("A", day(0)), ("B", day(0)), ("C", day(0)), ("D", day(0)), ("A", day(9))))
    assert (a.regime, late.regime) == ("baseline", "up")
    assert (a.one_score, b.one_score, c.one_score) == (0.0, 1.0, 0.5) and c.one_known_weight == pytest.approx(0.6)
    assert d.one_score is None and d.two_score is None and d.composite_score is None  # below half the weight; two domains missing
    assert a.two_score == 0.5 and a.composite_score == pytest.approx(0.5 * 0 + 0.4 * 0.5 - 0.1 * 0.5)
    assert late.composite_score == pytest.approx(1.0 * 0.5 - 1.0 * 0.5)
    stale = {(r.date): r.regime for r in SC.regime_by_day(df, labels, "regime_label_buffered", stale_days=3).collect()}
    assert stale == {day(0): "baseline", day(9): "baseline"}


def test_breadth_votes_cut_confidence(spark):
    days = spark.createDataFrame([("us", day(i), b, 10) for i, b in enumerate((0.8, 0.2, 0.5))], "market_context string, date date, breadth double, n_symbols long")
    labels = spark.createDataFrame(
        [("us", day(0), 11.0, 10.0, 0.1, 12.0, "bull_trend"), ("us", day(1), 11.0, 10.0, 0.1, 40.0, "high_vol"), ("us", day(2), 11.0, 10.0, 0.1, None, "bull_trend")],
        "market_context string, date date, index_close double, index_sma_50 double, sma_slope double, vix double, regime_label_buffered string")
    got = [(r.trend_vote, r.breadth_vote, r.volatility_vote, round(r.regime_confidence, 3), r.breadth_conflict, r.regime_label_held)
           for r in RG.breadth_confidence(days, labels).orderBy("date").collect()]
    assert got == [(1, 1, 1, 1.0, False, "bull_trend"), (1, -1, -1, 0.333, True, "bull_trend"), (1, 0, None, 0.5, False, "bull_trend")]


def test_macro_series_are_known_by_their_release(spark):
    monthly = spark.createDataFrame([(day(30 * i), 100.0 + 10 * i) for i in range(4)] + [(day(0), 1.0)], "date date, level double")
    s = RG.macro_series(monthly, "level", 1, 12, relative=True)
    flat = RG.macro_series(monthly, "level", 1, 0)
    days = spark.createDataFrame([(day(i),) for i in (0, 12, 41, 42, 50, 200, 42)], "date date")
    got = {r.date: r for r in RG.macro_regime_inputs(days, {"rate": flat, "long_yield": flat, "inflation": s, "growth": s}).collect()}
    assert len(got) == 6 and got[day(41)].inflation_trend is None and got[day(42)].inflation_trend == pytest.approx(0.1)
    assert got[day(42)].inflation_state == "rising" and got[day(42)].macro_regime == "conflict" and got[day(42)].yield_spread == 0.0
    assert got[day(200)].inflation_state is None and got[day(200)].macro_regime == "neutral"


def test_small_side_is_broadcast_only_within_its_bound(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    plan = lambda n: big.join(small_side(spark.range(50).withColumnRenamed("id", "k"), n), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(50) and "strategy=broadcast" not in plan(49)


def test_scoring_sorts_no_row_back_after_the_reports(spark, monkeypatch):
    # indicators, signals and risk pass before the reports are sorted in: above their union one window is left
    from conftest import SF001
    from ledgerline.plans import q_universe as Q

    class Stop(Exception):
        pass

    def keep(df, name):
        raise Stop(df)

    monkeypatch.setattr(Q, "written", keep)
    with pytest.raises(Stop) as stopped:
        Q.scored(spark, SF001)
    plan = stopped.value.args[0]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [n for n, line in enumerate(plan) if line.lstrip(" :+|-").startswith("Window ")]
    union = next(n for n, line in enumerate(plan) if line.lstrip(" :+|-").startswith("Union"))
    assert sum(n < union for n in at) == 1 and len(at) <= 21


def test_signals_on_the_rows_give_the_same_scores(spark):
    r = random.Random(3)
    rows = [(s, day(i), *[r.uniform(5, 9) for _ in range(2)], r.uniform(9, 10), r.choice([1e3, 5e4]), r.uniform(0, 3), float(r.randint(-9, 9)),
             r.choice([1e6, 9e9]), r.randint(0, 1), r.choice([None, 0.5, -0.2]), r.choice([None, r.uniform(-1, 1)]))
            for s in "AB" for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, close double, high double, volume double, volume_ratio double, obv double, "
                               "market_cap double, fundamental_presence_flag int, return_1d double, sentiment_score double").withColumn("volume_21d_avg", F.lit(1e4))
    extra = df.select("*", *[F.lit(1.0).alias(c) for c in ("macdh_12_26_9", "swing_low_20d", "vol_ratio")], F.lit(2.0).alias("swing_high_20d"))

    def scores(x):
        out = SC.market_metrics(U.eligibility(U.manipulation_risk(x), min_volume=0.0, min_dollar=0.0, gap_ceiling=9.0))
        return sorted((tuple(row.asDict().items()) for row in out.select(*sorted(out.columns)).collect()), key=str)

    before = U.risk_signals(SC.market_signals(U.liquidity_signals(extra)))
    assert str(scores(extra)) == str(scores(before)) and {dict(x)["eligible"] for x in scores(extra)} == {True, False}
