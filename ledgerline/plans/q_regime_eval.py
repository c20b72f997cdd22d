"""Registered queries for the regime specs M01-M10 and evaluation V01-V15."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import enrichment as EN
from ..operators import evaluate as V
from ..operators import news as N
from ..operators import regime as RG
from ..operators import spec_features as SF
from ..operators.silver import one_per_key
from ..session import small_side, written
from ..sources import landing as L
from ..sources import landing_text as LT
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from ..util import exact_avg, exact_avg_sql, safe_corr_sql
from .catalog import query
from .q_enrich import _E04, _E04_DEPS, _E04_EXTRA, _E11_DEPS, _E11_EXTRA
from .q_enrich import _E11 as E11_SQL
from .q_features import FE01, macro_daily
from .q_labels import DEPS as LAB_DEPS
from .q_labels import EXTRA as LAB_EXTRA
from .q_labels import labels

# ------------------------------------------------------------------ regime M01-M03
VIX_DAY = f"""SELECT CAST(o_orderdate AS DATE) AS date, CASE WHEN count(*) >= 5 THEN {exact_avg_sql('o_totalprice')} / 10000.0 END AS vix
             FROM orders GROUP BY 1"""
_M01 = """
SELECT *, CASE WHEN vix > 25.0 THEN 'high_vol'
               WHEN sma_slope IS NULL OR abs(sma_slope) < 0.001 THEN 'sideways'
               WHEN index_close > index_sma_50 AND sma_slope > 0 THEN 'bull_trend'
               WHEN index_close < index_sma_50 AND sma_slope < 0 THEN 'bear_trend' ELSE 'sideways' END AS regime_raw
FROM (SELECT r.*, r.index_sma_50 / NULLIF(lag(r.index_sma_50, 5) OVER (PARTITION BY r.market_context ORDER BY r.date), 0) - 1
               AS sma_slope,
             CASE WHEN r.market_context = 'india' THEN v.vix END AS vix
      FROM regime r LEFT JOIN vixd v ON r.date = v.date) t"""
_M02 = """
SELECT *, last_value(CASE WHEN run >= 3 THEN regime_raw END IGNORE NULLS) OVER (PARTITION BY market_context ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS regime_label_buffered
FROM (SELECT *, row_number() OVER (PARTITION BY market_context, isl ORDER BY date) AS run
      FROM (SELECT *, sum(chg) OVER (PARTITION BY market_context ORDER BY date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
            FROM (SELECT *, CASE WHEN lag(regime_raw) OVER (PARTITION BY market_context ORDER BY date) IS NULL
                                   OR lag(regime_raw) OVER (PARTITION BY market_context ORDER BY date) <> regime_raw
                                 THEN 1 ELSE 0 END AS chg FROM m01) a) b) c"""
REXTRA = {"vixd": VIX_DAY, "m01": _M01, "m02": _M02}
RDEPS = {"m01": ["regime", "vixd"], "m02": ["m01"]}


def vix_days(spark, d):
    v = L.scan_macro_prices_json(LT.macro_price_docs(spark, d)).select(
        "date", F.col("india_vix_close").alias("vix"))
    return v.withColumn("market_context", F.lit("india"))  # one row per date


def m01_frame(spark, d):
    return RG.regime_raw(RG.index_series(daily.silver(spark, d)), vix_days(spark, d))


M01_COLS = ["date", "market_context", "regime_label", "index_close", "index_sma_50", "sma_slope", "vix", "regime_raw"]


@query("m01_regime_raw", O.cte(["m01"], f"SELECT {', '.join(M01_COLS)} FROM m01", REXTRA, RDEPS),
       ["index_close", "index_sma_50", "sma_slope", "vix"])
def m01(spark, d):
    """Bull / bear / sideways / high_vol from the 50-day mean, its slope and the VIX."""
    return m01_frame(spark, d).select(*M01_COLS)


@query("m02_regime_buffer", O.cte(["m02"], "SELECT date, market_context, regime_raw, regime_label_buffered FROM m02",
                                  REXTRA, RDEPS))
def m02(spark, d):
    """A new regime counts only after 3 consecutive days."""
    return RG.regime_buffer(m01_frame(spark, d)).select("date", "market_context", "regime_raw",
                                                         "regime_label_buffered")


@query("m03_regime_instability", O.cte(["m02"], """
SELECT date, market_context, regime_label_buffered, t AS transitions_20d, t > 4 AS regime_unstable
FROM (SELECT *, sum(c) OVER (PARTITION BY market_context ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS t
      FROM (SELECT *, CASE WHEN lag(regime_label_buffered) OVER (PARTITION BY market_context ORDER BY date) IS NOT NULL
                            AND lag(regime_label_buffered) OVER (PARTITION BY market_context ORDER BY date)
                                <> regime_label_buffered THEN 1 ELSE 0 END AS c FROM m02) a) b""", REXTRA, RDEPS))
def m03(spark, d):
    """More than 4 regime changes within 20 days."""
    out = RG.regime_instability(RG.regime_buffer(m01_frame(spark, d)))
    return out.select("date", "market_context", "regime_label_buffered",
                      F.col("transitions_20d").cast("long").alias("transitions_20d"), "regime_unstable")


def _returns(spark, d):
    return SF.returns(daily.silver(spark, d), horizons=(1, 21))


_M04 = """
SELECT *, last_value(CASE WHEN regime_confidence >= 0.5 THEN regime_label_buffered END IGNORE NULLS) OVER (
            PARTITION BY market_context ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS regime_label_held,
       trend_vote * breadth_vote < 0 AS breadth_conflict
FROM (SELECT *, (1 + CAST(breadth_vote = trend_vote AS INTEGER) + CAST(COALESCE(volatility_vote = trend_vote, false) AS INTEGER))
                / (2 + CAST(volatility_vote IS NOT NULL AS INTEGER)) AS regime_confidence
      FROM (SELECT b.market_context, b.date, b.breadth, b.n_symbols, m.regime_label_buffered,
                   CAST(CASE WHEN sign(m.index_close - m.index_sma_50) = COALESCE(sign(m.sma_slope), 0)
                             THEN sign(m.index_close - m.index_sma_50) ELSE 0 END AS INTEGER) AS trend_vote,
                   CASE WHEN b.breadth > 0.55 THEN 1 WHEN b.breadth < 0.45 THEN -1 ELSE 0 END AS breadth_vote,
                   CASE WHEN m.vix IS NOT NULL THEN CASE WHEN m.vix > 25.0 THEN -1 ELSE 1 END END AS volatility_vote
            FROM (SELECT s.market_context, s.date, avg(CASE WHEN r.return_1d > 0 THEN 1.0 ELSE 0.0 END) AS breadth,
                         count(*) AS n_symbols
                  FROM silver s JOIN fe01 r ON s.symbol = r.symbol AND s.date = r.date GROUP BY 1, 2) b
            LEFT JOIN m02 m ON b.market_context = m.market_context AND b.date = m.date) v) c"""


@query("m04_breadth", O.cte(["silver", "fe01", "m02"], _M04, {**REXTRA, "fe01": FE01}, {**RDEPS, "fe01": ["silver"]}),
       ["breadth", "regime_confidence"])
def m04(spark, d):
    """Share of advancing symbols per market and date, the votes of trend,
    breadth and volatility, and the regime confidence that their disagreement cuts."""
    s = daily.silver(spark, d)
    labels = RG.regime_buffer(RG.regime_raw(RG.index_series(s), vix_days(spark, d)))
    return RG.breadth_confidence(RG.breadth(SF.returns(s, horizons=(1,))), labels)


@query("m05_dow_trend", O.cte(["silver"], """
SELECT symbol, date, last_pivot_high, last_pivot_low, prev_pivot_high, prev_pivot_low,
       CASE WHEN last_pivot_high > prev_pivot_high AND last_pivot_low > prev_pivot_low THEN 'up'
            WHEN last_pivot_high < prev_pivot_high AND last_pivot_low < prev_pivot_low THEN 'down' ELSE 'none' END AS dow_trend
FROM (SELECT *, last_value(pph IGNORE NULLS) OVER r AS prev_pivot_high, last_value(ppl IGNORE NULLS) OVER r AS prev_pivot_low
      FROM (SELECT *, CASE WHEN ph IS NOT NULL THEN lag(last_pivot_high) OVER w END AS pph,
                   CASE WHEN pl IS NOT NULL THEN lag(last_pivot_low) OVER w END AS ppl
            FROM (SELECT *, last_value(ph IGNORE NULLS) OVER r AS last_pivot_high,
                         last_value(pl IGNORE NULLS) OVER r AS last_pivot_low
                  FROM (SELECT symbol, date, high, low,
                               CASE WHEN lag(high, 1) OVER w > lag(high, 2) OVER w AND lag(high, 1) OVER w > high
                                    THEN lag(high, 1) OVER w END AS ph,
                               CASE WHEN lag(low, 1) OVER w < lag(low, 2) OVER w AND lag(low, 1) OVER w < low
                                    THEN lag(low, 1) OVER w END AS pl
                        FROM silver WINDOW w AS (PARTITION BY symbol ORDER BY date)) a
                  WINDOW r AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) b
            WINDOW w AS (PARTITION BY symbol ORDER BY date)) c
      WINDOW r AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) e"""),
       ["last_pivot_high", "last_pivot_low", "prev_pivot_high", "prev_pivot_low"])
def m05(spark, d):
    """Dow trend from higher highs and higher lows of the swing pivots."""
    out = RG.dow_trend(daily.silver(spark, d).select("symbol", "date", "high", "low"))
    return out.select("symbol", "date", "last_pivot_high", "last_pivot_low", "prev_pivot_high", "prev_pivot_low",
                      "dow_trend")


@query("m06_regime_conditional_moments", O.cte(["silver", "fe01", "regime"], """
SELECT s.market_context, g.regime_label, count(*) AS n, avg(r.return_1d) AS mean_return,
       stddev_samp(r.return_1d) AS std_return,
       skewness(r.return_1d) * (count(r.return_1d) - 2) / sqrt(count(r.return_1d) * (count(r.return_1d) - 1.0))
         AS skew_pop,
       kurtosis_pop(r.return_1d) AS kurt_pop
FROM silver s JOIN fe01 r ON s.symbol = r.symbol AND s.date = r.date
JOIN regime g ON s.market_context = g.market_context AND s.date = g.date
GROUP BY 1, 2""", {"fe01": FE01}, {"fe01": ["silver"]}),
       {"mean_return": 6, "std_return": 6, "skew_pop": 4, "kurt_pop": 4})
def m06(spark, d):
    """Return moments per market regime (population skew / excess kurtosis)."""
    s = daily.silver(spark, d)
    feats = SF.returns(s, horizons=(1,))
    return RG.regime_conditional_moments(feats, RG.market_regime(RG.index_series(s)))


_IC_BASE = """
SELECT date, signal, fwd FROM (
  SELECT date, close / NULLIF(lag(close, 21) OVER w, 0) - 1 AS signal, lead(close) OVER w / NULLIF(close, 0) - 1 AS fwd
  FROM silver WINDOW w AS (PARTITION BY symbol ORDER BY date)) t
WHERE signal IS NOT NULL AND fwd IS NOT NULL"""
_IC = f"""
SELECT date, count(*) AS n_names, CASE WHEN count(*) >= 3 THEN {safe_corr_sql("rs", "rf")} END AS ic
FROM (SELECT date, percent_rank() OVER (PARTITION BY date ORDER BY signal) AS rs,
             percent_rank() OVER (PARTITION BY date ORDER BY fwd) AS rf FROM icb) t GROUP BY date"""
ICX = {"icb": _IC_BASE, "ic": _IC}
ICD = {"icb": ["silver"], "ic": ["icb"]}


def ic_frame(spark, d):
    s = daily.silver(spark, d)
    w = Window.partitionBy("symbol").orderBy("date")
    x = s.select("date", (F.try_divide(F.col("close"), F.lag("close", 21).over(w)) - 1.0).alias("signal"),
                 (F.try_divide(F.lead("close", 1).over(w), F.col("close")) - 1.0).alias("fwd"))
    return RG.signal_ic(x, "signal", "fwd")


@query("m07_signal_ic", O.cte(["ic"], "SELECT * FROM ic", ICX, ICD), ["ic"])
def m07(spark, d):
    """Per-date rank correlation of the 21-day momentum signal and the next-day return."""
    return ic_frame(spark, d)


@query("m07_ic_summary", O.cte(["ic"], """
SELECT count(ic) AS n_dates, avg(ic) AS mean_ic, stddev_samp(ic) AS std_ic, avg(ic) / NULLIF(stddev_samp(ic), 0) AS ic_ir
FROM ic""", ICX, ICD), ["mean_ic", "std_ic", "ic_ir"])
def m07s(spark, d):
    """M07 stability: mean, standard deviation and ratio of the daily IC."""
    return RG.ic_summary(ic_frame(spark, d))


def articles(spark, d):
    """Articles from the event stream: user as symbol, value as polarity,
    props.k as confidence."""
    e = TV.table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                    F.col("ts").cast("date").alias("day"),
                    F.least(F.greatest((F.col("value") - 25.0) / 25.0, F.lit(-1.0)), F.lit(1.0)).alias("polarity"),
                    (k / 100.0).alias("confidence"))


_LAGS = " + ".join([f"COALESCE(lag(p, {k}) OVER w, 0) * {0.5 ** (k / 2.0)!r}" if k else f"p * {1.0!r}"
                    for k in range(5)])
_LAGN = " + ".join([f"COALESCE(lag(n, {k}) OVER w, 0) * {0.5 ** (k / 2.0)!r}" if k else f"n * {1.0!r}"
                    for k in range(5)])
_CNT = " + ".join([f"COALESCE(lag(n, {k}) OVER w, 0)" if k else "n" for k in range(5)])


_ART = """
SELECT c.symbol, d.idx, sum(c.p) AS p, sum(c.n) AS n
FROM (SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS day,
             sum(least(greatest((value - 25.0) / 25.0, -1.0), 1.0)) AS p, count(*) AS n
      FROM events WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 >= 0.4 GROUP BY 1, 2) c
ASOF JOIN tdays d ON c.day <= d.day GROUP BY 1, 2"""
_TDAYS = """
SELECT day, row_number() OVER (ORDER BY day) AS idx
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE isodow(ts) <= 5) t"""


@query("m08_sentiment_decay", O.cte(["tdays", "art"], f"""
SELECT symbol, day, cnt AS article_count_5d, CASE WHEN cnt < 2 THEN 0.0 ELSE num / den END AS sentiment_decayed,
       cnt < 2 AS low_coverage
FROM (SELECT symbol, idx, {_CNT} AS cnt, {_LAGS} AS num, {_LAGN} AS den
      FROM (SELECT g.symbol, g.idx, COALESCE(a.p, 0) AS p, COALESCE(a.n, 0) AS n
            FROM (SELECT symbol, unnest(generate_series(lo, hi)) AS idx
                  FROM (SELECT symbol, min(idx) AS lo, max(idx) AS hi FROM art GROUP BY 1) s) g
            LEFT JOIN art a ON g.symbol = a.symbol AND g.idx = a.idx) x
      WINDOW w AS (PARTITION BY symbol ORDER BY idx)) y JOIN tdays USING (idx)""",
                                    {"art": _ART, "tdays": _TDAYS}, {"art": ["tdays"], "tdays": []}), ["sentiment_decayed"])
def m08(spark, d):
    """Recency-weighted (half-life 2 days) article polarity over 5 trading days; neutral under 2 articles."""
    a = articles(spark, d)
    return N.sentiment_decay(a, a.select("day").where(F.weekday("day") < 5))


@query("m09_news_novelty", """
SELECT doc_id, h AS text_hash, copies, doc_id = first_id AS is_novel
FROM (SELECT doc_id, sha256(text) AS h, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_id,
             count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents) t""")
def m09(spark, d):
    """First occurrence of an exact text is novel, later copies are repeats."""
    return N.news_novelty(TV.table(spark, d, "documents"))


def macro_releases(spark, d):
    """The macro series with their release lags: rates daily (the long yield a
    day later), price level and activity monthly (12 and 20 days later)."""
    rates = L.extract_macro_html(LT.macro_html_pages(spark, d))
    o = TV.table(spark, d, "orders")
    monthly = o.groupBy(F.last_day(F.col("o_orderdate").cast("date")).alias("date")).agg(
        exact_avg("o_totalprice").alias("price_level"), F.count(F.lit(1)).alias("orders"))
    return {"rate": RG.macro_series(rates, "rbi_repo_rate", RG.RATE_TREND_LOOKBACK, 0),
            "long_yield": RG.macro_series(rates, "india_10y_yield", RG.RATE_TREND_LOOKBACK, 1),
            "inflation": RG.macro_series(monthly, "price_level", 3, 12, relative=True),
            "growth": RG.macro_series(monthly, "orders", 3, 20, relative=True)}


_M10_STATES = """
SELECT *, CASE WHEN inflation_state IS NULL OR growth_state IS NULL THEN 'neutral'
               WHEN growth_state = 'expanding' AND inflation_state = 'rising' AND macro_regime_input = 'tightening' THEN 'conflict'
               WHEN growth_state = 'expanding' THEN 'expansion' WHEN inflation_state = 'rising' THEN 'stagflation'
               WHEN growth_state = 'contracting' THEN 'contraction' ELSE 'neutral' END AS macro_regime
FROM (SELECT c.date, r.date AS macro_asof_date, r.repo AS macro_rate, r.chg AS rate_change_63,
             CAST(c.date - r.date AS INTEGER) AS macro_age_days, p.chg AS inflation_trend,
             CAST(c.date - p.available AS INTEGER) AS inflation_age_days, g.chg AS growth_trend,
             CAST(c.date - g.available AS INTEGER) AS growth_age_days, y.yld - r.repo AS yield_spread,
             CASE WHEN r.date IS NULL OR c.date - r.date > 35 THEN 'neutral' WHEN r.chg > 0 THEN 'tightening'
                  WHEN r.chg < 0 THEN 'easing' ELSE 'stable' END AS macro_regime_input,
             CASE WHEN c.date - p.available > 35 OR p.chg IS NULL THEN NULL WHEN p.chg > 0.02 THEN 'rising'
                  WHEN p.chg < -0.02 THEN 'falling' ELSE 'flat' END AS inflation_state,
             CASE WHEN c.date - g.available > 35 OR g.chg IS NULL THEN NULL WHEN g.chg > 0.02 THEN 'expanding'
                  WHEN g.chg < -0.02 THEN 'contracting' ELSE 'flat' END AS growth_state
      FROM mdays c
      ASOF LEFT JOIN (SELECT date, repo, repo - lag(repo, 63) OVER (ORDER BY date) AS chg FROM md) r ON c.date >= r.date
      ASOF LEFT JOIN (SELECT date + 1 AS available, yld FROM md) y ON c.date >= y.available
      ASOF LEFT JOIN (SELECT month_end + 12 AS available, level / lag(level, 3) OVER (ORDER BY month_end) - 1 AS chg FROM mm) p
        ON c.date >= p.available
      ASOF LEFT JOIN (SELECT month_end + 20 AS available, n / lag(n, 3) OVER (ORDER BY month_end) - 1 AS chg FROM mm) g
        ON c.date >= g.available) t"""
_MD = """SELECT CAST(o_orderdate AS DATE) AS date,
       CASE WHEN count(*) > 6 THEN ROUND(min(o_totalprice) / 20000.0 * 100) / 100
            ELSE ROUND(avg(o_totalprice) / 50000.0 * 100) / 100 END AS repo,
       greatest(ROUND(max(o_totalprice) / 70000.0 * 10000) / 10000, ROUND(avg(o_totalprice) / 30000.0 * 10000) / 10000) AS yld
       FROM orders GROUP BY 1"""
_MM = f"""SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end, {exact_avg_sql('o_totalprice')} AS level, count(*) AS n
       FROM orders GROUP BY 1"""
_MDAYS = "SELECT DISTINCT date FROM silver WHERE market_context = 'india'"
MACRO_EXTRA = {"md": _MD, "mm": _MM, "mdays": _MDAYS, "macro_states": _M10_STATES}
MACRO_DEPS = {"mdays": ["silver"], "macro_states": ["md", "mm", "mdays"]}
M10_COLS = ["date", "macro_asof_date", "macro_rate", "rate_change_63", "macro_age_days", "inflation_trend",
            "inflation_age_days", "growth_trend", "growth_age_days", "yield_spread", "macro_regime_input",
            "inflation_state", "growth_state", "macro_regime"]


@query("m10_macro_regime_inputs", O.cte(["macro_states"], f"SELECT {', '.join(M10_COLS)} FROM macro_states", MACRO_EXTRA, MACRO_DEPS),
       ["macro_rate", "rate_change_63", "inflation_trend", "growth_trend", "yield_spread"])
def m10(spark, d):
    """Rate, inflation, activity and spread by their release lags, each newest one known per trading day, and the macro regime."""
    cal = daily.trading_days(spark, d).filter(F.col("market_context") == "india").select("date")
    return RG.macro_regime_inputs(cal, macro_releases(spark, d)).select(*M10_COLS)


# ------------------------------------------------------------------ evaluation
_EV = """
SELECT l.*, r.close, r.atr_14, r.return_1d, r.return_5d, COALESCE(t.cap_tier, 'unknown') AS cap_tier,
       COALESCE(sec.sector, 'Others') AS sector,
       CASE WHEN r.return_5d IS NOT NULL THEN CASE WHEN r.return_5d > 0 THEN 1 ELSE 0 END END AS pred_direction,
       CASE WHEN r.return_1d IS NOT NULL THEN CASE WHEN r.return_1d < 0 THEN 1 ELSE 0 END END AS pred_reversal
FROM lab l
JOIN (SELECT symbol, date, close, atr_14, close / NULLIF(lag(close, 1) OVER w, 0) - 1 AS return_1d,
             close / NULLIF(lag(close, 5) OVER w, 0) - 1 AS return_5d
      FROM lr WINDOW w AS (PARTITION BY symbol ORDER BY date)) r ON l.symbol = r.symbol AND l.date = r.date
LEFT JOIN cap_tiers t ON l.symbol = t.symbol
LEFT JOIN sectors sec ON l.symbol = sec.symbol"""
EX = {**LAB_EXTRA, "ev": _EV}
ED = {**LAB_DEPS, "ev": ["lab", "lr", "cap_tiers", "sectors"]}


def ev_frame(spark, d):
    lab = labels(spark, d)
    x = SF.returns(lab, horizons=(1, 5))
    x = x.join(TV.cap_tiers(spark, d).select("symbol", "cap_tier"), ["symbol"], "left")
    x = x.join(one_per_key(TV.sectors(spark, d).select("symbol", "sector"), ["symbol"]), ["symbol"], "left")
    return x.select("*", F.coalesce("cap_tier", F.lit("unknown")).alias("__t"),
                    F.coalesce("sector", F.lit("Others")).alias("__s"),
                    F.when(F.col("return_5d").isNotNull(), F.when(F.col("return_5d") > 0, 1).otherwise(0))
                    .alias("pred_direction"),
                    F.when(F.col("return_1d").isNotNull(), F.when(F.col("return_1d") < 0, 1).otherwise(0))
                    .alias("pred_reversal")).drop("cap_tier", "sector").withColumnRenamed("__t", "cap_tier") \
        .withColumnRenamed("__s", "sector")


def _ev(names, body, extra=None, deps=None):
    return O.cte(names, body, {**EX, **(extra or {})}, {**ED, **(deps or {})})


def ship_dates(spark, d):
    """The days that the data covers; their years are the folds."""
    return TV.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))


_FOLDS = """generate_series(greatest(year(date), (SELECT min(year(l_shipdate)) + 1 FROM lineitem)),
                                (SELECT max(year(l_shipdate)) FROM lineitem))"""


@query("v01_walk_forward_folds", _ev(["ev"], f"""
SELECT symbol, date, CAST(f AS INTEGER) AS fold_year, CASE WHEN f = year(date) THEN 'test' ELSE 'train' END AS role
FROM (SELECT symbol, date, unnest({_FOLDS}) AS f FROM ev) x"""))
def v01(spark, d):
    """Expanding walk-forward folds by test year (no random split)."""
    return V.walk_forward_folds(ev_frame(spark, d).select("symbol", "date"), ship_dates(spark, d))


_CLS = """
SELECT cap_tier, n, hit / n AS accuracy, tp / NULLIF(tp + fp, 0) AS precision, tp / NULLIF(tp + fn, 0) AS recall,
       (CASE WHEN g = 1 THEN sra ELSE srt END - pos * (pos + 1) / 2.0) / NULLIF(pos * (n - pos), 0) AS auc,
       2 * (tp / NULLIF(tp + fp, 0)) * (tp / NULLIF(tp + fn, 0))
         / NULLIF(tp / NULLIF(tp + fp, 0) + tp / NULLIF(tp + fn, 0), 0) AS f1
FROM (SELECT cap_tier, count(*) AS n, count_if(label_direction_1d = pred_direction) AS hit,
             count_if(label_direction_1d = 1 AND pred_direction = 1) AS tp,
             count_if(label_direction_1d = 0 AND pred_direction = 1) AS fp,
             count_if(label_direction_1d = 1 AND pred_direction = 0) AS fn, count_if(label_direction_1d = 1) AS pos,
             sum(CASE WHEN label_direction_1d = 1 THEN rt END) AS srt, sum(CASE WHEN label_direction_1d = 1 THEN ra END) AS sra,
             GROUPING(cap_tier) AS g
      FROM (SELECT *, rank() OVER (PARTITION BY cap_tier ORDER BY return_5d)
                        + (count(*) OVER (PARTITION BY cap_tier, return_5d) - 1) / 2.0 AS rt,
                      rank() OVER (ORDER BY return_5d) + (count(*) OVER (PARTITION BY return_5d) - 1) / 2.0 AS ra
            FROM ev WHERE label_direction_1d IS NOT NULL AND pred_direction IS NOT NULL AND return_5d IS NOT NULL) d
      GROUP BY ROLLUP (cap_tier)) t"""


@query("v02_classification_metrics", _ev(["ev"], _CLS), ["accuracy", "precision", "recall", "auc", "f1"])
def v02(spark, d):
    """Accuracy, precision, recall, F1 and rank-sum AUC per cap tier and overall (rollup)."""
    return V.classification_metrics(ev_frame(spark, d), "label_direction_1d", "pred_direction", "return_5d")


@query("v03_regression_metrics", _ev(["ev"], f"""
SELECT cap_tier, count(*) AS n, avg(abs(p - label_return_1d)) AS mae, sqrt(avg((p - label_return_1d) * (p - label_return_1d)))
         AS rmse,
       avg(CASE WHEN label_return_1d <> 0 THEN abs((p - label_return_1d) / label_return_1d) END) AS mape,
       {safe_corr_sql("p", "label_return_1d")} AS corr
FROM (SELECT *, return_5d / 5.0 AS p FROM ev) x WHERE label_return_1d IS NOT NULL AND p IS NOT NULL
GROUP BY ROLLUP (cap_tier)"""), {"mae": 6, "rmse": 6, "mape": 4, "corr": 6})
def v03(spark, d):
    """MAE, RMSE, MAPE and correlation of a naive return forecast, per tier and overall."""
    e = ev_frame(spark, d).withColumn("p", F.col("return_5d") / 5.0)
    return V.regression_metrics(e, "label_return_1d", "p")


_TRADES = """
SELECT *, label_rr_return_5d - CASE market_context WHEN 'india' THEN 0.005 WHEN 'us' THEN 0.001 END AS net_return,
       CASE market_context WHEN 'india' THEN 0.005 WHEN 'us' THEN 0.001 END AS round_trip_cost
FROM ev WHERE pred_direction = 1 AND label_rr_outcome_5d <> 'invalid'"""
TX = {"trades": _TRADES}
TD = {"trades": ["ev"]}


def trades(spark, d):
    e = ev_frame(spark, d).filter((F.col("pred_direction") == 1) & (F.col("label_rr_outcome_5d") != "invalid"))
    return V.trade_costs(e)


@query("v04_trade_costs", _ev(["trades"], """
SELECT symbol, date, market_context, label_rr_return_5d, round_trip_cost, net_return FROM trades""", TX, TD),
       {"label_rr_return_5d": 4, "round_trip_cost": 6, "net_return": 4})
def v04(spark, d):
    """Trade returns net of the market's round-trip cost (0.50 % india, 0.10 % us)."""
    return trades(spark, d).select("symbol", "date", "market_context", "label_rr_return_5d", "round_trip_cost",
                                   "net_return")


@query("v05_trade_metrics", _ev(["trades"], """
SELECT cap_tier, count(*) AS n_trades, avg(CASE WHEN label_rr_outcome_5d = 'win' THEN 1.0 ELSE 0.0 END) AS win_rate,
       avg(CASE WHEN label_rr_outcome_5d = 'loss' THEN 1.0 ELSE 0.0 END) AS loss_rate,
       avg(CASE WHEN label_rr_outcome_5d = 'timeout' THEN 1.0 ELSE 0.0 END) AS timeout_rate,
       avg(net_return) AS mean_net_return
FROM trades GROUP BY ROLLUP (cap_tier)""", TX, TD), {"win_rate": 6, "loss_rate": 6, "timeout_rate": 6,
                                                     "mean_net_return": 4})
def v05(spark, d):
    """Win / loss / timeout rates and mean net return per tier and overall."""
    return V.trade_metrics(trades(spark, d))


_CURVE = """
SELECT *, equity / running_peak - 1.0 AS drawdown FROM (
  SELECT *, max(equity) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_peak FROM (
    SELECT *, exp(sum(ln(1 + daily_return)) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS equity,
           exp(sum(ln(1 + COALESCE(bench_return, 0.0))) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
             AS bh_equity
    FROM (SELECT t.date, t.daily_return, t.n_trades, b.bench_return
          FROM (SELECT date, avg(net_return) AS daily_return, count(*) AS n_trades FROM trades GROUP BY 1) t
          LEFT JOIN (SELECT date, avg(return_1d) AS bench_return FROM ev GROUP BY 1) b ON t.date = b.date) x) y) z"""
CX = {**TX, "curve": _CURVE}
CD = {**TD, "curve": ["trades", "ev"]}


def curve(spark, d):
    bench = ev_frame(spark, d).groupBy("date").agg(F.avg("return_1d").alias("bench_return"))  # one row per date
    return V.equity_curve(trades(spark, d), bench)


@query("v06_equity_curve", _ev(["curve"], """
SELECT date, daily_return, n_trades, bench_return, equity, running_peak, drawdown, bh_equity FROM curve""", CX, CD),
       {"daily_return": 5, "bench_return": 6, "equity": 4, "running_peak": 4, "drawdown": 4, "bh_equity": 4})
def v06(spark, d):
    """Equity curve from the trades entered each day, drawdown and buy-and-hold."""
    return curve(spark, d).select("date", "daily_return", "n_trades", "bench_return", "equity", "running_peak",
                                  "drawdown", "bh_equity")


@query("v06_equity_summary", _ev(["curve"], """
SELECT count(*) AS n_days, arg_max(equity, date) - 1.0 AS total_return, min(drawdown) AS max_drawdown,
       avg(daily_return) / NULLIF(stddev_samp(daily_return), 0) * sqrt(252) AS sharpe FROM curve""", CX, CD),
       {"total_return": 3, "max_drawdown": 4, "sharpe": 4})
def v06s(spark, d):
    """V06 summary: total return, maximum drawdown, annualised Sharpe."""
    return V.equity_summary(curve(spark, d))


_SIZE = """
SELECT symbol, date, close, atr_14, shares, shares * close AS position_value, COALESCE(shares > 0, false) AS position_taken
FROM (SELECT *, CASE WHEN atr_14 IS NOT NULL AND close IS NOT NULL THEN
                  CAST(least(floor(10000.0 / NULLIF(atr_14 * 1.0, 0)), floor(200000.0 / NULLIF(close, 0))) AS BIGINT) END
                  AS shares FROM ev) x"""


@query("v07_position_size", _ev(["ev"], _SIZE), {"close": 6, "atr_14": 4, "position_value": 2})
def v07(spark, d):
    """Shares from 1 % risk over a 1 x ATR stop, capped at 20 % of capital."""
    return V.position_size(ev_frame(spark, d)).select("symbol", "date", "close", "atr_14", "shares",
                                                      "position_value", "position_taken")


@query("v08_portfolio_limits", _ev(["ev"], """
SELECT date, symbol, sector, score, sector_rank, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol) AS day_rank
FROM (SELECT date, symbol, sector, return_5d AS score,
             row_number() OVER (PARTITION BY date, sector ORDER BY return_5d DESC, symbol) AS sector_rank
      FROM ev WHERE pred_direction = 1 AND is_label_valid) s
WHERE sector_rank <= 2 QUALIFY day_rank <= 5"""), ["score"])
def v08(spark, d):
    """At most 5 new positions per day and 2 (40 %) per sector, best signals first."""
    s = ev_frame(spark, d).filter((F.col("pred_direction") == 1) & F.col("is_label_valid")).select(
        "date", "symbol", "sector", F.col("return_5d").alias("score"))
    out = V.portfolio_limits(s)
    return out.select("date", "symbol", "sector", "score", F.col("sector_rank").cast("long").alias("sector_rank"),
                      F.col("day_rank").cast("long").alias("day_rank"))


_E17B = """
SELECT symbol, date, CASE WHEN close >= open * (1 + band - 0.001) THEN 1 ELSE 0 END AS upper_circuit_flag,
       CASE WHEN close <= open * (1 - band + 0.001) THEN 1 ELSE 0 END AS lower_circuit_flag
FROM (SELECT symbol, date, open, close, last_value(circuit_band IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS band FROM silver) a"""
_MST = """
SELECT c.date, COALESCE(date_diff('day', m.d, c.date) > 35, true) AS macro_stale
FROM (SELECT DISTINCT date FROM silver) c
ASOF LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) m ON c.date >= m.d"""
_SERVE = """
SELECT s.symbol, s.date, s.close, e.earnings_blackout_flag, c.upper_circuit_flag, c.lower_circuit_flag,
       m.macro_event_blackout_flag, st.macro_stale, abs(r.return_5d) AS confidence,
       CASE WHEN r.return_5d IS NOT NULL THEN CASE WHEN r.return_5d > 0 THEN 1 ELSE 0 END END AS pred_direction,
       CASE WHEN e.earnings_blackout_flag = 1 THEN 'earnings_blackout'
            WHEN c.upper_circuit_flag = 1 OR c.lower_circuit_flag = 1 THEN 'circuit_hit'
            WHEN m.macro_event_blackout_flag = 1 THEN 'macro_blackout'
            WHEN COALESCE(abs(r.return_5d) < 0.01, true) THEN 'low_confidence'
            WHEN st.macro_stale THEN 'stale_data' END AS suppression_reason
FROM silver s
JOIN e4 e ON s.symbol = e.symbol AND s.date = e.date
JOIN e17b c ON s.symbol = c.symbol AND s.date = c.date
JOIN e11q m ON s.symbol = m.symbol AND s.date = m.date
JOIN fe01 r ON s.symbol = r.symbol AND s.date = r.date
LEFT JOIN mst st ON s.date = st.date"""
SX = {**_E04_EXTRA, **_E11_EXTRA, "e4": _E04, "e17b": _E17B, "e11q": E11_SQL, "fe01": FE01, "mst": _MST, "serve": _SERVE}
SD = {**_E04_DEPS, **_E11_DEPS, "e4": ["b", "ev"], "e17b": ["silver"], "e11q": ["silver", "nx"], "fe01": ["silver"],
      "mst": ["silver"], "serve": ["silver", "e4", "e17b", "e11q", "fe01", "mst"]}
SERVE_COLS = ["symbol", "date", "close", "earnings_blackout_flag", "upper_circuit_flag", "lower_circuit_flag",
              "macro_event_blackout_flag", "macro_stale", "confidence", "pred_direction", "suppression_reason"]


def serve_frame(spark, d):
    from ..operators import promotion as P

    s = daily.silver(spark, d)
    days = written(daily.trading_days(spark, d), "trading-days")  # a row a market and day, read several times
    cal = EN.trading_calendar_index(days)
    rows = s.select("symbol", "date", "market_context", "sector", "open", "close", "volume", "circuit_band")
    rows = EN.earnings_features(rows, TV.earnings_events(spark, d), cal)
    rows = EN.circuit_flags(rows)
    rows = EN.macro_event_features(rows, TV.macro_events(spark, d), cal)
    rows = SF.returns(rows, horizons=(5,))
    released = TV.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    m = P.newest_dates(days, {"macro_asof": released.join(F.broadcast(days.select("market_context").distinct()))})  # two markets
    rows = rows.join(small_side(m), ["market_context", "date"], "left")
    rows = rows.withColumn("macro_stale", F.coalesce(F.datediff("date", "macro_asof") > 35, F.lit(True)))
    rows = rows.select("*", F.abs("return_5d").alias("confidence"),
                       F.when(F.col("return_5d").isNotNull(), F.when(F.col("return_5d") > 0, 1).otherwise(0))
                       .alias("pred_direction"))
    return V.serving_gates(rows)


@query("v09_serving_gates", O.cte(["serve"], f"SELECT {', '.join(SERVE_COLS)} FROM serve", SX, SD),
       {"close": 6, "confidence": 6})
def v09(spark, d):
    """First suppression reason per row (earnings, circuit, macro, confidence, staleness)."""
    return serve_frame(spark, d).select(*SERVE_COLS)


@query("v10_promotion_gate", _ev(["ev"], f"""
SELECT fold_year, old_test AS old_test_accuracy, new_test AS new_test_accuracy, new_test - old_test AS accuracy_gain,
       new_train - new_test AS overfit_gap,
       COALESCE(new_test - old_test >= 0.02 AND new_train - new_test <= 0.2, false) AS promote
FROM (SELECT CAST(f AS INTEGER) AS fold_year,
             avg(CASE WHEN label_direction_1d IS NOT NULL AND pred_direction IS NOT NULL AND f = year(date)
                      THEN CASE WHEN label_direction_1d = pred_direction THEN 1.0 ELSE 0.0 END END) AS old_test,
             avg(CASE WHEN label_direction_1d IS NOT NULL AND pred_reversal IS NOT NULL AND f = year(date)
                      THEN CASE WHEN label_direction_1d = pred_reversal THEN 1.0 ELSE 0.0 END END) AS new_test,
             avg(CASE WHEN label_direction_1d IS NOT NULL AND pred_reversal IS NOT NULL AND f <> year(date)
                      THEN CASE WHEN label_direction_1d = pred_reversal THEN 1.0 ELSE 0.0 END END) AS new_train
      FROM (SELECT *, unnest({_FOLDS}) AS f FROM ev) x GROUP BY 1) t"""),
       ["old_test_accuracy", "new_test_accuracy", "accuracy_gain", "overfit_gap"])
def v10(spark, d):
    """Per walk-forward fold, promote the reversal rule over the momentum
    rule when it gains 2 points of test accuracy with a train-test gap <= 20 points."""
    folds = V.walk_forward_folds(ev_frame(spark, d), ship_dates(spark, d))
    acc = V.fold_accuracy(folds, "label_direction_1d", {"old": "pred_direction", "new": "pred_reversal"})
    return V.promotion_decision(acc, "old", "new")


@query("v11_trade_signal", O.cte(["serve", "gold_s4"], """
SELECT s.symbol, s.date, s.close AS entry_price, s.close - 1.0 * g.atr_raw AS stop_price,
       s.close + 2.0 * g.atr_raw AS target_price,
       CASE WHEN g.atr_raw IS NOT NULL AND s.close IS NOT NULL THEN
         CAST(least(floor(10000.0 / NULLIF(g.atr_raw * 1.0, 0)), floor(200000.0 / NULLIF(s.close, 0))) AS BIGINT) END
         AS shares
FROM serve s JOIN gold_s4 g ON s.symbol = g.symbol AND s.date = g.date
WHERE s.suppression_reason IS NULL AND s.pred_direction = 1""", SX, SD),
       {"entry_price": 6, "stop_price": 4, "target_price": 4})
def v11(spark, d):
    """Entry, stop, target and size for every served long signal."""
    sv = serve_frame(spark, d)
    atr = daily.gold(spark, d, keep_nulls=True).select("symbol", "date", "atr_14")
    out = V.trade_signal(sv.join(atr, ["symbol", "date"]))
    return out.select("symbol", "date", "entry_price", "stop_price", "target_price", "shares")


@query("v12_reconcile_counts", O.cte(["silver", "gold"], """
SELECT COALESCE(a.date, b.date) AS date, COALESCE(a.n, 0) AS rows_a, COALESCE(b.n, 0) AS rows_b,
       abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) / greatest(COALESCE(a.n, 0), COALESCE(b.n, 0), 1) AS diff_ratio,
       abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) / greatest(COALESCE(a.n, 0), COALESCE(b.n, 0), 1) > 0.01 AS mismatch
FROM (SELECT date, count(*) AS n FROM silver GROUP BY 1) a
FULL OUTER JOIN (SELECT date, count(*) AS n FROM gold GROUP BY 1) b ON a.date = b.date"""), ["diff_ratio"])
def v12(spark, d):
    """Per-date row counts of two stores (silver, gold); flag > 1 % difference."""
    s = daily.silver(spark, d)
    return V.reconcile_counts(s, daily.gold(spark, d, silver_df=s))


@query("v13_performance_decay", _ev(["ev"], """
SELECT date, n, daily_accuracy, rolling_accuracy, baseline_accuracy, baseline_accuracy - rolling_accuracy >= 0.05 AS decayed
FROM (SELECT *, avg(daily_accuracy) OVER (ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS rolling_accuracy,
             sum(hits) OVER () / sum(n) OVER () AS baseline_accuracy
      FROM (SELECT date, count(*) AS n, count_if(label_direction_1d = pred_direction) AS hits,
                   count_if(label_direction_1d = pred_direction) / count(*) AS daily_accuracy
            FROM ev WHERE label_direction_1d IS NOT NULL AND pred_direction IS NOT NULL GROUP BY 1) d) t"""),
       ["daily_accuracy", "rolling_accuracy", "baseline_accuracy"])
def v13(spark, d):
    """Rolling 21-date hit rate against the overall baseline; decay at -5 points."""
    return V.performance_decay(ev_frame(spark, d), "label_direction_1d", "pred_direction")


DRIFT_FEATS = ["return_1d", "return_5d", "close"]


_CONF = "least(abs(return_5d) * 10.0, 1.0)"
_BINS = {f: "greatest(least(floor((v - (mu - 3 * sd)) * 10 / (6 * sd)), 9), 0)" for f in DRIFT_FEATS} | {
    "confidence": "greatest(least(floor((v - 0.0) * 10 / 1.0), 9), 0)"}
_DRIFT = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(date_trunc('week', date) AS DATE) AS week, date, v, mu, sd, CASE WHEN v IS NOT NULL THEN {cell} END AS cell "
    f"FROM (SELECT date, {_CONF if f == 'confidence' else f} AS v, avg({_CONF if f == 'confidence' else f}) OVER () AS mu, "
    f"stddev_samp({_CONF if f == 'confidence' else f}) OVER () AS sd FROM ev) {f}_t" for f, cell in _BINS.items())
_DRIFT_WEEKS = f"""
SELECT feature, week, count(*) AS n, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS null_share, avg(v) AS mean,
       quantile_cont(v, 0.5) AS median, avg(CASE WHEN feature <> 'confidence' AND abs(v - mu) > 4 * sd THEN 1.0 ELSE 0.0 END) AS outlier_share,
       max(CASE WHEN v IS NOT NULL THEN date END) AS last, count(v) AS seen,
       [{', '.join(f'count(*) FILTER (WHERE cell = {i})' for i in range(10))}] AS bins
FROM drift GROUP BY 1, 2"""


@query("v14_drift_report", _ev(["drift_weeks"], """
SELECT feature, week, n, null_share, mean, median, mean - lag(mean) OVER w AS mean_change, outlier_share,
       array_to_string(bins, ',') AS histogram,
       CASE WHEN prev IS NOT NULL THEN list_sum([(p[i] - prev[i]) * ln(p[i] / prev[i]) FOR i IN range(1, 11)]) END AS psi,
       CASE WHEN prev IS NOT NULL THEN list_max([abs(p[i] - prev[i]) FOR i IN range(1, 11)]) END AS max_share_change,
       CAST(week + 6 - max(last) OVER (PARTITION BY feature ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS feed_age_days,
       COALESCE(week + 6 - max(last) OVER (PARTITION BY feature ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 7, true) AS feed_stale
FROM (SELECT *, lag(p) OVER (PARTITION BY feature ORDER BY week) AS prev
      FROM (SELECT *, [(x + 0.5)::DOUBLE / (seen + 5.0) FOR x IN bins] AS p FROM drift_weeks) a) b
WINDOW w AS (PARTITION BY feature ORDER BY week)""", {"drift": _DRIFT, "drift_weeks": _DRIFT_WEEKS},
                               {"drift": ["ev"], "drift_weeks": ["drift"]}),
       {**{c: 5 for c in ["null_share", "mean", "median", "mean_change"]}, "outlier_share": 6, "psi": 6, "max_share_change": 6})
def v14(spark, d):
    """Weekly NULL share, mean, median, histogram drift, outliers and feed
    age per feature, and the distribution of a confidence (here of the 5-day return)."""
    x = ev_frame(spark, d)
    return V.drift_report(x.withColumn("confidence", F.least(F.abs("return_5d") * 10.0, F.lit(1.0))), DRIFT_FEATS, "confidence")


HASH_FEATS = ["return_1d", "return_5d", "high_52w", "proximity_to_52w_high"]
_HASH_TXT = ", ".join(
    f"COALESCE(CAST(CAST(ROUND({c} * 1000000.0) / 1000000.0 AS DECIMAL(38,6)) AS VARCHAR), '')" for c in HASH_FEATS)


@query("v15_features_hash", O.cte(["gold"], f"SELECT symbol, date, sha256(concat_ws('|', {_HASH_TXT})) AS features_hash "
                                            "FROM gold"))
def v15(spark, d):
    """SHA-256 of the canonical feature vector text per row, for tracing."""
    g = daily.gold(spark, d)
    return g.select("symbol", "date", V.features_hash(g, HASH_FEATS).alias("features_hash"))


