"""Registered queries for the spec feature groups FE01-FE33 (on silver rows)."""

from __future__ import annotations

import math

from ..operators import regime as RG
from ..operators import spec_features as SF
from ..sources import landing as L
from ..sources import landing_text as LT
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from ..util import exact_avg_sql, safe_corr_sql
from .catalog import query


def _w(part="symbol", n=None, order="date", unbounded=False):
    if unbounded:
        return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    if n:
        return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(PARTITION BY {part} ORDER BY {order})"


def rs(fn, x, n, part="symbol"):
    """Strict rolling aggregate SQL (NULL until n non-null inputs)."""
    return f"CASE WHEN count({x}) OVER {_w(part, n)} >= {n} THEN {fn}({x}) OVER {_w(part, n)} END"


def ret(n, price="close", part="symbol"):
    return f"({price} / NULLIF(lag({price}, {n}) OVER {_w(part)}, 0) - 1)"


def _silver(spark, d):
    return daily.silver(spark, d)


def _sel(df, cols):
    return df.select("symbol", "date", *cols)


# ------------------------------------------------------------------------ FE01
RET_COLS = [f"return_{n}d" for n in (1, 5, 10, 21, 63)]
FE01 = "SELECT symbol, date, " + ", ".join(f"{ret(n)} AS return_{n}d" for n in (1, 5, 10, 21, 63)) + " FROM silver"


@query("fe01_returns", O.cte(["silver"], FE01), RET_COLS)
def fe01(spark, d):
    """FE01: 1/5/10/21/63-row returns (NULL without enough history)."""
    return _sel(SF.returns(_silver(spark, d)), RET_COLS)


# ------------------------------------------------------------------------ FE02-03
MOM_COLS = ["rolling_mean_return_5d", "rolling_mean_return_21d", "rolling_std_return_5d", "rolling_std_return_21d",
            "rolling_skew_21d", "rolling_kurt_21d"]
FE02 = f"""
SELECT symbol, date, {rs('avg', 'r', 5)} AS rolling_mean_return_5d, {rs('avg', 'r', 21)} AS rolling_mean_return_21d,
       {rs('stddev_samp', 'r', 5)} AS rolling_std_return_5d, {rs('stddev_samp', 'r', 21)} AS rolling_std_return_21d,
       {rs('skewness', 'r', 21)} AS rolling_skew_21d, {rs('kurtosis', 'r', 21)} AS rolling_kurt_21d
FROM (SELECT symbol, date, {ret(1)} AS r FROM silver) t"""


@query("fe02_fe03_return_moments", O.cte(["silver"], FE02),
       {**{c: 6 for c in MOM_COLS[:4]}, "rolling_skew_21d": 5, "rolling_kurt_21d": 5})
def fe02(spark, d):
    """FE02-FE03: rolling mean / sample std (5, 21) and sample skew / excess kurtosis (21)."""
    return _sel(SF.return_moments(SF.returns(_silver(spark, d), horizons=(1,))), MOM_COLS)


# ------------------------------------------------------------------------ FE05
@query("fe05_band_features", O.cte(["gold_s4"], """
SELECT symbol, date, atr_raw / NULLIF(close, 0) AS atr_14_pct,
       (close - (bbm - 2.0 * sd)) / NULLIF((bbm + 2.0 * sd) - (bbm - 2.0 * sd), 0) AS bb_pct,
       ((bbm + 2.0 * sd) - (bbm - 2.0 * sd)) / NULLIF(bbm, 0) AS bb_width
FROM gold_s4"""), {"atr_14_pct": 5, "bb_pct": 5, "bb_width": 6})
def fe05(spark, d):
    """FE04-FE05: ATR as % of price, position in and width of the Bollinger bands."""
    return _sel(SF.band_features(daily.gold(spark, d, keep_nulls=True)), ["atr_14_pct", "bb_pct", "bb_width"])


# ------------------------------------------------------------------------ FE06
FE06 = f"""
SELECT symbol, date, sma_10, sma_50, close / NULLIF(sma_10, 0) - 1 AS price_vs_sma_10,
       close / NULLIF(sma_50, 0) - 1 AS price_vs_sma_50,
       CASE WHEN sma_10 IS NULL OR sma_50 IS NULL THEN NULL WHEN sma_10 > sma_50 THEN 1 ELSE -1 END AS sma_cross_signal
FROM (SELECT symbol, date, close, {rs('avg', 'close', 10)} AS sma_10, {rs('avg', 'close', 50)} AS sma_50 FROM silver) t"""


@query("fe06_moving_averages", O.cte(["silver"], FE06), ["sma_10", "sma_50", "price_vs_sma_10", "price_vs_sma_50"])
def fe06(spark, d):
    """FE06: SMA 10 / 50, distance to them and the cross signal."""
    return _sel(SF.moving_averages(_silver(spark, d)),
                ["sma_10", "sma_50", "price_vs_sma_10", "price_vs_sma_50", "sma_cross_signal"])


# ------------------------------------------------------------------------ FE07
FE07 = f"""
SELECT symbol, date, high_52w, low_52w, p_hi AS pct_from_52w_high, p_lo AS pct_from_52w_low,
       CASE WHEN p_hi > -0.05 THEN 1 ELSE 0 END AS near_52w_high_flag,
       CASE WHEN p_lo < 0.10 THEN 1 ELSE 0 END AS near_52w_low_flag
FROM (SELECT *, (close - high_52w) / NULLIF(high_52w, 0) AS p_hi, (close - low_52w) / NULLIF(low_52w, 0) AS p_lo
      FROM (SELECT symbol, date, close, {rs('max', 'close', 252)} AS high_52w, {rs('min', 'close', 252)} AS low_52w
            FROM silver) a) b"""


@query("fe07_range_52w", O.cte(["silver"], FE07), ["high_52w", "low_52w", "pct_from_52w_high", "pct_from_52w_low"])
def fe07(spark, d):
    """FE07: strict 252-row high / low of the price, distance and near flags."""
    return _sel(SF.range_52w(_silver(spark, d)), ["high_52w", "low_52w", "pct_from_52w_high", "pct_from_52w_low",
                                                  "near_52w_high_flag", "near_52w_low_flag"])


# ------------------------------------------------------------------------ FE08-09
FE08 = f"""
SELECT symbol, date, cap_tier, rs63 AS rs_vs_index_63d, rs21 AS rs_vs_index_21d,
       CASE WHEN rs63 IS NOT NULL THEN percent_rank() OVER (PARTITION BY date, cap_tier, market_context, rs63 IS NOT NULL
                                                           ORDER BY rs63) * 100.0 END AS rs_rank_63d
FROM (SELECT s.symbol, s.date, s.market_context, t.cap_tier, s.r63 - i.i63 AS rs63, s.r21 - i.i21 AS rs21
      FROM (SELECT symbol, date, market_context, {ret(63)} AS r63, {ret(21)} AS r21 FROM silver) s
      LEFT JOIN (SELECT market_context, date, {ret(21, part='market_context')} AS i21,
                        {ret(63, part='market_context')} AS i63 FROM idx) i
        ON s.market_context = i.market_context AND s.date = i.date
      LEFT JOIN cap_tiers t ON s.symbol = t.symbol) q"""


@query("fe08_fe09_relative_strength", O.cte(["silver", "idx", "cap_tiers"], FE08),
       ["rs_vs_index_63d", "rs_vs_index_21d", "rs_rank_63d"])
def fe08(spark, d):
    """FE08-FE09: return vs the market index (21, 63) and the percentile rank
    of the 63-day figure within (date, cap tier, market)."""
    s = _silver(spark, d)
    x = SF.returns(s, horizons=(21, 63)).join(TV.cap_tiers(spark, d).select("symbol", "cap_tier"), ["symbol"], "left")
    out = SF.relative_strength(x, RG.index_series(s))
    return _sel(out, ["cap_tier", "rs_vs_index_63d", "rs_vs_index_21d", "rs_rank_63d"])


# ------------------------------------------------------------------------ FE10-11
FE10 = f"""
SELECT symbol, date, swing_high_20d, swing_low_20d, ph AS pct_from_swing_high, pl AS pct_from_swing_low,
       CASE WHEN ph > -0.03 THEN 1 ELSE 0 END AS near_resistance_flag,
       CASE WHEN pl < 0.05 THEN 1 ELSE 0 END AS near_support_flag,
       CASE WHEN h1 > h2 AND h1 > high THEN 1 ELSE 0 END AS pivot_high,
       CASE WHEN l1 < l2 AND l1 < low THEN 1 ELSE 0 END AS pivot_low
FROM (SELECT *, (close - swing_high_20d) / NULLIF(swing_high_20d, 0) AS ph,
             (close - swing_low_20d) / NULLIF(swing_low_20d, 0) AS pl
      FROM (SELECT symbol, date, close, high, low, {rs('max', 'high', 20)} AS swing_high_20d,
                   {rs('min', 'low', 20)} AS swing_low_20d,
                   lag(high, 1) OVER {_w()} AS h1, lag(high, 2) OVER {_w()} AS h2,
                   lag(low, 1) OVER {_w()} AS l1, lag(low, 2) OVER {_w()} AS l2 FROM silver) a) b"""
SWING_COLS = ["swing_high_20d", "swing_low_20d", "pct_from_swing_high", "pct_from_swing_low",
              "near_resistance_flag", "near_support_flag", "pivot_high", "pivot_low"]


@query("fe10_fe11_swing_levels", O.cte(["silver"], FE10), SWING_COLS[:4])
def fe10(spark, d):
    """FE10-FE11: 20-row swing high / low, distances, near flags, pivots seen at T."""
    return _sel(SF.swing_levels(_silver(spark, d)), SWING_COLS)


# ------------------------------------------------------------------------ FE12-17
VOL_BODY = f"""
SELECT symbol, date, clv, buy_pressure_pct, obv, ad_line, volume_21d_avg, volume_ratio, volume_spike_flag,
       volume_trend_5d, obv_slope_5d, ad_line_slope_5d, price_volume_correlation_21d,
       (obv - obv_sma) / NULLIF(obv_sma, 0) AS obv_vs_sma_10,
       CASE WHEN p14 IS NULL THEN NULL WHEN n14 = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + p14 / n14) END AS mfi_14
FROM (
  SELECT *, CASE WHEN volume_ratio > 2.0 THEN 1 ELSE 0 END AS volume_spike_flag,
         CASE WHEN count(volume) OVER {_w(n=5)} >= 5 THEN regr_slope(CAST(volume AS DOUBLE), x) OVER {_w(n=5)} END
           AS volume_trend_5d,
         CASE WHEN count(volume) OVER {_w(n=5)} >= 5 THEN regr_slope(obv, x) OVER {_w(n=5)} END AS obv_slope_5d,
         CASE WHEN count(volume) OVER {_w(n=5)} >= 5 THEN regr_slope(ad_line, x) OVER {_w(n=5)} END AS ad_line_slope_5d,
         CASE WHEN count(close) OVER {_w(n=21)} >= 21 THEN {safe_corr_sql('close', 'volume', _w(n=21))} END
           AS price_volume_correlation_21d,
         {rs('avg', 'obv', 10)} AS obv_sma,
         CASE WHEN sum(has_prev) OVER {_w(n=14)} >= 14 THEN sum(pos) OVER {_w(n=14)} END AS p14,
         CASE WHEN sum(has_prev) OVER {_w(n=14)} >= 14 THEN sum(neg) OVER {_w(n=14)} END AS n14
  FROM (
    SELECT *, sum(obv_step) OVER {_w(unbounded=True)} AS obv, sum(clv * volume) OVER {_w(unbounded=True)} AS ad_line,
           CASE WHEN tp > lag(tp) OVER {_w()} THEN tp * volume ELSE 0.0 END AS pos,
           CASE WHEN tp < lag(tp) OVER {_w()} THEN tp * volume ELSE 0.0 END AS neg,
           CASE WHEN lag(tp) OVER {_w()} IS NOT NULL THEN 1 END AS has_prev,
           volume / NULLIF(volume_21d_avg, 0) AS volume_ratio
    FROM (
      SELECT symbol, date, open, high, low, close, volume, market_context, delivery_pct,
             CAST(row_number() OVER {_w()} - 1 AS DOUBLE) AS x,
             CASE WHEN high - low = 0 THEN 0.0 ELSE ((close - low) - (high - close)) / (high - low) END AS clv,
             CASE WHEN high - low = 0 THEN 0.5 ELSE (close - low) / (high - low) END AS buy_pressure_pct,
             COALESCE(CAST(sign(close - lag(close) OVER {_w()}) AS DOUBLE) * volume, 0.0) AS obv_step,
             (high + low + close) / 3.0 AS tp, {rs('avg', 'volume', 21)} AS volume_21d_avg
      FROM silver) a) b) c"""
VOL_COLS = ["clv", "buy_pressure_pct", "obv", "ad_line", "volume_21d_avg", "volume_ratio", "volume_spike_flag",
            "volume_trend_5d", "obv_slope_5d", "ad_line_slope_5d", "price_volume_correlation_21d", "obv_vs_sma_10",
            "mfi_14"]
VOL_DIGITS = {"clv": 6, "buy_pressure_pct": 6, "obv": 6, "ad_line": 4, "volume_21d_avg": 6, "volume_ratio": 6,
              "volume_trend_5d": 5, "obv_slope_5d": 4, "ad_line_slope_5d": 4, "price_volume_correlation_21d": 6,
              "obv_vs_sma_10": 6, "mfi_14": 4}


@query("fe12_fe17_volume_features", O.cte(["silver"], VOL_BODY), VOL_DIGITS)
def fe12(spark, d):
    """FE12-FE17: volume baseline / ratio / spike, slopes, price-volume
    correlation, OBV, CLV, buying pressure, A/D line, MFI 14."""
    return _sel(SF.volume_features(_silver(spark, d)), VOL_COLS)


# ------------------------------------------------------------------------ FE18
FE18 = f"""
SELECT symbol, date, delivery_pct_21d_avg, dr AS delivery_pct_ratio,
       CASE WHEN market_context = 'india' THEN CASE WHEN dr > 1.5 AND vr > 1.5 THEN 1 ELSE 0 END END
         AS delivery_volume_spike_flag
FROM (SELECT *, dp / NULLIF(delivery_pct_21d_avg, 0) AS dr, volume / NULLIF(v21, 0) AS vr
      FROM (SELECT symbol, date, market_context, volume, dp, {rs('avg', 'dp', 21)} AS delivery_pct_21d_avg,
                   {rs('avg', 'volume', 21)} AS v21
            FROM (SELECT *, CASE WHEN market_context = 'india' THEN delivery_pct END AS dp FROM silver) s) a) b"""


@query("fe18_delivery_features", O.cte(["silver"], FE18), ["delivery_pct_21d_avg", "delivery_pct_ratio"])
def fe18(spark, d):
    """FE18: delivery baseline, ratio and delivery + volume spike (NULL for us)."""
    s = SF.volume_features(_silver(spark, d))
    return _sel(SF.delivery_features(s), ["delivery_pct_21d_avg", "delivery_pct_ratio", "delivery_volume_spike_flag"])


# ------------------------------------------------------------------------ FE19-21
_GK = f"(0.5 * pow(ln(high / NULLIF(low, 0)), 2) - {2 * math.log(2) - 1!r} * pow(ln(close / NULLIF(open, 0)), 2))"
FE19 = f"""
SELECT symbol, date, rv10 AS realized_vol_10d, rv21 AS realized_vol_21d, rv10 / NULLIF(rv21, 0) AS vol_ratio,
       CASE WHEN gkm >= 0 THEN sqrt(gkm * 252) END AS garman_klass_vol_21d, high_low_range_5d
FROM (SELECT symbol, date, {rs('stddev_samp', 'lr', 10)} * {math.sqrt(252)!r} AS rv10,
             {rs('stddev_samp', 'lr', 21)} * {math.sqrt(252)!r} AS rv21, {rs('avg', 'gk', 21)} AS gkm,
             {rs('avg', 'hl', 5)} AS high_low_range_5d
      FROM (SELECT symbol, date, ln(close / NULLIF(lag(close) OVER {_w()}, 0)) AS lr, {_GK} AS gk,
                   (high - low) / NULLIF(close, 0) AS hl FROM silver) a) b"""
VOLA_COLS = ["realized_vol_10d", "realized_vol_21d", "vol_ratio", "garman_klass_vol_21d", "high_low_range_5d"]


@query("fe19_fe21_volatility", O.cte(["silver"], FE19), VOLA_COLS)
def fe19(spark, d):
    """FE19-FE21: annualised realised vol 10/21, ratio, Garman-Klass 21, mean range 5."""
    return _sel(SF.volatility(_silver(spark, d)), VOLA_COLS)


# ------------------------------------------------------------------------ FE22
_MACRO_DAY = f"""
SELECT CAST(o_orderdate AS DATE) AS date,
       CASE WHEN count(*) >= 5 THEN {exact_avg_sql('o_totalprice')} / 10000.0 END AS vix,
       CASE WHEN count(*) > 6 THEN ROUND(min(o_totalprice) / 20000.0 * 100) / 100
            ELSE ROUND({exact_avg_sql('o_totalprice')} / 50000.0 * 100) / 100 END AS repo
FROM orders GROUP BY 1"""
FE22 = f"""
SELECT market_context, date, index_return_21d, index_vs_sma_50, vix_level, macro_rate,
       vix_level / NULLIF({rs('avg', 'vix_level', 21, 'market_context')}, 0) - 1 AS vix_vs_21d_avg,
       CAST(NULL AS DOUBLE) AS macro_yield_spread
FROM (SELECT market_context, date, {ret(21, part='market_context')} AS index_return_21d,
             close / NULLIF({rs('avg', 'close', 50, 'market_context')}, 0) - 1 AS index_vs_sma_50,
             vix AS vix_level, repo AS macro_rate
      FROM (SELECT i.*, m.vix, m.repo FROM idx i LEFT JOIN md m ON i.date = m.date) j) q"""


def macro_daily(spark, d):
    """Daily macro inputs parsed from the landing documents (R10 + R11)."""
    v = L.scan_macro_prices_json(LT.macro_price_docs(spark, d)).select("date", "india_vix_close")
    r = L.extract_macro_html(LT.macro_html_pages(spark, d)).select("date", "rbi_repo_rate")
    return v.join(r, ["date"], "full_outer")


@query("fe22_index_features", O.cte(["idx", "md"], FE22, {"md": _MACRO_DAY}),
       ["index_return_21d", "index_vs_sma_50", "vix_level", "macro_rate", "vix_vs_21d_avg", "macro_yield_spread"])
def fe22(spark, d):
    """FE22: market-level index return, index vs SMA 50, VIX level and trend, policy rate."""
    return SF.index_features(RG.index_series(_silver(spark, d)), macro_daily(spark, d))


# ------------------------------------------------------------------------ FE23-24
FE23 = """
SELECT s.symbol, s.date, CAST(isodow(s.date) - 1 AS INTEGER) AS day_of_week, CAST(month(s.date) AS INTEGER) AS month,
       CAST(quarter(s.date) AS INTEGER) AS quarter, c.is_month_end, c.is_quarter_end
FROM silver s LEFT JOIN (
  SELECT market_context, date,
         CASE WHEN row_number() OVER (PARTITION BY market_context, year(date), month(date) ORDER BY date DESC) <= 3
              THEN 1 ELSE 0 END AS is_month_end,
         CASE WHEN row_number() OVER (PARTITION BY market_context, year(date), quarter(date) ORDER BY date DESC) <= 5
              THEN 1 ELSE 0 END AS is_quarter_end
  FROM (SELECT DISTINCT market_context, date FROM silver) d) c
ON s.market_context = c.market_context AND s.date = c.date"""


@query("fe23_fe24_calendar_features", O.cte(["silver"], FE23))
def fe23(spark, d):
    """FE23-FE24: weekday (0 = Monday), month, quarter, last 3 / 5 trading days of month / quarter."""
    return _sel(SF.calendar_features(_silver(spark, d)),
                ["day_of_week", "month", "quarter", "is_month_end", "is_quarter_end"])


# ------------------------------------------------------------------------ FE25-27
FE25 = f"""
SELECT symbol, date, body, upper_shadow, lower_shadow, candle_range,
  CASE WHEN candle_range > 0 AND lower_shadow >= 2.0 * body AND upper_shadow <= 0.3 * body AND body > 0 AND dn
       THEN 1 ELSE 0 END AS hammer_flag,
  CASE WHEN candle_range > 0 AND upper_shadow >= 2.0 * body AND lower_shadow <= 0.3 * body AND body > 0 AND dn
       THEN 1 ELSE 0 END AS inverted_hammer_flag,
  CASE WHEN candle_range > 0 AND upper_shadow >= 2.0 * body AND lower_shadow <= 0.3 * body AND body > 0 AND up
       THEN 1 ELSE 0 END AS shooting_star_flag,
  CASE WHEN candle_range > 0 AND close > open AND open < pc AND close > po AND body > pb AND dn THEN 1 ELSE 0 END
       AS bullish_engulfing_flag,
  CASE WHEN candle_range > 0 AND close < open AND open > pc AND close < po AND body > pb AND up THEN 1 ELSE 0 END
       AS bearish_engulfing_flag,
  CASE WHEN candle_range > 0 AND body <= 0.1 * candle_range THEN 1 ELSE 0 END AS doji_flag
FROM (SELECT *, lag(body) OVER {_w()} AS pb, lag(open) OVER {_w()} AS po, lag(close) OVER {_w()} AS pc
      FROM (SELECT symbol, date, open, close, abs(close - open) AS body, high - greatest(open, close) AS upper_shadow,
                   least(open, close) - low AS lower_shadow, high - low AS candle_range,
                   COALESCE({ret(5)} < 0, false) AS dn, COALESCE({ret(5)} > 0, false) AS up
            FROM silver) a) b"""
CANDLE_COLS = ["body", "upper_shadow", "lower_shadow", "candle_range", "hammer_flag", "inverted_hammer_flag",
               "shooting_star_flag", "bullish_engulfing_flag", "bearish_engulfing_flag", "doji_flag"]


@query("fe25_fe27_candles", O.cte(["silver"], FE25), CANDLE_COLS[:4])
def fe25(spark, d):
    """FE25-FE27: candle geometry and pattern flags with 5-day trend context."""
    return _sel(SF.candles(SF.returns(_silver(spark, d), horizons=(5,))), CANDLE_COLS)


# ------------------------------------------------------------------------ FE28
@query("fe28_wyckoff_proxies", O.cte(["sw", "vo"], """
SELECT sw.symbol, sw.date,
  CASE WHEN sw.near_support_flag = 1 AND vo.obv_slope_5d > 0 AND vo.volume_ratio > 1.0 THEN 1 ELSE 0 END
    AS wyckoff_accumulation_proxy,
  CASE WHEN sw.near_resistance_flag = 1 AND vo.obv_slope_5d < 0 AND vo.volume_ratio > 1.0 THEN 1 ELSE 0 END
    AS wyckoff_distribution_proxy
FROM sw JOIN vo ON sw.symbol = vo.symbol AND sw.date = vo.date""", {"sw": FE10, "vo": VOL_BODY},
                                       {"sw": ["silver"], "vo": ["silver"]}))
def fe28(spark, d):
    """FE28: accumulation / distribution proxies from swing, OBV slope and volume."""
    s = SF.volume_features(SF.swing_levels(_silver(spark, d)))
    return _sel(SF.wyckoff(s), ["wyckoff_accumulation_proxy", "wyckoff_distribution_proxy"])


# ------------------------------------------------------------------------ FE29
@query("fe29_institutional_flags", f"""
SELECT ('S' || CAST(s_suppkey AS VARCHAR) || CASE s_suppkey % 3 WHEN 0 THEN '.NS' WHEN 1 THEN '.BO' ELSE '' END)
         AS symbol, disc AS held_percent_institutions,
       CASE WHEN disc IS NULL THEN NULL WHEN disc > 0.70 THEN 1 ELSE 0 END AS institutional_high_flag,
       CAST(NULL AS INTEGER) AS promoter_pledging_flag
FROM supplier LEFT JOIN (SELECT l_suppkey, {exact_avg_sql('l_discount')} AS disc FROM lineitem GROUP BY 1) a
  ON s_suppkey = a.l_suppkey""", ["held_percent_institutions"])
def fe29(spark, d):
    """FE29: institutional holding above 70 %; pledging has no source (NULL)."""
    f = L.flatten_fundamentals_json(LT.fundamentals_docs(spark, d))
    return SF.institutional_flags(f).select("symbol", "held_percent_institutions", "institutional_high_flag",
                                            "promoter_pledging_flag")


# ------------------------------------------------------------------------ FE30
FE30 = f"""
SELECT symbol, date, k AS stoch_k_14, roc_5, roc_10, {rs('avg', 'k', 3)} AS stoch_d_3
FROM (SELECT symbol, date, (close - lo) / NULLIF(hi - lo, 0) * 100.0 AS k, {ret(5)} * 100.0 AS roc_5,
             {ret(10)} * 100.0 AS roc_10
      FROM (SELECT symbol, date, close, {rs('min', 'low', 14)} AS lo, {rs('max', 'high', 14)} AS hi FROM silver) a) b"""


@query("fe30_oscillators", O.cte(["silver"], FE30), ["stoch_k_14", "roc_5", "roc_10", "stoch_d_3"], digits=5)
def fe30(spark, d):
    """FE30: stochastic %K 14 / %D 3 and rate of change 5 / 10."""
    return _sel(SF.oscillators(_silver(spark, d)), ["stoch_k_14", "roc_5", "roc_10", "stoch_d_3"])


# ------------------------------------------------------------------------ FE31
_AC = ", ".join(
    f"CASE WHEN count(CASE WHEN r IS NOT NULL AND r{k} IS NOT NULL THEN 1 END) OVER {_w(n=63)} >= 63 "
    f"THEN {safe_corr_sql('r', f'r{k}', _w(n=63))} END AS autocorr_lag{k}_63d" for k in range(1, 6))
FE31 = f"""
SELECT symbol, date, drawdown_252d, {", ".join(f"autocorr_lag{k}_63d" for k in range(1, 6))},
  CASE WHEN r IS NULL THEN NULL WHEN sd IS NOT NULL THEN least(greatest(r, mu - 3.0 * sd), mu + 3.0 * sd) ELSE r END
    AS return_1d_capped
FROM (SELECT *, {_AC}, {rs('avg', 'r', 63)} AS mu, {rs('stddev_samp', 'r', 63)} AS sd
      FROM (SELECT symbol, date, close / NULLIF(max(close) OVER {_w(n=252)}, 0) - 1 AS drawdown_252d, r,
                   {", ".join(f"lag(r, {k}) OVER {_w()} AS r{k}" for k in range(1, 6))}
            FROM (SELECT *, {ret(1)} AS r FROM silver) s) a) b"""
FE31_COLS = ["drawdown_252d"] + [f"autocorr_lag{k}_63d" for k in range(1, 6)] + ["return_1d_capped"]


@query("fe31_quant_extras", O.cte(["silver"], FE31), FE31_COLS)
def fe31(spark, d):
    """FE31: rolling drawdown, return autocorrelation lags 1-5 (63), z-score capped return."""
    return _sel(SF.quant_extras(SF.returns(_silver(spark, d), horizons=(1,))), FE31_COLS)


# ------------------------------------------------------------------------ FE32
@query("fe32_min_history", O.cte(["silver"], """
SELECT symbol, date FROM silver WHERE symbol IN (SELECT symbol FROM silver GROUP BY symbol HAVING count(*) >= 63)"""))
def fe32(spark, d):
    """FE32: only symbols with at least 63 rows of history."""
    return SF.min_history(_silver(spark, d)).select("symbol", "date")


# ------------------------------------------------------------------------ FE33
def _resample_sql(unit):
    return f"""
SELECT symbol, CAST(date_trunc('{unit}', date) AS DATE) AS period_start, arg_min(open, date) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_days
FROM silver GROUP BY 1, 2"""


@query("fe33_weekly_bars", O.cte(["silver"], _resample_sql("week")), ["open", "high", "low", "close"])
def fe33w(spark, d):
    """FE33: weekly bars (first open, max high, min low, last close, total volume)."""
    return SF.resample_bars(_silver(spark, d), "week")


@query("fe33_monthly_bars", O.cte(["silver"], _resample_sql("month")), ["open", "high", "low", "close"])
def fe33m(spark, d):
    """FE33: monthly bars."""
    return SF.resample_bars(_silver(spark, d), "month")


