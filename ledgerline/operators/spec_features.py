"""Spec feature groups FE01-FE33 (2.12) as Spark windows.

Conventions: windows are per symbol by date over rows (trading days);
``lookback n`` means NULL until n non-null inputs exist (no partial windows);
the price column is a parameter (``adj_close`` in the spec, ``close`` by
default as in the code, T04).  Cross-sectional steps partition by date
groups; index, calendar and macro series are one row per (market, date) and
are broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sliding import Extreme, Moments, sliding_extremes, sliding_moments, sliding_sums
from ..util import safe_corr, sdiv

# ---- fixed thresholds of the spec ----------------------------------------------
NEAR_52W_HIGH, NEAR_52W_LOW = -0.05, 0.10
NEAR_RESISTANCE, NEAR_SUPPORT = -0.03, 0.05
VOLUME_SPIKE = 2.0
DELIVERY_SPIKE = 1.5
HAMMER_WICK, HAMMER_OTHER, DOJI_BODY = 2.0, 0.3, 0.1
INSTITUTIONAL_HIGH = 0.70
TRADING_DAYS_YEAR = 252
MONTH_END_DAYS, QUARTER_END_DAYS = 3, 5
MIN_HISTORY_CORE, MIN_HISTORY_52W = 63, 252
# --------------------------------------------------------------------------------


def _w(by="symbol", order="date") -> Window:
    by = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*by).orderBy(order)


def rolling(fn, c: str | Column, n: int, w: Window | None = None) -> Column:
    """``fn`` over the last n rows; NULL until n non-null inputs exist."""
    w = w or _w()
    x = F.col(c) if isinstance(c, str) else c
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(x).over(frame) >= n, fn(x).over(frame))


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


# FE01 -----------------------------------------------------------------------------
def returns(df: DataFrame, price: str = "close", horizons=(1, 5, 10, 21, 63)) -> DataFrame:
    w = _w()
    return df.select("*", *[(sdiv(F.col(price), F.lag(price, n).over(w)) - 1.0).alias(f"return_{n}d")
                            for n in horizons])


# FE02, FE03 --------------------------------------------------------------------------
def return_moments(df: DataFrame, ret: str = "return_1d") -> DataFrame:
    n = 21.0
    own = df.columns
    df = df.select("*", rolling(F.avg, ret, 5).alias("rolling_mean_return_5d"), rolling(F.avg, ret, 21).alias("rolling_mean_return_21d"),
                   rolling(F.stddev_samp, ret, 5).alias("rolling_std_return_5d"))
    df = sliding_moments(df, [Moments(ret, 21, "__m", (2, 3, 4))])
    m2 = F.col("__m2")
    g1 = F.try_divide(math.sqrt(n) * F.col("__m3"), F.sqrt(m2 * m2 * m2))
    g2 = F.try_divide(n * F.col("__m4"), m2 * m2) - 3.0
    return df.select(
        *own, "rolling_mean_return_5d", "rolling_mean_return_21d", "rolling_std_return_5d",
        F.sqrt(m2 / (n - 1)).alias("rolling_std_return_21d"),
        (g1 * math.sqrt(n * (n - 1)) / (n - 2)).alias("rolling_skew_21d"),
        ((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("rolling_kurt_21d"),
    )


# FE05 ---------------------------------------------------------------------------------
def band_features(df: DataFrame, price: str = "close") -> DataFrame:
    """Needs atr_14 and the Bollinger columns (features.technical_indicators)."""
    return df.select(
        "*", sdiv("atr_14", price).alias("atr_14_pct"),
        sdiv(F.col(price) - F.col("bbl_20_2_0"), F.col("bbu_20_2_0") - F.col("bbl_20_2_0")).alias("bb_pct"),
        sdiv(F.col("bbu_20_2_0") - F.col("bbl_20_2_0"), F.col("bbm_20_2_0")).alias("bb_width"))


# FE06 ---------------------------------------------------------------------------------
def moving_averages(df: DataFrame, price: str = "close") -> DataFrame:
    df = df.select("*", rolling(F.avg, price, 10).alias("sma_10"), rolling(F.avg, price, 50).alias("sma_50"))
    return df.select("*", (sdiv(price, "sma_10") - 1.0).alias("price_vs_sma_10"),
                     (sdiv(price, "sma_50") - 1.0).alias("price_vs_sma_50"),
                     F.when(F.col("sma_10").isNotNull() & F.col("sma_50").isNotNull(),
                            F.when(F.col("sma_10") > F.col("sma_50"), 1).otherwise(-1)).alias("sma_cross_signal"))


# FE07 ---------------------------------------------------------------------------------
def range_52w(df: DataFrame, price: str = "close") -> DataFrame:
    """Strict 252-row high / low of the price (T21: unlike W09's min 1 row)."""
    df = sliding_extremes(df, [Extreme(price, TRADING_DAYS_YEAR, "high_52w", strict=True),
                               Extreme(price, TRADING_DAYS_YEAR, "low_52w", largest=False, strict=True)])
    df = df.select("*", (sdiv(F.col(price) - F.col("high_52w"), "high_52w")).alias("pct_from_52w_high"),
                   (sdiv(F.col(price) - F.col("low_52w"), "low_52w")).alias("pct_from_52w_low"))
    return df.select("*", _flag(F.col("pct_from_52w_high") > NEAR_52W_HIGH).alias("near_52w_high_flag"),
                     _flag(F.col("pct_from_52w_low") < NEAR_52W_LOW).alias("near_52w_low_flag"))


# FE08, FE09 ---------------------------------------------------------------------------
def index_returns(index: DataFrame) -> DataFrame:
    """(market_context, date, close) -> index_return_21d / 63d."""
    w = _w("market_context")
    return index.select("market_context", "date",
                        (sdiv(F.col("close"), F.lag("close", 21).over(w)) - 1.0).alias("index_return_21d"),
                        (sdiv(F.col("close"), F.lag("close", 63).over(w)) - 1.0).alias("index_return_63d"))


def relative_strength(df: DataFrame, index: DataFrame, tier_col: str = "cap_tier") -> DataFrame:
    """Needs return_21d / return_63d.  The index table is one row per
    (market, date) - bounded by the calendar - so it is broadcast."""
    ix = index_returns(index)
    j = df.join(F.broadcast(ix), ["market_context", "date"], "left")
    j = j.select("*", (F.col("return_63d") - F.col("index_return_63d")).alias("rs_vs_index_63d"),
                 (F.col("return_21d") - F.col("index_return_21d")).alias("rs_vs_index_21d"))
    if tier_col in j.columns:
        # exact percentile within (date, tier, market) without a one-task-per-day window
        from ..functions.ranking import rank_within

        j = rank_within(j, ["date", tier_col, "market_context"], "rs_vs_index_63d", "__pr")
        j = j.withColumn("rs_rank_63d", F.col("__pr") * 100.0).drop("__pr")
    return j.drop("index_return_21d", "index_return_63d")


# FE10, FE11 ---------------------------------------------------------------------------
def swing_levels(df: DataFrame, price: str = "close") -> DataFrame:
    w = _w()
    df = df.select("*", rolling(F.max, "high", 20).alias("swing_high_20d"),
                   rolling(F.min, "low", 20).alias("swing_low_20d"))
    df = df.select("*", sdiv(F.col(price) - F.col("swing_high_20d"), "swing_high_20d").alias("pct_from_swing_high"),
                   sdiv(F.col(price) - F.col("swing_low_20d"), "swing_low_20d").alias("pct_from_swing_low"))
    h1, h2 = F.lag("high", 1).over(w), F.lag("high", 2).over(w)
    l1, l2 = F.lag("low", 1).over(w), F.lag("low", 2).over(w)
    return df.select(
        "*", _flag(F.col("pct_from_swing_high") > NEAR_RESISTANCE).alias("near_resistance_flag"),
        _flag(F.col("pct_from_swing_low") < NEAR_SUPPORT).alias("near_support_flag"),
        _flag((h1 > h2) & (h1 > F.col("high"))).alias("pivot_high"),
        _flag((l1 < l2) & (l1 < F.col("low"))).alias("pivot_low"))


# FE12-FE17 ----------------------------------------------------------------------------
def volume_features(df: DataFrame, price: str = "close") -> DataFrame:
    w = _w()
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rng = F.col("high") - F.col("low")
    clv = F.when(rng == 0, F.lit(0.0)).otherwise(((F.col("close") - F.col("low")) - (F.col("high") - F.col("close"))) / rng)
    bp = F.when(rng == 0, F.lit(0.5)).otherwise((F.col("close") - F.col("low")) / rng)
    step = F.signum(F.col(price) - F.lag(price, 1).over(w)) * F.col("volume")
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3.0
    df = df.select("*", (F.row_number().over(w) - 1).cast("double").alias("__x"), clv.alias("clv"),
                   bp.alias("buy_pressure_pct"), F.coalesce(step, F.lit(0.0)).alias("__obv_step"),
                   tp.alias("__tp"), rolling(F.avg, "volume", 21).alias("volume_21d_avg"))
    tpl = F.lag("__tp", 1).over(w)
    flow = F.col("__tp") * F.col("volume")
    df = df.select("*", F.sum("__obv_step").over(run).alias("obv"),
                   F.sum(F.col("clv") * F.col("volume")).over(run).alias("ad_line"),
                   F.when(F.col("__tp") > tpl, flow).otherwise(F.lit(0.0)).alias("__pos"),
                   F.when(F.col("__tp") < tpl, flow).otherwise(F.lit(0.0)).alias("__neg"),
                   F.when(tpl.isNotNull(), 1).alias("__has_prev"),
                   sdiv("volume", "volume_21d_avg").alias("volume_ratio"))
    f5 = w.rowsBetween(-4, Window.currentRow)
    f21 = w.rowsBetween(-20, Window.currentRow)
    f14 = w.rowsBetween(-13, Window.currentRow)
    n5 = F.count("volume").over(f5) >= 5
    df = df.select(
        "*",
        _flag(F.col("volume_ratio") > VOLUME_SPIKE).alias("volume_spike_flag"),
        F.when(n5, F.regr_slope(F.col("volume").cast("double"), "__x").over(f5)).alias("volume_trend_5d"),
        F.when(n5, F.regr_slope("obv", "__x").over(f5)).alias("obv_slope_5d"),
        F.when(n5, F.regr_slope("ad_line", "__x").over(f5)).alias("ad_line_slope_5d"),
        F.when(F.count(price).over(f21) >= 21, safe_corr(price, "volume", f21))
        .alias("price_volume_correlation_21d"),
        rolling(F.avg, "obv", 10).alias("__obv_sma"),
        F.when(F.sum("__has_prev").over(f14) >= 14, F.sum("__pos").over(f14)).alias("__p14"),
        F.when(F.sum("__has_prev").over(f14) >= 14, F.sum("__neg").over(f14)).alias("__n14"),
    )
    mfi = F.when(F.col("__n14") == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col("__p14") / F.col("__n14")))
    df = df.select("*", sdiv(F.col("obv") - F.col("__obv_sma"), "__obv_sma").alias("obv_vs_sma_10"),
                   F.when(F.col("__p14").isNotNull(), mfi).alias("mfi_14"))
    return df.drop(*[c for c in df.columns if c.startswith("__")])


# FE18 -----------------------------------------------------------------------------------
def delivery_features(df: DataFrame) -> DataFrame:
    """NULL for us symbols (T20); needs volume_ratio."""
    india = F.col("market_context") == "india"
    dp = F.when(india, F.col("delivery_pct"))
    df = df.select("*", dp.alias("__dp"))
    df = df.select("*", rolling(F.avg, "__dp", 21).alias("delivery_pct_21d_avg"))
    df = df.select("*", sdiv("__dp", "delivery_pct_21d_avg").alias("delivery_pct_ratio"))
    df = df.select("*", F.when(india, _flag((F.col("delivery_pct_ratio") > DELIVERY_SPIKE)
                                            & (F.col("volume_ratio") > DELIVERY_SPIKE)))
                   .alias("delivery_volume_spike_flag"))
    return df.drop("__dp")


# FE19-FE21 ------------------------------------------------------------------------------
def volatility(df: DataFrame, price: str = "close") -> DataFrame:
    w = _w()
    lr = F.log(sdiv(F.col(price), F.lag(price, 1).over(w)))
    df = df.select("*", lr.alias("__lr"),
                   (0.5 * F.pow(F.log(sdiv("high", "low")), 2)
                    - (2 * math.log(2) - 1) * F.pow(F.log(sdiv("close", "open")), 2)).alias("__gk"),
                   sdiv(F.col("high") - F.col("low"), F.col(price)).alias("__hl"))
    df = sliding_moments(df, [Moments("__lr", 10, "__a"), Moments("__lr", 21, "__b")])
    ann = math.sqrt(TRADING_DAYS_YEAR)
    df = df.select("*", (F.sqrt(F.col("__a2") / 9.0) * ann).alias("realized_vol_10d"),
                   (F.sqrt(F.col("__b2") / 20.0) * ann).alias("realized_vol_21d"),
                   rolling(F.avg, "__gk", 21).alias("__gkm"),
                   rolling(F.avg, "__hl", 5).alias("high_low_range_5d"))
    df = df.select("*", sdiv("realized_vol_10d", "realized_vol_21d").alias("vol_ratio"),
                   F.when(F.col("__gkm") >= 0, F.sqrt(F.col("__gkm") * TRADING_DAYS_YEAR)).alias("garman_klass_vol_21d"))
    return df.drop("__lr", "__gk", "__hl", "__gkm", "__a2", "__b2")


# FE22 ------------------------------------------------------------------------------------
def index_features(index: DataFrame, macro_daily: DataFrame | None = None) -> DataFrame:
    """Per (market_context, date): index_return_21d, index_vs_sma_50 and,
    with a daily macro table (date, vix, repo rate), vix_level,
    vix_vs_21d_avg and macro_rate.  The 2Y yield has no source: the spread
    is NULL."""
    w = _w("market_context")
    out = index.select("market_context", "date", "close",
                       (sdiv(F.col("close"), F.lag("close", 21).over(w)) - 1.0).alias("index_return_21d"),
                       rolling(F.avg, "close", 50, w).alias("__sma50"))
    out = out.select("*", (sdiv("close", "__sma50") - 1.0).alias("index_vs_sma_50")).drop("__sma50")
    if macro_daily is not None:
        m = macro_daily.select("date", F.col("india_vix_close").alias("vix_level"),
                               F.col("rbi_repo_rate").alias("macro_rate"))
        out = out.join(F.broadcast(m), ["date"], "left")  # one row per date
        out = out.select("*", (sdiv("vix_level", rolling(F.avg, "vix_level", 21, w)) - 1.0).alias("vix_vs_21d_avg"))
    out = out.withColumn("macro_yield_spread", F.lit(None).cast("double"))
    return out.drop("close")


# FE23, FE24 ---------------------------------------------------------------------------
def trading_calendar(df: DataFrame) -> DataFrame:
    """(market_context, date) trading days with month-end / quarter-end
    flags.  One row per market-day: small, built by aggregation."""
    cal = df.select("market_context", "date").distinct()
    ym = Window.partitionBy("market_context", F.year("date"), F.month("date")).orderBy(F.col("date").desc())
    yq = Window.partitionBy("market_context", F.year("date"), F.quarter("date")).orderBy(F.col("date").desc())
    return cal.select("market_context", "date",
                      _flag(F.row_number().over(ym) <= MONTH_END_DAYS).alias("is_month_end"),
                      _flag(F.row_number().over(yq) <= QUARTER_END_DAYS).alias("is_quarter_end"))


def calendar_features(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    cal = calendar if calendar is not None else trading_calendar(df)
    out = df.select("*", ((F.dayofweek("date") + 5) % 7).alias("day_of_week"), F.month("date").alias("month"),
                    F.quarter("date").alias("quarter"))
    return out.join(F.broadcast(cal), ["market_context", "date"], "left")


# FE25-FE27 -------------------------------------------------------------------------------
def candles(df: DataFrame) -> DataFrame:
    """Needs return_5d (trend context)."""
    w = _w()
    o, h, l, c = F.col("open"), F.col("high"), F.col("low"), F.col("close")
    body = F.abs(c - o)
    upper = h - F.greatest(o, c)
    lower = F.least(o, c) - l
    rng = h - l
    df = df.select("*", body.alias("body"), upper.alias("upper_shadow"), lower.alias("lower_shadow"),
                   rng.alias("candle_range"))
    down = F.coalesce(F.col("return_5d") < 0, F.lit(False))
    up = F.coalesce(F.col("return_5d") > 0, F.lit(False))
    b, us, ls, r = F.col("body"), F.col("upper_shadow"), F.col("lower_shadow"), F.col("candle_range")
    ok = r > 0
    pb, po, pc = F.lag("body", 1).over(w), F.lag("open", 1).over(w), F.lag("close", 1).over(w)
    long_lower = (ls >= HAMMER_WICK * b) & (us <= HAMMER_OTHER * b) & (b > 0)
    long_upper = (us >= HAMMER_WICK * b) & (ls <= HAMMER_OTHER * b) & (b > 0)
    return df.select(
        "*",
        _flag(ok & long_lower & down).alias("hammer_flag"),
        _flag(ok & long_upper & down).alias("inverted_hammer_flag"),
        _flag(ok & long_upper & up).alias("shooting_star_flag"),
        _flag(ok & (c > o) & (o < pc) & (c > po) & (b > pb) & down).alias("bullish_engulfing_flag"),
        _flag(ok & (c < o) & (o > pc) & (c < po) & (b > pb) & up).alias("bearish_engulfing_flag"),
        _flag(ok & (b <= DOJI_BODY * r)).alias("doji_flag"),
    )


# FE28 --------------------------------------------------------------------------------------
def wyckoff(df: DataFrame) -> DataFrame:
    """Needs near_support_flag / near_resistance_flag, obv_slope_5d, volume_ratio."""
    vr = F.col("volume_ratio") > 1.0
    return df.select("*", _flag((F.col("near_support_flag") == 1) & (F.col("obv_slope_5d") > 0) & vr)
                     .alias("wyckoff_accumulation_proxy"),
                     _flag((F.col("near_resistance_flag") == 1) & (F.col("obv_slope_5d") < 0) & vr)
                     .alias("wyckoff_distribution_proxy"))


# FE29 --------------------------------------------------------------------------------------
def institutional_flags(fund: DataFrame) -> DataFrame:
    """From bronze fundamentals; pledging has no source column (NULL)."""
    return fund.select("*", F.when(F.col("held_percent_institutions").isNotNull(),
                                   _flag(F.col("held_percent_institutions") > INSTITUTIONAL_HIGH))
                       .alias("institutional_high_flag"),
                       F.lit(None).cast("int").alias("promoter_pledging_flag"))


# FE30 --------------------------------------------------------------------------------------
def oscillators(df: DataFrame, price: str = "close") -> DataFrame:
    w = _w()
    lo, hi = rolling(F.min, "low", 14), rolling(F.max, "high", 14)
    df = df.select("*", lo.alias("__lo"), hi.alias("__hi"))
    df = df.select("*", (sdiv(F.col(price) - F.col("__lo"), F.col("__hi") - F.col("__lo")) * 100.0).alias("stoch_k_14"),
                   ((sdiv(F.col(price), F.lag(price, 5).over(w)) - 1.0) * 100.0).alias("roc_5"),
                   ((sdiv(F.col(price), F.lag(price, 10).over(w)) - 1.0) * 100.0).alias("roc_10"))
    return df.select("*", rolling(F.avg, "stoch_k_14", 3).alias("stoch_d_3")).drop("__lo", "__hi")


# FE31 --------------------------------------------------------------------------------------
def drawdown(df: DataFrame, price: str = "close") -> DataFrame:
    """drawdown_252d: distance of the price to its highest of the last 252 rows."""
    df = sliding_extremes(df, [Extreme(price, TRADING_DAYS_YEAR, "__peak")])
    return df.select("*", (sdiv(F.col(price), "__peak") - 1.0).alias("drawdown_252d")).drop("__peak")


def quant_extras(df: DataFrame, price: str = "close", ret: str = "return_1d", lags=(1, 2, 3, 4, 5),
                 window: int = 63, z: float = 3.0) -> DataFrame:
    """Drawdown, autocorrelations and the capped return.  The moments of a frame
    come from its sums (``sliding_sums``); those of the lagged return are the
    return's own, ``k`` rows earlier.  A return that does not vary in the frame
    has no correlation."""
    w = _w()
    df = drawdown(df, price)
    own = df.columns
    df = df.select("*", F.col(ret).cast("double").alias("__x"), F.when(F.col(ret).isNotNull(), 1.0).alias("__one"),
                   *[F.lag(ret, k).over(w).cast("double").alias(f"__r{k}") for k in lags])
    df = df.select("*", (F.col("__x") * F.col("__x")).alias("__xx"), *[(F.col("__x") * F.col(f"__r{k}")).alias(f"__xr{k}") for k in lags])
    df = sliding_extremes(df, [Extreme("__x", window, "__hi"), Extreme("__x", window, "__lo", largest=False)])
    df = sliding_sums(df, {"__n": "__one", "__s": "__x", "__ss": "__xx", **{f"__s{k}": f"__xr{k}" for k in lags}}, window)
    n = float(window)
    full = F.col("__n") >= window
    mean = F.col("__s") / n
    df = df.select("*", F.when(full, mean).alias("__mu"), F.when(full, F.when(F.col("__hi") == F.col("__lo"), 0.0).otherwise(
        F.greatest(F.col("__ss") / n - mean * mean, F.lit(0.0)))).alias("__var"))
    cols = []
    for k in lags:
        var = F.lag("__var", k).over(w)
        cov = F.col(f"__s{k}") / n - F.col("__mu") * F.lag("__mu", k).over(w)
        cols.append(F.try_divide(cov, F.sqrt("__var") * F.sqrt(var)).alias(f"autocorr_lag{k}_{window}d"))
    sd = F.sqrt(F.col("__var") * (n / (n - 1.0)))
    capped = F.least(F.greatest(F.col(ret), F.col("__mu") - z * sd), F.col("__mu") + z * sd)
    return df.select(*own, *cols, F.when(F.col(ret).isNull(), F.lit(None)).when(F.col("__var").isNotNull(), capped)
                     .otherwise(F.col(ret)).alias(f"{ret}_capped"))


# FE32 --------------------------------------------------------------------------------------
def min_history(df: DataFrame, n: int = MIN_HISTORY_CORE) -> DataFrame:
    """Drop symbols with fewer than n rows (count per symbol, joined back)."""
    c = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= n).select("symbol")
    return df.join(c, ["symbol"], "left_semi")


# FE33 --------------------------------------------------------------------------------------
def resample_bars(df: DataFrame, unit: str = "week") -> DataFrame:
    """Weekly / monthly bars: first open, max high, min low, last close,
    total volume (partial aggregate with min_by / max_by)."""
    p = F.date_trunc(unit, F.col("date").cast("timestamp")).cast("date").alias("period_start")
    return (df.groupBy("symbol", p)
            .agg(F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 F.max_by("close", "date").alias("close"), F.sum("volume").alias("volume"),
                 F.count(F.lit(1)).alias("n_days")))
