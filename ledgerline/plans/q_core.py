"""Registered queries: bars, gate, silver, lifecycle, gold features, regime."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gate as G
from ..operators import silver as SV
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from .catalog import query

OHLC = ["open", "high", "low", "close"]
EMA_DIGITS = 4

# ---------------------------------------------------------------- bars / gate


@query("bars_ohlcv", O.cte(["bars"], "SELECT * FROM bars"), OHLC)
def bars_ohlcv(spark, d):
    """Daily OHLCV bars derived from line items (the bronze price input)."""
    return TV.bars(spark, d)


GATE_ASOF = "2001-06-29"  # a Friday: cutoff is the next Monday (Q05)
_TICK_ORDER = ["seq_order", "seq_line", "seq_part"]


def _gate_verdicts(spark, d):
    return G.verdicts(TV.raw_ticks(spark, d), TV.universe(spark, d), GATE_ASOF, batch_cols=["date"])


_G_CUTOFF = (f"(DATE '{GATE_ASOF}' + CAST(CASE dayofweek(DATE '{GATE_ASOF}') WHEN 5 THEN 3 WHEN 6 THEN 2 "
             f"ELSE 1 END AS INTEGER))")
_G_REASONS = f"""
SELECT t.* EXCLUDE (ratio), list_filter([
    CASE WHEN t.ratio > 0.05 THEN 'batch_missing_ratio' END,
    CASE WHEN NOT COALESCE(symbol IS NOT NULL AND date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND NOT isnan(high)
                  AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL, false) THEN 'missing_field' END,
    CASE WHEN NOT COALESCE(open > 0 AND high > 0 AND NOT isnan(high) AND low > 0 AND close > 0, false) THEN 'non_positive_price' END,
    CASE WHEN NOT COALESCE(volume >= 0, false) THEN 'negative_volume' END,
    CASE WHEN NOT COALESCE(high >= low AND NOT isnan(high), false) THEN 'high_below_low' END,
    CASE WHEN NOT COALESCE(TRY_CAST(date AS DATE) <= {_G_CUTOFF}, false) THEN 'bad_or_future_date' END,
    CASE WHEN symbol IS NULL OR symbol NOT IN (SELECT symbol FROM universe) THEN 'not_in_universe' END
  ], lambda x: x IS NOT NULL) AS g0_reasons
FROM (SELECT *, avg(CASE WHEN symbol IS NULL OR date IS NULL OR open IS NULL OR high IS NULL OR isnan(high) OR low IS NULL
                            OR close IS NULL OR volume IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY date) AS ratio
      FROM raw_ticks) t"""
_GATE_EXTRA = {"g0": _G_REASONS}
_GATE_DEPS = {"g0": ["raw_ticks", "universe"]}
_TICK_COLS = "symbol, date, open, high, low, close, volume, seq_order, seq_line, seq_part"


@query("q07_g0_passing_rows", O.cte(["g0"], f"""
SELECT {_TICK_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, TRY_CAST(date AS DATE)
                               ORDER BY seq_order, seq_line, seq_part) AS rk
  FROM g0 WHERE len(g0_reasons) = 0) t WHERE rk = 1""", _GATE_EXTRA, _GATE_DEPS), OHLC)
def g0_passing_rows(spark, d):
    """Q02-Q07: rows passing every rule of their daily batch, first per (symbol, date)."""
    return G.passing_rows(_gate_verdicts(spark, d), _TICK_ORDER)


@query("g14_g0_rejected_rows", O.cte(["g0"], f"""
SELECT * REPLACE (CASE WHEN NOT isnan(high) THEN high END AS high) FROM (
  SELECT {_TICK_COLS}, array_to_string(g0_reasons, ',') AS reasons FROM g0 WHERE len(g0_reasons) > 0) q""",
                                     _GATE_EXTRA, _GATE_DEPS), OHLC)
def g0_rejected_rows(spark, d):
    """Rejected rows with their reason codes (the quarantine set)."""
    r = G.rejected_rows(_gate_verdicts(spark, d))
    reasons = F.array_join(F.col("g0_reasons"), ",")
    high = F.nanvl("high", F.lit(None).cast("double")).alias("high")
    return r.select("symbol", "date", *[high if c == "high" else c for c in OHLC], "volume", *_TICK_ORDER, reasons.alias("reasons"))


@query("q08_g0_audit_by_batch", O.cte(["g0"], """
SELECT a.date, a.input_count, COALESCE(p.pass_count, 0) AS pass_count, a.reject_count,
       a.pre_pass - COALESCE(p.pass_count, 0) AS duplicate_count,
       CASE WHEN a.batch_failed THEN 'FAIL' WHEN a.reject_count = 0 THEN 'PASS'
            WHEN a.pre_pass > 0 THEN 'PARTIAL' ELSE 'FAIL' END AS status
FROM (SELECT date, count(*) AS input_count, count_if(len(g0_reasons) = 0) AS pre_pass,
             count_if(len(g0_reasons) > 0) AS reject_count,
             bool_or(list_contains(g0_reasons, 'batch_missing_ratio')) AS batch_failed
      FROM g0 GROUP BY date) a
LEFT JOIN (SELECT date, count(DISTINCT (symbol, TRY_CAST(date AS DATE))) AS pass_count
           FROM g0 WHERE len(g0_reasons) = 0 GROUP BY date) p ON a.date = p.date""", _GATE_EXTRA, _GATE_DEPS))
def g0_audit(spark, d):
    """Q01 + Q08 + A05: per-batch counts and PASS / PARTIAL / FAIL status."""
    return G.audit_by_batch(_gate_verdicts(spark, d), ["date"], _TICK_ORDER)


@query("q01_g0_missing_ratio", O.cte(["raw_ticks"], """
SELECT date, count(*) AS input_count,
       avg(CASE WHEN symbol IS NULL OR date IS NULL OR open IS NULL OR high IS NULL OR isnan(high) OR low IS NULL
                     OR close IS NULL OR volume IS NULL THEN 1 ELSE 0 END) AS missing_ratio,
       avg(CASE WHEN symbol IS NULL OR date IS NULL OR open IS NULL OR high IS NULL OR isnan(high) OR low IS NULL
                     OR close IS NULL OR volume IS NULL THEN 1 ELSE 0 END) > 0.05 AS batch_rejected
FROM raw_ticks GROUP BY date"""), ["missing_ratio"])
def g0_missing_ratio(spark, d):
    """Share of records with a missing mandatory field per batch."""
    t = TV.raw_ticks(spark, d)
    nulls = G.any_mandatory_null(t)
    return (t.groupBy("date").agg(F.count(F.lit(1)).alias("input_count"),
                                   F.avg(nulls.cast("double")).alias("missing_ratio"))
            .withColumn("batch_rejected", F.col("missing_ratio") > G.MISSING_FIELD_RATIO_THRESHOLD))


# ---------------------------------------------------------------- silver

SILVER_DOUBLES = OHLC + ["circuit_band", "sentiment_score", "delivery_pct", "gold_usd", "crude_oil_usd", "gold_inr"]


@query("jn7_grand_join", O.cte(["silver"], "SELECT * FROM silver"), SILVER_DOUBLES)
def grand_join(spark, d):
    """JN1-JN5, JN7, F16, R14: bronze OHLCV left joined to every source."""
    return daily.silver(spark, d).drop("silver_ingestion_timestamp")


@query("a01_first_listed_date", O.cte(["lifecycle"], "SELECT * FROM lifecycle"))
def first_listed(spark, d):
    """First listed date per symbol."""
    return SV.stock_lifecycle(daily.silver(spark, d)).drop("last_updated_timestamp")


@query("jn6_join_lifecycle", O.cte(["silver", "lifecycle"], """
SELECT s.symbol, s.date, s.close, lc.first_listed_date FROM silver s LEFT JOIN lifecycle lc ON s.symbol = lc.symbol"""),
       ["close"])
def join_lifecycle(spark, d):
    """JN6: silver rows with the symbol's first listed date."""
    s = daily.silver(spark, d)
    return SV.join_lifecycle(s, SV.stock_lifecycle(s)).select("symbol", "date", "close", "first_listed_date")


@query("jn8_universe_semi", O.cte(["bars", "universe"], """
SELECT symbol, date, close FROM bars WHERE symbol IN (SELECT symbol FROM universe)"""), ["close"])
def universe_semi(spark, d):
    """JN8: keep bars of approved symbols (left semi join)."""
    return SV.universe_semi(TV.bars(spark, d).select("symbol", "date", "close"), TV.universe(spark, d))


@query("jn9_universe_anti", O.cte(["bars", "universe"], """
SELECT DISTINCT symbol FROM bars WHERE symbol NOT IN (SELECT symbol FROM universe)"""))
def universe_anti(spark, d):
    """JN9: symbols that delivered bars but are not approved (left anti)."""
    return SV.universe_anti(TV.bars(spark, d), TV.universe(spark, d))


@query("a02_symbols_passed", O.cte(["bronze"], "SELECT count(DISTINCT symbol) AS symbols_passed FROM bronze"))
def symbols_passed(spark, d):
    """Exact distinct count of symbols that passed the gate."""
    return SV.symbols_passed(daily.bronze_ohlcv(spark, d))


# ---------------------------------------------------------------- gold

GOLD_DOUBLES = {c: 6 for c in ["open", "high", "low", "close", "delivery_pct", "gold_usd", "crude_oil_usd", "gold_inr",
                               "bbl_20_2_0", "bbm_20_2_0", "bbu_20_2_0", "return_1d", "return_5d", "return_21d",
                               "high_52w", "proximity_to_52w_high", "gold_return_1d", "crude_return_1d"]}
GOLD_DOUBLES.update({c: EMA_DIGITS for c in ["rsi_14", "macd_12_26_9", "macdh_12_26_9", "macds_12_26_9", "atr_14"]})


@query("j12_gold_features", O.cte(["gold"], "SELECT * FROM gold"), GOLD_DOUBLES)
def gold_features(spark, d):
    """All technical features per symbol and date, NULLs filled with 0."""
    return daily.gold(spark, d)


def _ind(cols_sql: str):
    return O.cte(["gold_s4"], f"SELECT symbol, date, {cols_sql} FROM gold_s4")


def _gold_nulls(spark, d, cols):
    return daily.gold(spark, d, keep_nulls=True).select("symbol", "date", *cols)


@query("w01_rsi_14", _ind("""CASE WHEN eu_m IS NULL OR ed_m IS NULL THEN NULL WHEN ed_m = 0 THEN 100.0
                              ELSE 100.0 - 100.0 / (1.0 + eu_m / ed_m) END AS rsi_14"""), {"rsi_14": EMA_DIGITS})
def w01(spark, d):
    """RSI 14 with Wilder smoothing; NULL for the first 13 rows."""
    return _gold_nulls(spark, d, ["rsi_14"])


@query("w02_w04_macd", _ind("macd AS macd_12_26_9, macds AS macds_12_26_9, macd - macds AS macdh_12_26_9"),
       {"macd_12_26_9": EMA_DIGITS, "macds_12_26_9": EMA_DIGITS, "macdh_12_26_9": EMA_DIGITS})
def w02(spark, d):
    """MACD 12/26, signal 9 (seeded at the first MACD), histogram."""
    return _gold_nulls(spark, d, ["macd_12_26_9", "macds_12_26_9", "macdh_12_26_9"])


@query("w05_w06_bollinger", _ind("bbm - 2.0 * sd AS bbl_20_2_0, bbm AS bbm_20_2_0, bbm + 2.0 * sd AS bbu_20_2_0"),
       ["bbl_20_2_0", "bbm_20_2_0", "bbu_20_2_0"])
def w05(spark, d):
    """Bollinger mid and bands (population std), NULL until 20 rows."""
    return _gold_nulls(spark, d, ["bbl_20_2_0", "bbm_20_2_0", "bbu_20_2_0"])


@query("w07_atr_14", _ind("atr_raw AS atr_14"), {"atr_14": EMA_DIGITS})
def w07(spark, d):
    """ATR 14 seeded with the mean of the first 14 true ranges."""
    return _gold_nulls(spark, d, ["atr_14"])


@query("w08_returns", _ind("return_1d, return_5d, return_21d"), ["return_1d", "return_5d", "return_21d"])
def w08(spark, d):
    """1, 5 and 21 row returns (rows, not calendar days)."""
    return _gold_nulls(spark, d, ["return_1d", "return_5d", "return_21d"])


@query("w09_high_52w_proximity", _ind("high_52w, close / NULLIF(high_52w, 0) AS proximity_to_52w_high"),
       ["high_52w", "proximity_to_52w_high"])
def w09(spark, d):
    """W09 + F24: 252-row high (min 1 row) and close / high."""
    return _gold_nulls(spark, d, ["high_52w", "proximity_to_52w_high"])


@query("w10_macro_returns", _ind("gold_return_1d, crude_return_1d"), ["gold_return_1d", "crude_return_1d"])
def w10(spark, d):
    """1-row change of gold (INR) and crude within the symbol's rows, NULLs padded."""
    return _gold_nulls(spark, d, ["gold_return_1d", "crude_return_1d"])


@query("f22_f23_listing_age", _ind("""CAST(date - first_listed_date AS INTEGER) AS days_since_listed,
       COALESCE(CAST(date - first_listed_date <= 30 AS INTEGER), 0) AS is_new_listing"""))
def f22(spark, d):
    """Days since first listing and the new-listing flag (30 days)."""
    return _gold_nulls(spark, d, ["days_since_listed", "is_new_listing"])


# ---------------------------------------------------------------- regime

@query("w11_w13_market_regime", O.cte(["regime"], "SELECT * FROM regime"),
       ["index_close", "index_sma_50", "index_sma_21"])
def market_regime(spark, d):
    """Equal-weight index per market, 50/21-row means, regime label."""
    return daily.regime(spark, d)


# ---------------------------------------------------------------- flagship

FLAG_DOUBLES = {k: v for k, v in GOLD_DOUBLES.items() if k not in
                ("open", "high", "low", "delivery_pct", "gold_usd", "crude_oil_usd", "gold_inr",
                 "gold_return_1d", "crude_return_1d")}


@query("flagship_latest_signals", O.cte(["gold", "regime", "silver"], O.FLAGSHIP), FLAG_DOUBLES)
def flagship(spark, d):
    """Latest features, sector and market regime for every symbol."""
    return daily.flagship(spark, d)


