"""Gold technical features (W01-W10, F22-F25): the J12 job as windows.

All indicators are windows over ``partitionBy(symbol).orderBy(date)``; a
symbol's rows are bounded by the number of trading days, so no partition is
ever hot, and one exchange (on symbol) serves every indicator.

Indicator definitions follow the public ``ta`` package semantics:

* RSI 14: Wilder smoothing (EMA alpha 1/14, adjust=False) of the positive
  and negative parts of the 1-row change (first row counts 0); 100 when the
  down average is 0; NULL for the first 13 rows.
* MACD 12/26/9: EMA(12) - EMA(26) of close, each NULL until span rows;
  the signal is EMA(9) of the non-null MACD; histogram = MACD - signal.
* Bollinger 20/2: mean of 20 and mean -/+ 2 population std; NULL until 20.
* ATR 14: true range (first row high - low), first value = mean of the
  first 14 TR at row 14, then Wilder smoothing; NULL before (0 after F25).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.ema import EmaSpec, ema_many, with_block
from ..functions.sliding import Extreme, Moments, sliding_extremes, sliding_moments
from ..util import sdiv

RSI_WINDOW = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BB_WINDOW, BB_DEV = 20, 2.0
ATR_WINDOW = 14
HIGH_52W_ROWS = 252
RETURN_HORIZONS = (1, 5, 21)


def _w(by="symbol", order="date"):
    by, order = ([x] if isinstance(x, str) else list(x) for x in (by, order))
    return Window.partitionBy(*by).orderBy(*order)


def pct_change(c: str | Column, n: int, w: Window) -> Column:
    """Value / value n rows back - 1, after padding NULLs forward."""
    x = F.col(c) if isinstance(c, str) else c
    filled = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return sdiv(filled, F.lag(filled, n).over(w)) - 1.0


def technical_indicators(df: DataFrame, price: str = "close", by="symbol", order="date") -> DataFrame:
    """Add rsi_14, macd_12_26_9, macds_12_26_9, macdh_12_26_9, bbl/bbm/bbu_20_2_0, atr_14."""
    macd = EmaSpec.span("macd_12_26_9", MACD_SIGNAL, "macds_12_26_9")
    emas = [
        EmaSpec.wilder("__up", RSI_WINDOW, "__eu"),
        EmaSpec.wilder("__dn", RSI_WINDOW, "__ed"),
        EmaSpec.span(price, MACD_FAST, "__ef"),
        EmaSpec.span(price, MACD_SLOW, "__es"),
        EmaSpec(F.col("__atr_in"), 1.0 / ATR_WINDOW, "atr_14", 1),
    ]
    df, block = with_block(df, [*emas, macd], "__block", by, order)
    w = _w(by, ["__block", order])
    diff = F.col(price) - F.lag(price, 1).over(w)
    prev_close = F.lag(price, 1).over(w)
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev_close),
                    F.abs(F.col("low") - prev_close))
    rn = F.row_number().over(w)
    bb_frame = w.rowsBetween(-(BB_WINDOW - 1), Window.currentRow)
    atr_frame = w.rowsBetween(-(ATR_WINDOW - 1), Window.currentRow)
    df = df.select(
        "*",
        F.when(diff > 0, diff).otherwise(F.lit(0.0)).alias("__up"),
        F.when(diff < 0, -diff).otherwise(F.lit(0.0)).alias("__dn"),
        tr.alias("__tr"),
        rn.alias("__rn"),
        F.when(F.count(price).over(bb_frame) >= BB_WINDOW, F.avg(price).over(bb_frame)).alias("bbm_20_2_0"),
    )
    df = sliding_moments(df, [Moments(price, BB_WINDOW, "__bb")], by, ["__block", order],
                         beside={"__first_atr": F.avg("__tr").over(atr_frame)})
    df = df.withColumn("__sd", F.sqrt(F.col("__bb2") / float(BB_WINDOW)))
    df = df.withColumn("__atr_in", F.when(F.col("__rn") == ATR_WINDOW, F.col("__first_atr"))
                       .when(F.col("__rn") > ATR_WINDOW, F.col("__tr")))
    df = ema_many(df, emas, by, order, block, "__block")
    df = df.withColumn("macd_12_26_9", F.col("__ef") - F.col("__es"))
    df = ema_many(df, [macd], by, order, block, "__block")
    rsi = F.when(F.col("__ed") == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col("__eu") / F.col("__ed")))
    df = df.select(
        "*",
        F.when(F.col("__eu").isNotNull() & F.col("__ed").isNotNull(), rsi).alias("rsi_14"),
        (F.col("macd_12_26_9") - F.col("macds_12_26_9")).alias("macdh_12_26_9"),
        F.when(F.col("bbm_20_2_0").isNotNull(), F.col("bbm_20_2_0") - BB_DEV * F.col("__sd")).alias("bbl_20_2_0"),
        F.when(F.col("bbm_20_2_0").isNotNull(), F.col("bbm_20_2_0") + BB_DEV * F.col("__sd")).alias("bbu_20_2_0"),
    )
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def price_features(df: DataFrame, price: str = "close", by="symbol", order="date") -> DataFrame:
    """Returns, 52-week high (min 1 row) and proximity."""
    w = _w(by, order)
    cols = [pct_change(price, n, w).alias(f"return_{n}d") for n in RETURN_HORIZONS]
    df = sliding_extremes(df.select("*", *cols), [Extreme("high", HIGH_52W_ROWS, "high_52w")], by, order)
    return df.withColumn("proximity_to_52w_high", X.proximity_to_52w_high(price, "high_52w"))


GOLD_FEATURE_COLUMNS = [
    "symbol", "date", "open", "high", "low", "close", "volume", "market_context", "delivery_pct",
    "gold_usd", "crude_oil_usd", "gold_inr", "rsi_14", "macd_12_26_9", "macdh_12_26_9", "macds_12_26_9",
    "bbl_20_2_0", "bbm_20_2_0", "bbu_20_2_0", "atr_14", "return_1d", "return_5d", "return_21d", "high_52w",
    "proximity_to_52w_high", "days_since_listed", "is_new_listing", "gold_return_1d", "crude_return_1d",
]


def gold_features(silver_lc: DataFrame, price: str = "close", keep_nulls: bool = False) -> DataFrame:
    """Silver rows joined with ``first_listed_date`` -> gold features.

    ``keep_nulls=False`` reproduces the reference's final fill of numeric
    NULLs with 0 (F25); ``True`` keeps warm-up rows NULL (spec).
    """
    w = _w()
    df = silver_lc.select("symbol", "date", "open", "high", "low", "close", "volume", "market_context",
                          "delivery_pct", "gold_usd", "crude_oil_usd", "gold_inr", "first_listed_date")
    df = technical_indicators(df, price)
    df = price_features(df, price)
    days = X.days_since_listed("date", "first_listed_date")
    df = df.select("*", days.alias("days_since_listed"),
                   pct_change("gold_inr", 1, w).alias("gold_return_1d"),
                   pct_change("crude_oil_usd", 1, w).alias("crude_return_1d"))
    df = df.withColumn("is_new_listing", X.is_new_listing("days_since_listed")).drop("first_listed_date")
    df = df.select(*GOLD_FEATURE_COLUMNS)
    return df if keep_nulls else X.fill_zero(df)
