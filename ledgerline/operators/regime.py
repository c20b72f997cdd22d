"""Market regime (W11-W13, J13) and the regime specs M01-M07, M10.

The index series is one row per (market_context, date): small and bounded
by the calendar.  When no index symbol is given, the index is the equal
weight mean close of all symbols of the market that day, aggregated first
(partial aggregate) so the window never sees row-level data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SMA_LONG, SMA_SHORT = 50, 21
BULL, BEAR, SIDEWAYS, HIGH_VOL = "bull_trend", "bear_trend", "sideways", "high_vol"


def index_series(silver: DataFrame, index_symbols: dict[str, str] | None = None) -> DataFrame:
    """(market_context, date, close) of the market index.

    ``index_symbols`` maps market_context to an index symbol (F18 filter,
    pushed to the scan); otherwise an equal-weight mean close is used.
    """
    if index_symbols:
        ctx = F.create_map(*[x for k, v in index_symbols.items() for x in (F.lit(v), F.lit(k))])
        return (silver.filter(F.col("symbol").isin(list(index_symbols.values())))
                .select(ctx[F.col("symbol")].alias("market_context"), "date", "close"))
    return silver.groupBy("market_context", "date").agg(F.avg("close").alias("close"))


def market_regime(index: DataFrame) -> DataFrame:
    """sma_50 / sma_21 (min 1 row) and the label per market and date.

    close > sma_50 is bull_trend, close < sma_50 bear_trend, else sideways
    (so the first row is always sideways).
    """
    w = Window.partitionBy("market_context").orderBy("date")
    sma50 = F.avg("close").over(w.rowsBetween(-(SMA_LONG - 1), Window.currentRow))
    sma21 = F.avg("close").over(w.rowsBetween(-(SMA_SHORT - 1), Window.currentRow))
    df = index.select("market_context", "date", "close", sma50.alias("index_sma_50"),
                      sma21.alias("index_sma_21"))
    label = (F.when(F.col("close") > F.col("index_sma_50"), F.lit(BULL))
             .when(F.col("close") < F.col("index_sma_50"), F.lit(BEAR)).otherwise(F.lit(SIDEWAYS)))
    return df.select("date", "market_context", label.alias("regime_label"),
                     F.col("close").alias("index_close"), "index_sma_50", "index_sma_21")


def regime_raw(index: DataFrame, vix: DataFrame | None = None, slope_days: int = 5,
               flat_slope: float = 0.001, vix_threshold: float = 25.0) -> DataFrame:
    """Bull / bear / sideways / high_vol from the 50-day mean, its slope
    and (optionally) a volatility index (market_context, date, vix).

    The slope is the relative change of the 50-day mean over ``slope_days``;
    below ``flat_slope`` in size the market is sideways.  The VIX threshold is
    a parameter (the source config is absent).
    """
    r = market_regime(index)
    w = Window.partitionBy("market_context").orderBy("date")
    slope = F.try_divide(F.col("index_sma_50"), F.lag("index_sma_50", slope_days).over(w)) - 1.0
    r = r.withColumn("sma_slope", slope)
    if vix is not None:
        r = r.join(vix.select("market_context", "date", "vix"), ["market_context", "date"], "left")
    else:
        r = r.withColumn("vix", F.lit(None).cast("double"))
    lab = (F.when(F.col("vix") > vix_threshold, F.lit(HIGH_VOL))
           .when(F.col("sma_slope").isNull() | (F.abs(F.col("sma_slope")) < flat_slope), F.lit(SIDEWAYS))
           .when((F.col("index_close") > F.col("index_sma_50")) & (F.col("sma_slope") > 0), F.lit(BULL))
           .when((F.col("index_close") < F.col("index_sma_50")) & (F.col("sma_slope") < 0), F.lit(BEAR))
           .otherwise(F.lit(SIDEWAYS)))
    return r.withColumn("regime_raw", lab)


def regime_buffer(df: DataFrame, label: str = "regime_raw", confirm: int = 3,
                  by: str = "market_context", order: str = "date") -> DataFrame:
    """A new label takes effect only after ``confirm`` consecutive days;
    until then the previous confirmed label holds (gaps and islands)."""
    w = Window.partitionBy(by).orderBy(order)
    chg = F.when(F.lag(label).over(w).isNull() | (F.lag(label).over(w) != F.col(label)), 1).otherwise(0)
    df = df.withColumn("__isl", F.sum(chg).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run_len = F.row_number().over(Window.partitionBy(by, "__isl").orderBy(order))
    df = df.withColumn("__run", run_len)
    confirmed = F.last(F.when(F.col("__run") >= confirm, F.col(label)), ignorenulls=True) \
        .over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("regime_label_buffered", confirmed).drop("__isl", "__run")


def regime_instability(df: DataFrame, label: str = "regime_label_buffered", days: int = 20,
                       max_transitions: int = 4, by: str = "market_context", order: str = "date") -> DataFrame:
    """More than ``max_transitions`` label changes in ``days`` rows."""
    w = Window.partitionBy(by).orderBy(order)
    chg = F.when(F.lag(label).over(w).isNotNull() & (F.lag(label).over(w) != F.col(label)), 1).otherwise(0)
    df = df.withColumn("__chg", chg)
    n = F.sum("__chg").over(w.rowsBetween(-(days - 1), 0))
    return df.withColumn("transitions_20d", n).withColumn("regime_unstable", n > max_transitions).drop("__chg")


def breadth(features: DataFrame, ret: str = "return_1d") -> DataFrame:
    """Share of advancing symbols per (market_context, date) (aggregate first)."""
    return (features.groupBy("market_context", "date")
            .agg(F.avg(F.when(F.col(ret) > 0, 1.0).otherwise(0.0)).alias("breadth"),
                 F.count(F.lit(1)).alias("n_symbols")))


def regime_conditional_moments(features: DataFrame, regime: DataFrame, ret: str = "return_1d") -> DataFrame:
    """Return moments per regime label (regime is one row per market-day)."""
    j = features.select("market_context", "date", ret).join(
        regime.select("market_context", "date", "regime_label"), ["market_context", "date"])
    return (j.groupBy("market_context", "regime_label")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(ret).alias("mean_return"),
                 F.stddev_samp(ret).alias("std_return"), F.skewness(ret).alias("skew_pop"),
                 F.kurtosis(ret).alias("kurt_pop")))


def dow_trend(df: DataFrame) -> DataFrame:
    """Dow trend from the last two swing highs and lows (pivots seen at
    T for T-1, FE11): 'up' when both the latest pivot high and pivot low are
    above the previous ones, 'down' when both are below, else 'none'."""
    w = Window.partitionBy("symbol").orderBy("date")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    h1, h2, l1, l2 = (F.lag("high", 1).over(w), F.lag("high", 2).over(w), F.lag("low", 1).over(w),
                      F.lag("low", 2).over(w))
    df = df.select("*", F.when((h1 > h2) & (h1 > F.col("high")), h1).alias("__ph"),
                   F.when((l1 < l2) & (l1 < F.col("low")), l1).alias("__pl"))
    df = df.select("*", F.last("__ph", ignorenulls=True).over(run).alias("last_pivot_high"),
                   F.last("__pl", ignorenulls=True).over(run).alias("last_pivot_low"))
    # previous pivot = the running value one row before a new pivot row
    df = df.select("*", F.when(F.col("__ph").isNotNull(), F.lag("last_pivot_high", 1).over(w)).alias("__pph"),
                   F.when(F.col("__pl").isNotNull(), F.lag("last_pivot_low", 1).over(w)).alias("__ppl"))
    df = df.select("*", F.last("__pph", ignorenulls=True).over(run).alias("prev_pivot_high"),
                   F.last("__ppl", ignorenulls=True).over(run).alias("prev_pivot_low"))
    hh = F.col("last_pivot_high") > F.col("prev_pivot_high")
    hl = F.col("last_pivot_low") > F.col("prev_pivot_low")
    lh = F.col("last_pivot_high") < F.col("prev_pivot_high")
    ll = F.col("last_pivot_low") < F.col("prev_pivot_low")
    trend = F.when(hh & hl, F.lit("up")).when(lh & ll, F.lit("down")).otherwise(F.lit("none"))
    return df.withColumn("dow_trend", trend).drop("__ph", "__pl", "__pph", "__ppl")


def signal_ic(df: DataFrame, signal: str, forward: str, min_names: int = 3) -> DataFrame:
    """Per-date rank correlation of a signal and the forward return
    (Spearman on min-rank percentiles; exact bucketed ranks per date)."""
    from ..functions.ranking import rank_many
    from ..util import safe_corr

    d = df.filter(F.col(signal).isNotNull() & F.col(forward).isNotNull()).select("date", signal, forward)
    r = rank_many(d, ["date"], [(signal, "__rs"), (forward, "__rf")])
    g = r.groupBy("date").agg(F.count(F.lit(1)).alias("n_names"), safe_corr("__rs", "__rf").alias("__c"))
    return g.select("date", "n_names", F.when(F.col("n_names") >= min_names, F.col("__c")).alias("ic"))


def ic_summary(ic: DataFrame) -> DataFrame:
    """M07 stability: mean, std and their ratio over dates (one row)."""
    g = ic.agg(F.count("ic").alias("n_dates"), F.avg("ic").alias("mean_ic"), F.stddev_samp("ic").alias("std_ic"))
    return g.withColumn("ic_ir", F.try_divide(F.col("mean_ic"), F.col("std_ic")))


MACRO_STALE_DAYS = 35
RATE_TREND_LOOKBACK = 63
#: Changes of the inflation and activity series below this size are flat.
FLAT_TREND = 0.02


def macro_series(daily: DataFrame, value: str, lookback: int, lag_days: int, relative: bool = False) -> DataFrame:
    """(available, reference, value, change) of one series: ``available`` is its
    date plus the release lag, ``change`` against ``lookback`` records before.
    One row per date of the series."""
    one = daily.filter(F.col(value).isNotNull()).groupBy("date").agg(F.max(value).cast("double").alias("value"))
    back = F.lag("value", lookback).over(Window.orderBy("date"))  # one row per release
    change = F.try_divide(F.col("value"), back) - 1.0 if relative else F.col("value") - back
    return one.select(F.date_add("date", lag_days).alias("available"), F.col("date").alias("reference"), "value", change.alias("change"))


def carried_series(calendar: DataFrame, series: dict[str, DataFrame]) -> DataFrame:
    """One row per calendar date with, per series, a struct (available,
    reference, value, change) of the newest release by then.

    All series and the calendar fold into one row per date, whatever they
    repeat, and one ordered pass carries them all."""
    found = calendar.groupBy("date").agg(F.lit(True).alias("__day"))
    for name, s in series.items():
        newest = s.groupBy(F.col("available").alias("date")).agg(
            F.max(F.struct("reference", "available", "value", "change")).alias(name))
        found = found.join(newest, "date", "full_outer")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # one row per date
    return found.select("date", "__day", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in series]).filter("__day").drop("__day")


def macro_regime_inputs(calendar: DataFrame, series: dict[str, DataFrame]) -> DataFrame:
    """Rate, inflation, activity and yield-spread inputs per trading day,
    each from its newest release by then, and the macro regime.

    ``series`` (``macro_series`` frames): rate, long_yield, inflation, growth.
    A series released over 35 days ago is stale, which makes its state neutral
    (rate) or unknown.  Regime: expanding activity is expansion, or conflict if
    prices and rates both point against it; contracting activity is stagflation
    while prices rise, else contraction; neutral without activity or prices."""
    c = carried_series(calendar, series)

    def fresh(name: str) -> Column:
        return F.coalesce(F.datediff("date", F.col(f"{name}.available")) <= MACRO_STALE_DAYS, F.lit(False))

    def state(name: str, up: str, flat: str, down: str, least: float, unknown: str | None) -> Column:
        change = F.col(f"{name}.change")
        return (F.when(~fresh(name), F.lit(unknown)).when(change > least, F.lit(up)).when(change < -least, F.lit(down))
                .when(change.isNotNull() | F.lit(unknown is not None), F.lit(flat)))

    out = c.select(
        "date", F.col("rate.reference").alias("macro_asof_date"), F.col("rate.value").alias("macro_rate"),
        F.col("rate.change").alias("rate_change_63"), F.datediff("date", F.col("rate.reference")).alias("macro_age_days"),
        F.col("inflation.change").alias("inflation_trend"), F.datediff("date", F.col("inflation.available")).alias("inflation_age_days"),
        F.col("growth.change").alias("growth_trend"), F.datediff("date", F.col("growth.available")).alias("growth_age_days"),
        (F.col("long_yield.value") - F.col("rate.value")).alias("yield_spread"),
        state("rate", "tightening", "stable", "easing", 0.0, "neutral").alias("macro_regime_input"),
        state("inflation", "rising", "flat", "falling", FLAT_TREND, None).alias("inflation_state"),
        state("growth", "expanding", "flat", "contracting", FLAT_TREND, None).alias("growth_state"))
    rising, growing = F.col("inflation_state") == "rising", F.col("growth_state") == "expanding"
    against = rising & (F.col("macro_regime_input") == "tightening")
    regime = (F.when(F.col("inflation_state").isNull() | F.col("growth_state").isNull(), F.lit("neutral"))
              .when(growing & against, F.lit("conflict")).when(growing, F.lit("expansion"))
              .when(rising, F.lit("stagflation")).when(F.col("growth_state") == "contracting", F.lit("contraction"))
              .otherwise(F.lit("neutral")))
    return out.withColumn("macro_regime", regime)


#: Share of advancing symbols beyond which breadth votes, and the least confidence of a label that is passed on.
BREADTH_BAND = 0.05
CONFIDENCE_FLOOR = 0.5


def breadth_confidence(breadth_days: DataFrame, labels: DataFrame, vix_threshold: float = 25.0, band: float = BREADTH_BAND,
                       floor: float = CONFIDENCE_FLOOR) -> DataFrame:
    """Breadth per (market_context, date) with the confidence of the
    regime label.

    Trend (index against its 50-day mean, with its slope), breadth (share of
    advancing symbols beyond 0.5 by ``band``) and volatility (VIX below or above
    the threshold) vote +1, 0 or -1; regime_confidence is the share of the known
    votes that equal the trend's.  A label below ``floor`` is not passed on: the
    last one above it holds.  breadth_conflict marks that trend and breadth
    point in opposite directions.

    ``labels``: rows of ``regime_buffer(regime_raw(...))``."""
    slope = F.coalesce(F.signum("sma_slope"), F.lit(0.0))
    above = F.signum(F.col("index_close") - F.col("index_sma_50"))
    trend = F.when(above == slope, above).otherwise(F.lit(0.0)).cast("int")
    wide = F.when(F.col("breadth") > 0.5 + band, 1).when(F.col("breadth") < 0.5 - band, -1).otherwise(0)
    calm = F.when(F.col("vix").isNotNull(), F.when(F.col("vix") > vix_threshold, -1).otherwise(1))
    j = breadth_days.join(labels.select("market_context", "date", "index_close", "index_sma_50", "sma_slope", "vix",
                                        "regime_label_buffered"), ["market_context", "date"], "left")
    j = j.select("market_context", "date", "breadth", "n_symbols", "regime_label_buffered", trend.alias("trend_vote"),
                 wide.alias("breadth_vote"), calm.alias("volatility_vote"))
    votes = [F.col("breadth_vote"), F.col("volatility_vote")]
    agree = F.lit(1) + votes[0].eqNullSafe(F.col("trend_vote")).cast("int") + (
        votes[1].isNotNull() & votes[1].eqNullSafe(F.col("trend_vote"))).cast("int")
    j = j.withColumn("regime_confidence", agree / (F.lit(2) + votes[1].isNotNull().cast("int")))
    j = j.withColumn("breadth_conflict", F.col("trend_vote") * F.col("breadth_vote") < 0)
    w = Window.partitionBy("market_context").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(F.col("regime_confidence") >= floor, F.col("regime_label_buffered")), ignorenulls=True).over(w)
    return j.withColumn("regime_label_held", held)
