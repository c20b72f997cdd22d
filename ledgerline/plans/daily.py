"""The daily batch plan over the stand-in tables.

The bars aggregate shuffles pre-aggregated rows on (symbol, date); each source
is then hash partitioned on ``symbol`` once, and with
``spark.sql.requireAllClusterKeysForCoPartition`` off that layout serves the
(symbol, date) joins, the lifecycle and all feature windows.  Market-wide
tables (macro by date, regime by market and date) are one row per calendar
day and are broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import features as FT
from ..operators import gate as G
from ..operators import regime as RG
from ..operators import silver as SV
from ..sources import testviews as TV

#: Session setting with the date of the run; without it a run is of today.
RUN_DATE = "ledgerline.run.date"
# Stamps of the registered queries, fixed so that results can be compared.
DEFAULT_RUN_ID = "J01_20020104_000000"
DEFAULT_TS = "2002-01-04 00:00:00"


def run_date(spark: SparkSession) -> str:
    return spark.conf.get(RUN_DATE, None) or _dt.date.today().isoformat()


def bronze_ohlcv(spark: SparkSession, sf_dir: str, asof: str | None = None,
                 run_id: str = DEFAULT_RUN_ID) -> DataFrame:
    """Landing bars through the gate as of ``asof`` (the run date), stamped like bronze OHLCV."""
    b = SV.by_symbol(TV.bars(spark, sf_dir))
    v = G.verdicts(b, TV.universe(spark, sf_dir), asof or run_date(spark))
    passed = G.passing_rows(v, order=["open", "close"])
    return (passed.withColumn("market_context", X.market_context("symbol"))
            .withColumn("ingestion_run_id", F.lit(run_id)))


def trading_days(spark: SparkSession, sf_dir: str, asof: str | None = None) -> DataFrame:
    """(market_context, date) of every day on which a market has a passing
    bar: silver's days, without building silver."""
    v = G.verdicts(TV.bars(spark, sf_dir), TV.universe(spark, sf_dir), asof or run_date(spark))
    return v.where("g0_pass").select(X.market_context("symbol").alias("market_context"), "date").distinct()


def silver(spark: SparkSession, sf_dir: str, asof: str | None = None, ts: str = DEFAULT_TS,
           bronze: DataFrame | None = None) -> DataFrame:
    """J11 grand join over every stand-in source."""
    o = bronze if bronze is not None else bronze_ohlcv(spark, sf_dir, asof)
    return SV.grand_join(
        o,
        circuit=TV.circuit(spark, sf_dir),
        sentiment=TV.sentiment(spark, sf_dir),
        delivery=TV.delivery(spark, sf_dir),
        macro=TV.macro(spark, sf_dir),
        sectors=TV.sectors(spark, sf_dir),
        ingestion_ts=ts,
    )


def gold(spark: SparkSession, sf_dir: str, keep_nulls: bool = False, silver_df: DataFrame | None = None,
         ts: str = DEFAULT_TS) -> DataFrame:
    """J14 lifecycle + J12 features."""
    s = silver_df if silver_df is not None else silver(spark, sf_dir)
    # JN6 as a window: on symbol-partitioned silver the first listed date is
    # min(date) per symbol in the same pass (no second read of silver)
    return FT.gold_features(SV.with_first_listed(s), keep_nulls=keep_nulls)


def regime(spark: SparkSession, sf_dir: str, silver_df: DataFrame | None = None) -> DataFrame:
    """J13 on the equal-weight index of each market."""
    s = silver_df if silver_df is not None else silver(spark, sf_dir)
    return RG.market_regime(RG.index_series(s))


def latest_per_symbol(df: DataFrame, order: str = "date") -> DataFrame:
    """Newest row per symbol (partial aggregate, no window over all rows)."""
    cols = [c for c in df.columns if c != "symbol"]
    return df.groupBy("symbol").agg(F.max_by(F.struct(*cols), F.col(order)).alias("__r")).select("symbol", "__r.*")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars -> gate -> silver joins (sector, lifecycle) -> RSI, MACD,
    Bollinger, ATR, returns, 52-week proximity -> regime -> latest per symbol."""
    g = gold(spark, sf_dir)
    # the index comes from the same gold frame (gold close = silver close), so
    # the silver join runs once; regime is one row per (market, date)
    r = RG.market_regime(RG.index_series(g)).select("market_context", "date", "regime_label")
    sec = SV.one_per_key(TV.sectors(spark, sf_dir), ["symbol"])
    latest = latest_per_symbol(g)
    out = (latest.join(F.broadcast(r), ["market_context", "date"], "left")
           .join(sec, ["symbol"], "left")
           .withColumn("sector", F.coalesce("sector", F.lit("Others")))
           .withColumn("industry", F.coalesce("industry", F.lit("Others"))))
    return out.select("symbol", "date", "market_context", "sector", "industry", "close", "rsi_14",
                      "macd_12_26_9", "macds_12_26_9", "macdh_12_26_9", "bbl_20_2_0", "bbm_20_2_0",
                      "bbu_20_2_0", "atr_14", "return_1d", "return_5d", "return_21d", "high_52w",
                      "proximity_to_52w_high", "days_since_listed", "is_new_listing", "regime_label")
