"""Silver layer: the grand join (JN1-JN7), lifecycle (A01, JN6) and
universe joins (JN8, JN9).

Partitioning plan: every per-symbol input is hash partitioned by ``symbol``
once.  Hash partitioning on ``symbol`` satisfies the (symbol, date) join
keys, the per-symbol lifecycle aggregate and the gold feature windows, so
the whole silver -> gold chain runs on one exchange per source.  The
market-wide macro table has one row per date (bounded by the calendar) and
is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X

SILVER_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "market_context",
                  "bronze_ohlcv_run_id", "circuit_band", "sentiment_score", "sentiment_direction",
                  "news_intensity", "news_coverage_flag", "delivery_pct", "gold_usd", "crude_oil_usd",
                  "gold_inr", "sector", "industry", "silver_ingestion_timestamp"]


def by_symbol(df: DataFrame, n: int | None = None) -> DataFrame:
    """Hash partition on symbol (the shared key of every downstream step)."""
    return df.repartition(n, "symbol") if n else df.repartition("symbol")


def one_per_key(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key.  With ``order`` the newest row wins,
    otherwise the smallest row (deterministic).  A partial aggregate, so
    duplicates of a hot key are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if order:  # equal orders: the larger row
        row = F.max(F.struct(F.col(order).alias("__o"), F.struct(*rest).alias("__row")))
        return df.groupBy(*keys).agg(row.alias("__r")).select(*keys, "__r.__row.*")
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*")


def _typed_nulls(cols: dict[str, str]) -> list:
    return [F.lit(None).cast(t).alias(c) for c, t in cols.items()]


def grand_join(ohlcv: DataFrame, circuit: DataFrame | None = None, sentiment: DataFrame | None = None,
               delivery: DataFrame | None = None, macro: DataFrame | None = None,
               sectors: DataFrame | None = None, ingestion_ts=None, partitions: int | None = None) -> DataFrame:
    """JN7: bronze OHLCV left joined to every optional source, with defaults.

    R14: an absent source (``None``) becomes typed default columns instead of
    a join.  F16 defaults are applied after the joins.  Inputs:

    * ohlcv: symbol, date, open, high, low, close, volume [, market_context, ingestion_run_id]
    * circuit: symbol, date, circuit_band
    * sentiment: symbol, fetch_date, sentiment_score, sentiment_direction, news_intensity, news_coverage_flag
    * delivery: symbol, date, delivery_pct
    * macro: date, gold_usd, crude_oil_usd, gold_inr (one row per date)
    * sectors: symbol, sector, industry
    """
    o = ohlcv
    if "market_context" not in o.columns:
        o = o.withColumn("market_context", X.market_context("symbol"))
    if "ingestion_run_id" not in o.columns:
        o = o.withColumn("ingestion_run_id", F.lit(None).cast("string"))
    o = by_symbol(o.select("symbol", "date", "open", "high", "low", "close", "volume", "market_context",
                           F.col("ingestion_run_id").alias("bronze_ohlcv_run_id")), partitions)

    sd = ["symbol", "date"]
    if circuit is not None:  # JN1
        c = one_per_key(by_symbol(circuit.select("symbol", "date", "circuit_band"), partitions), sd)
        o = o.join(c, sd, "left")
    else:
        o = o.select("*", *_typed_nulls({"circuit_band": "double"}))

    sent_cols = ["sentiment_score", "sentiment_direction", "news_intensity", "news_coverage_flag"]
    if sentiment is not None:  # JN2: o.date = s.fetch_date
        s = sentiment.select("symbol", F.col("fetch_date").cast("date").alias("date"), *sent_cols)
        s = one_per_key(by_symbol(s, partitions), sd)
        o = o.join(s, sd, "left")
    else:
        o = o.select("*", *_typed_nulls({"sentiment_score": "double", "sentiment_direction": "int",
                                         "news_intensity": "long", "news_coverage_flag": "string"}))

    if delivery is not None:  # JN3
        d = one_per_key(by_symbol(delivery.select("symbol", "date", "delivery_pct"), partitions), sd)
        o = o.join(d, sd, "left")
    else:
        o = o.select("*", *_typed_nulls({"delivery_pct": "double"}))

    macro_cols = ["gold_usd", "crude_oil_usd", "gold_inr"]
    if macro is not None:  # JN4: one macro row per date repeats for all symbols
        m = one_per_key(macro.select("date", *macro_cols), ["date"])
        # bound: one row per calendar date in history
        o = o.join(F.broadcast(m), ["date"], "left")
    else:
        o = o.select("*", *_typed_nulls({c: "double" for c in macro_cols}))

    if sectors is not None:  # JN5
        sec = one_per_key(by_symbol(sectors.select("symbol", "sector", "industry"), partitions), ["symbol"])
        o = o.join(sec, ["symbol"], "left")
    else:
        o = o.select("*", *_typed_nulls({"sector": "string", "industry": "string"}))

    ts = F.current_timestamp() if ingestion_ts is None else F.lit(ingestion_ts).cast("timestamp")
    out = []
    for c in SILVER_COLUMNS:
        if c == "silver_ingestion_timestamp":
            out.append(ts.alias(c))
        elif c in X.SILVER_DEFAULTS:
            default = X.SILVER_DEFAULTS[c]
            typ = o.schema[c].dataType
            out.append(F.coalesce(F.col(c), F.lit(default).cast(typ)).alias(c))
        else:
            out.append(F.col(c))
    return o.select(*out)


def stock_lifecycle(silver: DataFrame, updated_ts=None) -> DataFrame:
    """First listed date per symbol (full recompute catches backfills)."""
    ts = F.current_timestamp() if updated_ts is None else F.lit(updated_ts).cast("timestamp")
    return (silver.groupBy("symbol").agg(F.min("date").alias("first_listed_date"))
            .withColumn("last_updated_timestamp", ts))


def join_lifecycle(silver: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """JN6: silver LEFT JOIN lifecycle ON symbol (one row per symbol)."""
    lc = lifecycle.select("symbol", "first_listed_date")
    return silver.join(lc, ["symbol"], "left")


def with_first_listed(silver: DataFrame) -> DataFrame:
    """JN6 without the join: ``first_listed_date`` as min(date) over the
    symbol's rows (equal to joining the A01 lifecycle table; no exchange on
    symbol-partitioned data)."""
    from pyspark.sql import Window

    return silver.withColumn("first_listed_date", F.min("date").over(Window.partitionBy("symbol")))


def universe_semi(df: DataFrame, universe: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """JN8: keep rows whose symbol is in the universe."""
    u = universe.select(F.col(symbol_col).alias("__u")).distinct()
    return df.join(u, df[symbol_col] == u["__u"], "left_semi")


def universe_anti(requested: DataFrame, delivered: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """JN9: requested symbols that were not delivered."""
    d = delivered.select(F.col(symbol_col).alias("__d")).distinct()
    r = requested.select(symbol_col).distinct()
    return r.join(d, r[symbol_col] == d["__d"], "left_anti")


def symbols_passed(df: DataFrame) -> DataFrame:
    """Exact distinct symbol count (one row)."""
    return df.agg(F.count_distinct("symbol").alias("symbols_passed"))


SILVER_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False), T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("market_context", T.StringType()),
    T.StructField("bronze_ohlcv_run_id", T.StringType()), T.StructField("circuit_band", T.DoubleType()),
    T.StructField("sentiment_score", T.DoubleType()), T.StructField("sentiment_direction", T.IntegerType()),
    T.StructField("news_intensity", T.LongType()), T.StructField("news_coverage_flag", T.StringType()),
    T.StructField("delivery_pct", T.DoubleType()), T.StructField("gold_usd", T.DoubleType()),
    T.StructField("crude_oil_usd", T.DoubleType()), T.StructField("gold_inr", T.DoubleType()),
    T.StructField("sector", T.StringType()), T.StructField("industry", T.StringType()),
    T.StructField("silver_ingestion_timestamp", T.TimestampType()),
])
