"""Registered queries for writers, readers and column rules: each writes to the
shared scratch folder and reads back, or runs the rule over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import gate as G
from ..operators import jobs as J
from ..operators import silver as SV
from ..session import cut_lineage, scratch_path
from ..sinks import writers as W
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from .catalog import query
from .q_core import _GATE_DEPS, _GATE_EXTRA, OHLC, _gate_verdicts

_MC = "CASE WHEN symbol LIKE '%.NS' OR symbol LIKE '%.BO' THEN 'india' ELSE 'us' END"
_BARS = "symbol, date, open, high, low, close, volume"


def _bars(spark, d):
    return TV.bars(spark, d).withColumn("market_context", X.market_context("symbol"))


@query("k01_write_bronze", O.cte(["bars"], f"""
SELECT {_BARS}, {_MC} AS market_context, CAST(year(date) AS INTEGER) AS year FROM bars"""), OHLC)
def k01(spark, d):
    """K01 + K02 + A06 + R13: bronze partitions; a rerun of one year replaces that year only."""
    path = scratch_path(spark, "k01")
    b = _bars(spark, d).withColumn("year", F.year("date"))
    cols = ("market_context", "year")
    W.write_bronze(b.withColumn("close", F.when(F.col("year") == 1995, F.lit(0.0)).otherwise(F.col("close"))), path, cols)
    W.write_bronze(b.where("year = 1995"), path, cols)
    return W.scan_partitioned(spark, path, T.StructType([*[f for f in b.schema.fields if f.name not in cols],
                                                         T.StructField("market_context", T.StringType()),
                                                         T.StructField("year", T.IntegerType())])).select(*b.columns)


@query("k03_write_landing_raw", O.cte(["bars"], f"SELECT {_BARS}, CAST(year(date) AS INTEGER) AS year FROM bars"), OHLC)
def k03(spark, d):
    """Raw JSON lines under partition folders, appended in two writes."""
    path = scratch_path(spark, "k03")
    b = TV.bars(spark, d).withColumn("year", F.year("date"))
    for part in (b.where("year < 1996"), b.where("year >= 1996")):
        W.write_landing_raw(part.repartition("year"), path, "json", "year")
    return spark.read.schema(b.schema).json(path).select(*b.columns)


@query("k07_write_quarantine", O.cte(["g0"], """
SELECT array_to_string(g0_reasons, ',') AS reasons, count(*) AS n, CAST(sum(seq_line) AS BIGINT) AS lines
FROM g0 WHERE len(g0_reasons) > 0 GROUP BY 1""", _GATE_EXTRA, _GATE_DEPS))
def k07(spark, d):
    """Rejected rows as JSON lines, read back by reason."""
    path = W.write_quarantine(G.rejected_rows(_gate_verdicts(spark, d)), scratch_path(spark, "k07"), "2001-06-29", "ticks")
    rows = spark.read.schema("g0_reasons array<string>, seq_line long").json(path)
    return rows.groupBy(F.array_join("g0_reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq_line").alias("lines"))


@query("k04_append_history", O.cte(["bars"], f"SELECT {_BARS}, CAST(NULL AS VARCHAR) AS tier FROM bars"), OHLC)
def k04(spark, d):
    """K04 + K09 + K10 + U03 + R15: two appended writes, read with a later schema."""
    path = scratch_path(spark, "k04")
    b = TV.bars(spark, d)
    for part in (b.where("date < '1996-01-01'"), b.where("date >= '1996-01-01'")):
        W.append_snapshot(part, path)
    wide = T.StructType([*b.schema.fields, T.StructField("tier", T.StringType())])
    return W.read_table(spark, path, wide).drop("snapshot_id")


@query("k05_overwrite_table", O.cte(["bars"], f"SELECT {_BARS} FROM bars WHERE date >= DATE '1996-01-01'"), OHLC)
def k05(spark, d):
    """K05 + R15: a rebuild replaces the table; the newest write is all of it."""
    path = scratch_path(spark, "k05")
    b = TV.bars(spark, d)
    W.append_snapshot(b, path)
    W.overwrite_table(b.where("date >= '1996-01-01'"), path)
    return W.read_table(spark, path, b.schema, newest=True).drop("snapshot_id")


@query("k11_upsert_predictions", O.cte(["bars"], """
SELECT symbol, date, CASE WHEN volume % 3 = 0 THEN close / 2 WHEN volume % 3 = 1 AND close / 2 > 0 THEN close / 2
                          ELSE close END AS prediction, CASE WHEN volume % 3 = 0 THEN 2 ELSE 1 END AS version FROM bars"""),
       ["prediction"])
def k11(spark, d):
    """New versions replace, equal versions take the incoming row, lower ones stay out."""
    cur = TV.bars(spark, d).select("symbol", "date", F.col("close").alias("prediction"), F.lit(1).alias("version"))
    third = F.col("volume") % 3
    new = TV.bars(spark, d).select("symbol", "date", (F.col("close") / 2).alias("prediction"),
                                   F.when(third == 0, 2).when(third == 1, 1).otherwise(0).alias("version"))
    return W.upsert_latest(cur, new, ["symbol", "date"], "version")


@query("r14_absent_sources", O.cte(["bars"], f"""
SELECT symbol, date, close, {_MC} AS market_context, CAST(NULL AS DOUBLE) AS circuit_band, CAST(0.0 AS DOUBLE) AS sentiment_score,
       0 AS sentiment_direction, 'low' AS news_coverage_flag, CAST(0.0 AS DOUBLE) AS delivery_pct, CAST(NULL AS DOUBLE) AS gold_inr,
       'Others' AS sector, 'Others' AS industry FROM bars"""), ["close"])
def r14(spark, d):
    """The grand join with every optional source absent."""
    s = SV.grand_join(TV.bars(spark, d), ingestion_ts=daily.DEFAULT_TS)
    return s.select("symbol", "date", "close", "market_context", "circuit_band", "sentiment_score", "sentiment_direction",
                    "news_coverage_flag", "delivery_pct", "gold_inr", "sector", "industry")


@query("f02_f20_f21_typed_bars", """
SELECT l_orderkey AS order_key, TRY_CAST(l_extendedprice AS DOUBLE) AS close, CAST(l_quantity AS BIGINT) AS volume,
       CAST(l_shipdate AS DATE) AS date, CASE WHEN l_tax > 0.05 THEN NULL ELSE l_discount END AS open FROM lineitem""",
       ["close", "open"])
def f21(spark, d):
    """F02 + F20 + F21: renamed, normalised and typed columns of text records; bad text is NULL."""
    li = TV.table(spark, d, "lineitem")
    text = li.select(F.col("l_orderkey").alias("Order Key"), F.col("l_extendedprice").cast("string").alias("Close"),
                     F.col("l_quantity").cast("string").alias("VOLUME"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"),
                     F.when(F.col("l_tax") > 0.05, "n/a").otherwise(F.col("l_discount").cast("string")).alias("Open"))
    named = X.project_rename(X.normalize_column_names(text), {
        "order_key": "order_key", "close": "close", "volume": "volume", "ship": "date", "open": "open"})
    return X.coerce_ohlcv_types(named)


@query("f07_f08_f18_f27_selected_bars", O.cte(["bars"], f"""
SELECT symbol, date, close, 'J01_x' AS ingestion_run_id, 'bars' AS source, {_MC} AS market_context
FROM bars WHERE symbol IN ('S1.BO', 'S2', 'S3.NS') AND volume % 5 <> 0"""), ["close"])
def f07(spark, d):
    """F07 + F08 + F18 + F27: all-null bars dropped, chosen symbols, run columns, required columns checked."""
    b = TV.bars(spark, d)
    empty = F.col("volume") % 5 == 0
    holes = b.select("symbol", "date", *[F.when(~empty, F.col(c)).alias(c) for c in (*OHLC, "volume")])
    kept = X.drop_all_null_bars(holes).where(X.symbol_in_list("symbol", ["S1.BO", "S2", "S3.NS"]))
    out = X.stamp_metadata(X.require_columns_present(kept, ["symbol", "date", "close"]), "J01_x", "bars", daily.DEFAULT_TS)
    return out.select("symbol", "date", "close", "ingestion_run_id", "source", "market_context")


@query("f26_calendar_join", O.cte(["bronze"], "SELECT symbol, date FROM bars WHERE date IN (SELECT date FROM bronze)"))
def f26_join(spark, d):
    """bars of days on which any market trades (semi join with the calendar)."""
    return X.is_trading_day(TV.bars(spark, d).select("symbol", "date"), daily.trading_days(spark, d))


_METRICS = [f"{n}_{m}" for n in ("rows_passed", "rows_rejected", "symbols_expected", "symbols_passed", "symbols_failed") for m in ("india", "us")]


_PER_RUN = ", ".join(
    f"count_if(market = '{m}' AND good) AS rows_passed_{m}, count_if(market = '{m}' AND NOT good) AS rows_rejected_{m}, "
    f"count(DISTINCT CASE WHEN market = '{m}' AND good THEN symbol END) AS symbols_passed_{m}" for m in ("india", "us"))
_RUNS = {
    "judged": f"""SELECT b.symbol, {_MC.replace('symbol', 'b.symbol')} AS market, year(b.date) AS y,
         u.symbol IS NOT NULL AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume >= 0 AND high >= low AS good
  FROM bars b LEFT JOIN (SELECT DISTINCT symbol FROM universe) u ON u.symbol = b.symbol""",
    "runs": f"SELECT y, {_PER_RUN} FROM judged GROUP BY y",
    "expected": f"""SELECT count_if(market = 'india') AS symbols_expected_india, count_if(market = 'us') AS symbols_expected_us
  FROM (SELECT DISTINCT symbol, {_MC} AS market FROM universe) u""",
    "measured": """SELECT r.*, e.*, e.symbols_expected_india - r.symbols_passed_india AS symbols_failed_india,
         e.symbols_expected_us - r.symbols_passed_us AS symbols_failed_us FROM runs r, expected e"""}
_RUN_DEPS = {"judged": ["bars", "universe"], "runs": ["judged"], "expected": ["universe"], "measured": ["runs", "expected"]}


@query("a05_run_metrics", O.cte(["measured"], f"""
SELECT 'J01' AS job_id, 'J01_' || y AS run_id, y || '-12-31' AS job_date,
       CASE WHEN rows_passed_india + rows_passed_us = 0 THEN 'FAILED'
            WHEN rows_rejected_india + rows_rejected_us + symbols_failed_india + symbols_failed_us > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status,
       {', '.join(_METRICS)} FROM measured
UNION ALL
SELECT 'J01', 'J01_holiday', (SELECT max(y) FROM runs) + 1 || '-01-01', 'SKIPPED_HOLIDAY', {', '.join('NULL' for _ in _METRICS)}""", _RUNS, _RUN_DEPS))
def a05(spark, d):
    """A05 + K08: the bars job run for each year, and for a day without trading;
    statuses and per-market counts read back from the audit table it writes."""
    root = scratch_path(spark, "a05")
    bars, universe = cut_lineage(TV.bars(spark, d)), TV.universe(spark, d)
    years = sorted(r[0] for r in bars.select(F.year("date")).distinct().collect())  # one run a year
    for y in years:
        J.bars_job(spark, bars.where(F.year("date") == y), universe, f"{y}-12-31", True, f"J01_{y}", f"{root}/bronze", f"{root}/audit")
    J.bars_job(spark, bars, universe, f"{years[-1] + 1}-01-01", False, "J01_holiday", f"{root}/bronze", f"{root}/audit")
    audit = spark.read.schema(W.AUDIT_SCHEMA).parquet(f"{root}/audit")
    return J.run_metrics(audit, _METRICS).drop("error_message")
