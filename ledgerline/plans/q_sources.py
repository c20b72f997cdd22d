"""Registered queries for landing sources (R01-R11) and scalar rules (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import silver as SV
from ..sources import landing as L
from ..sources import landing_text as LT
from ..sources import testviews as TV
from ..util import exact_avg_sql, exact_sum_sql
from . import daily
from . import oracle as O
from .catalog import query

SYM_K = "('S' || CAST(l_suppkey AS VARCHAR))"


@query("r01_scan_bhav_csv", f"""
SELECT date, {SYM_K} || '.NS' AS symbol,
       CASE WHEN rmin = 'R' AND rmax = 'R' THEN NULL ELSE ROUND(n * 100.0 * 10.0) / 10.0 END AS delivery_pct
FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS q,
             avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS n, min(l_returnflag) AS rmin,
             max(l_returnflag) AS rmax
      FROM lineitem GROUP BY 1, 2) t
WHERE q <= 45""", ["delivery_pct"])
def r01(spark, d):
    """R01 + F01-F04: delivery CSV lines -> EQ rows, '.NS' symbols, numeric pct ('-' -> NULL)."""
    return L.parse_delivery_lines(LT.delivery_lines(spark, d))


@query("r02_scan_circuit_csv", f"""
SELECT 'S' || CAST(s_suppkey AS VARCHAR) || '.NS' AS symbol,
       CASE WHEN regexp_full_match(trim(b), '[0-9]+') THEN CAST(trim(b) AS DOUBLE) / 100.0 END AS circuit_band
FROM (SELECT s_suppkey, {TV.band_text_sql('s_nationkey')} AS b FROM supplier) t""", ["circuit_band"])
def r02(spark, d):
    """R02 + F05: circuit CSV lines -> band fraction ('No Band', '-' -> NULL)."""
    return L.parse_circuit_lines(LT.circuit_lines(spark, d))


@query("r03_scan_universe_csv", """
SELECT DISTINCT 'S' || CAST(s_suppkey AS VARCHAR) || '.NS' AS symbol FROM supplier WHERE s_acctbal > 0""")
def r03(spark, d):
    """Equity list CSV (header skipped) -> EQ symbols with '.NS'."""
    return L.parse_universe_lines(LT.universe_lines(spark, d))


@query("r04_scan_sector_csv", O.cte(["sectors"], "SELECT * FROM sectors"))
def r04(spark, d):
    """Sector dimension CSV -> (symbol, sector, industry)."""
    return L.parse_sector_lines(LT.sector_lines(spark, d))


@query("r05_wide_to_long_ohlcv", O.cte(["bars"], "SELECT date, symbol, open, high, low, close, volume FROM bars"),
       ["open", "high", "low", "close"])
def r05(spark, d):
    """Wide download batches (ticker|field) -> one row per (date, symbol)."""
    return L.wide_map_to_long(LT.wide_batches(spark, d)).select("date", "symbol", "open", "high", "low", "close",
                                                                  "volume")


_CA = f"""
SELECT symbol, day, dividend, split FROM (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS day,
         {exact_sum_sql("CASE WHEN event_type = 'purchase' THEN value END")} AS dividend,
         max(CASE WHEN event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 90
                  THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10.0 END) AS split
  FROM events GROUP BY 1, 2) t"""
_CA_ROWS = """
SELECT day AS date, symbol, 'us' AS market_context, 'DIVIDEND' AS action_type, dividend AS action_value
FROM ca WHERE dividend IS NOT NULL
UNION ALL
SELECT day, symbol, 'us', 'SPLIT', split FROM ca WHERE split IS NOT NULL"""


@query("r06_explode_corporate_actions", O.cte(["ca"], _CA_ROWS, {"ca": _CA}), ["action_value"])
def r06(spark, d):
    """Nested corporate-action JSON -> one row per action (DIVIDEND, SPLIT)."""
    return L.explode_corporate_actions(LT.corporate_action_docs(spark, d), "json", X.market_context(F.col("symbol")))


F09_ASOF = "2024-01-20"


@query("f09_recent_positive_actions", O.cte(["ca"], f"""
SELECT * FROM ({_CA_ROWS}) r WHERE date >= DATE '{F09_ASOF}' - INTERVAL 7 DAY AND action_value > 0""",
                                            {"ca": _CA}), ["action_value"])
def f09(spark, d):
    """actions of the last 7 days before as-of with a positive value."""
    a = L.explode_corporate_actions(LT.corporate_action_docs(spark, d), "json", X.market_context(F.col("symbol")))
    return X.recent_positive_actions(a, F09_ASOF)


@query("r07_explode_earnings_calendar", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS next_earnings_date,
       'india' AS market_context
FROM orders WHERE o_orderstatus <> 'P'""")
def r07(spark, d):
    """Earnings JSON -> rows only where next_earnings_date exists."""
    return L.explode_earnings_calendar(LT.earnings_docs(spark, d))


F10_ASOF = "1998-06-01"


@query("f10_next_upcoming_date", f"""
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, min(CAST(o_orderdate AS DATE)) AS next_earnings_date
FROM orders WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) >= DATE '{F10_ASOF}' GROUP BY 1""")
def f10(spark, d):
    """the smallest announced date on or after as-of per symbol (none -> no row)."""
    e = L.explode_earnings_calendar(LT.earnings_docs(spark, d))
    return X.next_upcoming_per_key(e, "next_earnings_date", F10_ASOF, ["symbol"])


@query("r08_flatten_sentiment_json", f"""
SELECT fetch_date, symbol, bullish - bearish AS sentiment_score,
       CAST(CASE WHEN bullish - bearish > 0.1 THEN 1 WHEN bullish - bearish < -0.1 THEN -1 ELSE 0 END AS INTEGER)
         AS sentiment_direction,
       CASE WHEN articles > 1 THEN articles ELSE 0 END AS news_intensity,
       CASE WHEN articles > 1 AND articles >= 2 THEN 'normal' ELSE 'low' END AS news_coverage_flag
FROM (SELECT {TV.symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS fetch_date,
             avg(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS bullish,
             avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS bearish, count(*) AS articles
      FROM lineitem GROUP BY 1, 2) t""", ["sentiment_score"])
def r08(spark, d):
    """R08 + F12: sentiment JSON arrays -> score, direction, intensity, coverage (NULL acts as 0)."""
    return L.flatten_sentiment_json(LT.sentiment_docs(spark, d))


_FUND_MONEY = ["market_cap", "total_revenue", "net_income", "operating_cashflow"]


FUND_SQL = f"""
SELECT {TV.symbol_sql('s_suppkey')} AS symbol,
       CASE WHEN s_acctbal > 1000 THEN s_acctbal / 100.0 END AS pe_ratio, s_acctbal / 120.0 AS forward_pe,
       CAST(n AS DOUBLE) / 10.0 AS price_to_book, rev * 4.0 AS market_cap, CAST(0.0 AS DOUBLE) AS institutional_ownership_pct,
       CAST(n AS DOUBLE) * 1000.0 AS implied_institutional_ownership_pct, disc AS held_percent_institutions,
       tax AS held_percent_insiders, CAST(NULL AS DOUBLE) AS short_ratio, CAST(NULL AS DOUBLE) AS short_percent_of_float,
       CASE WHEN s_acctbal > 0 THEN rev END AS total_revenue, rev * 0.1 AS net_income,
       CASE WHEN s_acctbal < 0 THEN -s_acctbal ELSE 0.0 END AS total_debt, rev * 0.05 AS operating_cashflow,
       CAST(s_acctbal > 1000 OR (s_acctbal > 0 AND rev IS NOT NULL) AS INTEGER) AS fundamental_presence_flag
FROM supplier LEFT JOIN (SELECT l_suppkey, {exact_sum_sql('l_extendedprice * (1 - l_discount)', 4)} AS rev,
                                count(*) AS n, {exact_avg_sql('l_discount')} AS disc, {exact_avg_sql('l_tax')} AS tax
                         FROM lineitem GROUP BY 1) a
  ON s_suppkey = a.l_suppkey"""


@query("r09_flatten_fundamentals_json", FUND_SQL,
       {**{c: 6 for c in ["pe_ratio", "forward_pe", "price_to_book", "institutional_ownership_pct",
                          "implied_institutional_ownership_pct", "held_percent_institutions", "held_percent_insiders",
                          "short_ratio", "short_percent_of_float", "total_debt"]}, **{c: 2 for c in _FUND_MONEY}})
def r09(spark, d):
    """R09 + F13/F14: fundamentals JSON -> 15 renamed columns + presence flag."""
    return L.flatten_fundamentals_json(LT.fundamentals_docs(spark, d))


_DAY = f"""SELECT CAST(o_orderdate AS DATE) AS date, {exact_avg_sql('o_totalprice')} AS avgp, min(o_totalprice) AS minp,
       max(o_totalprice) AS maxp, {exact_sum_sql('o_totalprice')} AS sump, count(*) AS cnt FROM orders GROUP BY 1"""


@query("r10_extract_macro_html", O.cte(["od"], """
SELECT date,
       CASE WHEN cnt > 6 THEN ROUND(minp / 20000.0 * 100) / 100 ELSE ROUND(avgp / 50000.0 * 100) / 100 END
         AS rbi_repo_rate,
       greatest(ROUND(maxp / 70000.0 * 10000) / 10000, ROUND(avgp / 30000.0 * 10000) / 10000) AS india_10y_yield
FROM od""", {"od": _DAY}), ["rbi_repo_rate", "india_10y_yield"])
def r10(spark, d):
    """Rate tables in HTML -> repo rate (last parsable wins), long bond yield (max)."""
    return L.extract_macro_html(LT.macro_html_pages(spark, d))


@query("r10_extract_macro_html_pages", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN ROUND((page_id % 97) / 10.0 * 100) / 100 WHEN page_id % 3 = 1 THEN NULL END AS rbi_repo_rate,
       CASE WHEN page_id % 3 = 0 THEN greatest(5.5, ROUND((page_id % 89) / 8.0 * 1000) / 1000) END AS india_10y_yield
FROM pages""", ["rbi_repo_rate", "india_10y_yield"])
def r10_pages(spark, d):
    """R10 over raw web pages: every third page holds a rate table, every third
    one without values, among the page's own markup; the others give NULL rates."""
    k = F.col("page_id")
    row = lambda a, b: F.concat(F.lit(f"<tr><td>{a}</td><td>"), b, F.lit("</td></tr>"))
    text = lambda c: F.round(c, 3).cast("decimal(12,3)").cast("string")
    rates = F.concat(F.lit("<table>"), row("Policy Repo Rate", F.concat(F.lit(": "), text(k % 97 / 10.0), F.lit("%"))),
                     row("7.10% GS 2041", F.concat(F.lit(": "), text(k % 89 / 8.0), F.lit("% #"))),
                     row("6.48% GS 2035", F.lit(": 5.5%")), F.lit("</table>"))
    empty = F.concat(F.lit("<table>"), row("Policy Repo Rate", F.lit(": N/A%")), F.lit("</table>"))
    html = F.concat(F.coalesce("html", F.lit("")), F.when(k % 3 == 0, rates).when(k % 3 == 1, empty).otherwise(F.lit("")))
    return L.extract_macro_html(TV.table(spark, d, "pages").select("page_id", html.alias("html")))


@query("r11_scan_macro_prices_json", O.cte(["od"], """
SELECT date, CASE WHEN cnt >= 5 THEN avgp / 10000.0 END AS india_vix_close, sump / 1000.0 AS nifty50_close
FROM od""", {"od": _DAY}), {"india_vix_close": 6, "nifty50_close": 4})
def r11(spark, d):
    """Ticker map JSON -> VIX and index closes; missing ticker -> NULL."""
    return L.scan_macro_prices_json(LT.macro_price_docs(spark, d))


# ---------------------------------------------------------------- scalar rules


@query("f06_market_context", O.cte(["bars"], f"""
SELECT DISTINCT symbol, {O.MC} AS market_context FROM bars"""))
def f06(spark, d):
    """'.NS' / '.BO' -> india, else us."""
    return TV.bars(spark, d).select("symbol").distinct().select("symbol", X.market_context("symbol").alias("market_context"))


@query("f11_latest_close", O.cte(["bars"], "SELECT symbol, arg_max(close, date) AS close, max(date) AS date FROM bars GROUP BY 1"),
       ["close"])
def f11(spark, d):
    """close of the latest row per symbol (max_by, partial aggregate)."""
    return TV.bars(spark, d).groupBy("symbol").agg(X.latest_value("close", "date").alias("close"),
                                                   F.max("date").alias("date"))


@query("f17_bhav_date_format", O.cte(["bars"], "SELECT DISTINCT date, strftime(date, '%d%m%Y') AS bhav_date FROM bars"))
def f17(spark, d):
    """yyyy-MM-dd -> ddMMyyyy file date."""
    return TV.bars(spark, d).select("date").distinct().select("date", X.bhav_date_format("date").alias("bhav_date"))


F19_SYMBOL = "S1.BO"


@query("f19_point_lookup", O.cte(["gold"], f"""
SELECT symbol, date, close, rsi_14, macd_12_26_9, return_1d FROM gold WHERE symbol = '{F19_SYMBOL}'
ORDER BY date DESC LIMIT 5"""), {"close": 6, "rsi_14": 4, "macd_12_26_9": 4, "return_1d": 6})
def f19(spark, d):
    """Newest 5 feature rows of one symbol (the limit is the feature)."""
    g = daily.gold(spark, d)
    return X.point_lookup(g, F19_SYMBOL, ["symbol", "date", "close", "rsi_14", "macd_12_26_9", "return_1d"])


@query("f26_is_trading_day", O.cte(["bars"], f"""
SELECT date, dayofweek(date) NOT IN (0, 6) AND strftime(date, '%m-%d') NOT IN
       ({", ".join(repr(h) for h in X.MARKET_HOLIDAYS_MMDD)}) AS is_trading_day
FROM (SELECT DISTINCT date FROM bars) t"""))
def f26(spark, d):
    """weekday and not a fixed market holiday (calendar rule as data)."""
    return TV.bars(spark, d).select("date").distinct().select("date", X.trading_day_flag("date").alias("is_trading_day"))


@query("u02_union_universes", O.cte(["universe"], """
SELECT symbol, 'india' AS market_context FROM universe WHERE symbol LIKE '%.NS' OR symbol LIKE '%.BO'
UNION ALL SELECT symbol, 'us' FROM universe WHERE NOT (symbol LIKE '%.NS' OR symbol LIKE '%.BO')"""))
def u02(spark, d):
    """The india and us universes combined (unionByName)."""
    u = TV.universe(spark, d).withColumn("market_context", X.market_context("symbol"))
    india = u.filter(F.col("market_context") == "india")
    us = u.filter(F.col("market_context") == "us")
    return india.unionByName(us)


@query("e01_latest_per_key", O.cte(["raw_ticks"], """
SELECT symbol, CAST(date AS DATE) AS date,
       arg_max(close, struct_pack(a := seq_order, b := seq_line, c := seq_part)) AS close, max(seq_order) AS seq_order
FROM raw_ticks GROUP BY 1, 2"""), ["close"])
def e01(spark, d):
    """Newest record per (symbol, date) by ingestion order (max_by)."""
    t = TV.raw_ticks(spark, d).select("symbol", F.col("date").cast("date").alias("date"), "close",
                                      F.struct("seq_order", "seq_line", "seq_part").alias("seq"))
    out = SV.one_per_key(t, ["symbol", "date"], order="seq")
    return out.select("symbol", "date", "close", F.col("seq.seq_order").alias("seq_order"))
