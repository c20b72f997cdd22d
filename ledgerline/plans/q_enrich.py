"""Registered queries for silver enrichment E02-E17."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrichment as EN
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from .catalog import query

_CAL = """
SELECT market_context, date, CAST(row_number() OVER (PARTITION BY market_context ORDER BY date) - 1 AS INTEGER)
       AS day_index
FROM (SELECT DISTINCT market_context, date FROM silver) t"""
_MC = "CASE WHEN symbol LIKE '%.NS' OR symbol LIKE '%.BO' THEN 'india' ELSE 'us' END"
EXTRA = {"cal": _CAL}
DEPS = {"cal": ["silver"]}


def _rows(spark, d):
    return daily.silver(spark, d)


def _cal(spark, d):
    return EN.trading_calendar_index(daily.trading_days(spark, d))


@query("e03_trading_day_index", O.cte(["cal"], "SELECT * FROM cal", EXTRA, DEPS))
def e03(spark, d):
    """Dense per-market index of trading days."""
    return _cal(spark, d)


_E04 = f"""
SELECT symbol, date, day_index, dtn AS days_to_next_earnings, dsl AS days_since_last_earnings,
  CASE WHEN dtn BETWEEN 1 AND 10 THEN 1 ELSE 0 END AS pre_earnings_zone_flag,
  CASE WHEN dtn BETWEEN 0 AND 2 THEN 1 ELSE 0 END AS earnings_blackout_flag,
  CASE WHEN dtn IS NULL THEN 1 ELSE 0 END AS earnings_date_unknown_flag,
  dsl / 63.0 AS earnings_cycle_position,
  avg(CASE WHEN dtn BETWEEN 3 AND 7 THEN vr END) OVER (PARTITION BY symbol, next_ev_idx ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pre_earnings_volume_buildup,
  CASE WHEN dsl = 1 THEN gap END AS post_earnings_gap_1d
FROM (
  SELECT k.*, CAST(next_ev_idx - day_index AS INTEGER) AS dtn, CAST(day_index - last_ev_idx AS INTEGER) AS dsl,
         volume / NULLIF(CASE WHEN count(volume) OVER w21 >= 21 THEN avg(volume) OVER w21 END, 0) AS vr,
         open / NULLIF(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS gap
  FROM (SELECT j.*, p.ev_idx AS last_ev_idx FROM
          (SELECT b.*, n.ev_idx AS next_ev_idx FROM b ASOF LEFT JOIN ev n ON b.symbol = n.symbol AND b.date <= n.event_date) j
        ASOF LEFT JOIN ev p ON j.symbol = p.symbol AND j.date >= p.event_date) k
  WINDOW w21 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)) q"""
_E04_EXTRA = {
    "cal": _CAL,
    "ev": f"""SELECT e.symbol, e.event_date, c.day_index AS ev_idx
              FROM (SELECT *, {_MC} AS mc FROM earnings) e
              ASOF LEFT JOIN cal c ON e.mc = c.market_context AND e.event_date <= c.date""",
    "b": """SELECT s.symbol, s.date, s.open, s.close, s.volume, c.day_index FROM silver s
            LEFT JOIN cal c ON s.market_context = c.market_context AND s.date = c.date""",
}
_E04_DEPS = {"cal": ["silver"], "ev": ["earnings", "cal"], "b": ["silver", "cal"]}


@query("e04_e09_earnings_features", O.cte(["b", "ev"], _E04, _E04_EXTRA, _E04_DEPS),
       {"earnings_cycle_position": 6, "pre_earnings_volume_buildup": 6, "post_earnings_gap_1d": 6})
def e04(spark, d):
    """Trading days to the next / since the last result (as-of
    forward / backward), zone, blackout and unknown flags, cycle position,
    pre-result volume build-up and post-result opening gap."""
    s = _rows(spark, d)
    out = EN.earnings_features(s.select("symbol", "date", "market_context", "open", "close", "volume"),
                               TV.earnings_events(spark, d), _cal(spark, d))
    return out.select("symbol", "date", "day_index", "days_to_next_earnings", "days_since_last_earnings",
                      "pre_earnings_zone_flag", "earnings_blackout_flag", "earnings_date_unknown_flag",
                      "earnings_cycle_position", "pre_earnings_volume_buildup", "post_earnings_gap_1d")


@query("e10_corporate_action_flags", O.cte(["silver", "bar_actions"], """
SELECT s.symbol, s.date, a.action_type AS corporate_action_type,
       CASE WHEN a.action_type IS NOT NULL THEN 1 ELSE 0 END AS corporate_action_flag
FROM silver s LEFT JOIN bar_actions a ON s.symbol = a.symbol AND s.date = a.date"""))
def e10(spark, d):
    """Ex-date flag and type per symbol and date."""
    s = _rows(spark, d).select("symbol", "date")
    return EN.corporate_action_flags(s, TV.bar_corporate_actions(spark, d))


_E11 = """
SELECT s.symbol, s.date,
  CASE WHEN ap THEN dtn END AS days_to_next_macro_event,
  CASE WHEN ap AND dtn BETWEEN 0 AND 2 THEN 1 ELSE 0 END AS macro_event_blackout_flag,
  CASE WHEN ap AND dtn IS NOT NULL THEN etype END AS macro_event_type
FROM (SELECT s.*, n.dtn, n.etype, COALESCE(list_contains(n.sectors, s.sector), false) AS ap
      FROM silver s LEFT JOIN nx n ON s.market_context = n.market_context AND s.date = n.date) s"""
_E11_EXTRA = {
    "cal": _CAL,
    "mev": """SELECT e.event_date, e.event_type, string_split_regex(e.sectors_impacted, '\\s*,\\s*') AS sectors,
                     c.day_index AS ev_idx
              FROM macro_events e ASOF LEFT JOIN (SELECT * FROM cal WHERE market_context = 'india') c
                ON e.event_date <= c.date""",
    "nx": """SELECT c.market_context, c.date,
                    CAST(CASE WHEN date_diff('day', c.date, m.event_date) <= 60 THEN m.ev_idx - c.day_index END AS INTEGER)
                      AS dtn,
                    CASE WHEN date_diff('day', c.date, m.event_date) <= 60 THEN m.event_type END AS etype, m.sectors
             FROM (SELECT * FROM cal WHERE market_context = 'india') c
             ASOF LEFT JOIN mev m ON c.date <= m.event_date""",
}
_E11_DEPS = {"cal": ["silver"], "mev": ["macro_events", "cal"], "nx": ["mev", "cal"]}


@query("e11_macro_event_features", O.cte(["silver", "nx"], _E11, _E11_EXTRA, _E11_DEPS))
def e11(spark, d):
    """Trading days to the next macro event (within 60 days) for
    impacted sectors, blackout flag and event type."""
    s = _rows(spark, d)
    out = EN.macro_event_features(s.select("symbol", "date", "market_context", "sector"),
                                  TV.macro_events(spark, d), _cal(spark, d))
    return out.select("symbol", "date", "days_to_next_macro_event", "macro_event_blackout_flag", "macro_event_type")


_E12 = """
SELECT s.symbol, s.date, q.report_date AS fundamentals_asof_date, q.revenue AS revenue_q, q.qoq AS revenue_qoq_change
FROM silver s ASOF LEFT JOIN (
  SELECT symbol, report_date, revenue,
         revenue - lag(revenue) OVER (PARTITION BY symbol ORDER BY report_date) AS qoq FROM quarterly) q
  ON s.symbol = q.symbol AND s.date >= q.report_date"""


@query("e12_e13_fundamentals_ffill", O.cte(["silver", "quarterly"], _E12),
       {"revenue_q": 2, "revenue_qoq_change": 2})
def e12(spark, d):
    """Last reported quarterly value carried to daily rows with its
    as-of date, and the change on the prior quarter."""
    s = _rows(spark, d).select("symbol", "date")
    out = EN.ffill_fundamentals(s, TV.quarterly_fundamentals(spark, d))
    return out.select("symbol", "date", "fundamentals_asof_date", "revenue_q", "revenue_qoq_change")


_E14 = """
SELECT g.symbol, g.date, g.market_context, g.day_index, gap_days,
       CASE WHEN gap_days <= 3 THEN c_f END AS close_filled,
       CASE WHEN gap_days <= 2 THEN v_f END AS volume_filled, COALESCE(pres, false) AS is_observed
FROM (
  SELECT g.*, CAST(g.day_index - last_value(CASE WHEN pres THEN g.day_index END IGNORE NULLS) OVER w AS INTEGER) AS gap_days,
         last_value(close IGNORE NULLS) OVER w AS c_f, last_value(volume IGNORE NULLS) OVER w AS v_f
  FROM (SELECT g.*, s.close, s.volume, s.pres FROM
          (SELECT sp.symbol, sp.market_context, c.date, c.day_index
           FROM (SELECT symbol, market_context, min(date) AS lo, max(date) AS hi FROM silver GROUP BY 1, 2) sp
           JOIN cal c ON c.market_context = sp.market_context AND c.date BETWEEN sp.lo AND sp.hi) g
        LEFT JOIN (SELECT symbol, date, close, volume, true AS pres FROM silver) s
          ON g.symbol = s.symbol AND g.date = s.date) g
  WINDOW w AS (PARTITION BY g.symbol ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) g"""


@query("e14_gap_fill", O.cte(["silver", "cal"], _E14, EXTRA, DEPS), ["close_filled"])
def e14(spark, d):
    """Every trading day of the symbol's market between its first and
    last bar, price filled over at most 3 missing days, volume over 2."""
    s = _rows(spark, d)
    return EN.gap_fill(s.select("symbol", "date", "market_context", "close", "volume"), _cal(spark, d))


@query("e16_cap_tier_enrichment", O.cte(["silver", "cap_tiers"], """
SELECT s.symbol, s.date, COALESCE(t.cap_tier, 'unknown') AS cap_tier
FROM silver s LEFT JOIN cap_tiers t ON s.symbol = t.symbol"""))
def e16(spark, d):
    """Cap tier per row from the universe table."""
    return EN.cap_tier_enrichment(_rows(spark, d).select("symbol", "date"), TV.cap_tiers(spark, d))


@query("e17_circuit_flags", O.cte(["silver"], """
SELECT symbol, date, band, u AS upper_circuit_flag, l AS lower_circuit_flag,
       sum(u + l) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS circuit_hits_5d
FROM (SELECT *, CASE WHEN close >= open * (1 + band - 0.001) THEN 1 ELSE 0 END AS u,
             CASE WHEN close <= open * (1 - band + 0.001) THEN 1 ELSE 0 END AS l
      FROM (SELECT symbol, date, open, close,
                   last_value(circuit_band IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS band FROM silver) a) b"""), ["band"])
def e17(spark, d):
    """Upper / lower circuit hits with the weekly band carried forward, count over 5 rows."""
    out = EN.circuit_flags(_rows(spark, d).select("symbol", "date", "open", "close", "circuit_band"))
    return out.select("symbol", "date", "band", "upper_circuit_flag", "lower_circuit_flag",
                      F.col("circuit_hits_5d").cast("long").alias("circuit_hits_5d"))


@query("e02_skip_existing_keys", O.cte(["bars", "bronze"], """
SELECT b.symbol, b.date, b.close FROM bars b
WHERE NOT EXISTS (SELECT 1 FROM bronze z WHERE z.symbol = b.symbol AND z.date = b.date)"""), ["close"])
def e02(spark, d):
    """Incoming bars whose (symbol, date) is not yet in bronze (left anti)."""
    return EN.skip_existing_keys(TV.bars(spark, d).select("symbol", "date", "close"),
                                 daily.bronze_ohlcv(spark, d), ["symbol", "date"])
