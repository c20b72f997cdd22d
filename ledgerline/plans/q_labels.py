"""Registered queries for labels L01-L10 and the contract checks Q10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrichment as EN
from ..operators import gate as G
from ..operators import labels as LB
from ..sources import testviews as TV
from . import daily
from . import oracle as O
from .catalog import query
from .q_enrich import _CAL


def label_rows(spark, d):
    s = daily.silver(spark, d)
    g = daily.gold(spark, d, keep_nulls=True, silver_df=s).select(
        "symbol", "date", "market_context", "open", "high", "low", "close", "atr_14")
    cal = EN.trading_calendar_index(daily.trading_days(spark, d))  # one row per market-day
    g = g.join(F.broadcast(cal), ["market_context", "date"], "left")
    sp = (TV.bar_corporate_actions(spark, d).filter(F.col("action_type") == "split")
          .select("symbol", "date", F.lit(1).alias("split_flag")))
    return g.join(sp, ["symbol", "date"], "left").fillna(0, ["split_flag"])


def labels(spark, d):
    return LB.swing_labels(label_rows(spark, d))


_LEADS = ", ".join([f"lead(high, {i}) OVER w AS h{i}" for i in range(1, 6)] +
                   [f"lead(low, {i}) OVER w AS l{i}" for i in range(1, 6)])
_SD = ", ".join(f"CASE WHEN l{i} <= stp THEN {i} END" for i in range(1, 6))
_TD = ", ".join(f"CASE WHEN h{i} >= tgt THEN {i} END" for i in range(1, 6))
_LR = """
SELECT g.symbol, g.date, g.market_context, g.open, g.high, g.low, g.close, g.atr_raw AS atr_14, c.day_index,
       COALESCE(sp.f, 0) AS split_flag
FROM gold_s4 g LEFT JOIN cal c ON g.market_context = c.market_context AND g.date = c.date
LEFT JOIN (SELECT symbol, date, 1 AS f FROM bar_actions WHERE action_type = 'split') sp
  ON g.symbol = sp.symbol AND g.date = sp.date"""
_LAB = f"""
SELECT symbol, date, market_context, is_label_valid, outcome AS label_rr_outcome_5d,
       CASE WHEN is_label_valid THEN c1 / NULLIF(close, 0) - 1 END AS label_return_1d,
       CASE outcome WHEN 'win' THEN (tgt - entry) / NULLIF(entry, 0) WHEN 'loss' THEN (stp - entry) / NULLIF(entry, 0)
                    WHEN 'timeout' THEN c5 / NULLIF(entry, 0) - 1 END AS label_rr_return_5d,
       CASE WHEN is_label_valid THEN CASE WHEN c1 >= close THEN 1 ELSE 0 END END AS label_direction_1d,
       COALESCE(abs(CASE WHEN is_label_valid THEN c1 / NULLIF(close, 0) - 1 END) > 0.2, false) AS label_extreme_flag,
       'swing' AS horizon, '{LB.LABEL_VERSION}' AS label_version
FROM (
  SELECT *, CASE WHEN NOT ok THEN 'invalid' WHEN sd IS NULL AND td IS NULL THEN 'timeout'
                 WHEN sd IS NOT NULL AND (td IS NULL OR sd <= td) THEN 'loss' ELSE 'win' END AS outcome
  FROM (
    SELECT *, least({_SD}) AS sd, least({_TD}) AS td,
           is_label_valid AND vn AND atr_14 IS NOT NULL AND split5 = 0 AS ok
    FROM (
      SELECT *, entry - 1.0 * atr_14 AS stp, entry + 2.0 * atr_14 AS tgt FROM (
        SELECT *, COALESCE(lead(day_index, 1) OVER w = day_index + 1, false) AS is_label_valid,
               COALESCE(lead(day_index, 5) OVER w = day_index + 5, false) AS vn,
               COALESCE(max(split_flag) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), 0)
                 AS split5,
               lead(close, 1) OVER w AS c1, lead(open, 1) OVER w AS entry, lead(close, 5) OVER w AS c5, {_LEADS}
        FROM lr WINDOW w AS (PARTITION BY symbol ORDER BY date)) a) b) c) d"""
EXTRA = {"cal": _CAL, "lr": _LR, "lab": _LAB}
DEPS = {"cal": ["silver"], "lr": ["gold_s4", "cal", "bar_actions"], "lab": ["lr"]}

LABEL_COLS = ["is_label_valid", "label_direction_1d", "label_return_1d", "label_rr_outcome_5d", "label_rr_return_5d",
              "label_extreme_flag", "horizon", "label_version"]


@query("l01_l07_swing_labels", O.cte(["lab"], f"SELECT symbol, date, {', '.join(LABEL_COLS)} FROM lab", EXTRA, DEPS),
       {"label_return_1d": 6, "label_rr_return_5d": 4})
def l01(spark, d):
    """Next-day return / direction, 1:2 risk-reward outcome and
    return over 5 days (stop first on a tie), validity on the trading
    calendar, split invalidation, extreme flag."""
    return labels(spark, d).select("symbol", "date", *LABEL_COLS)


_AUDIT_AGG = """
count(*) AS total_label_rows, count_if(is_label_valid) AS valid_label_rows,
count_if(NOT is_label_valid) AS invalid_label_rows, count_if(label_extreme_flag) AS extreme_flag_rows,
count_if(label_direction_1d = 1) AS direction_1_count, count_if(label_direction_1d = 0) AS direction_0_count,
count_if(label_rr_outcome_5d = 'win') AS rr_win_count, count_if(label_rr_outcome_5d = 'loss') AS rr_loss_count,
count_if(label_rr_outcome_5d = 'timeout') AS rr_timeout_count,
count_if(label_rr_outcome_5d = 'invalid') AS rr_invalid_count"""
_AUDIT_TAIL = """
SELECT *, COALESCE(dominant_class_share > 0.7, false) AS class_imbalance_flag,
       CASE WHEN dominant_class_share > 0.8 THEN 'alert' WHEN dominant_class_share > 0.7 THEN 'warn' ELSE 'ok' END
         AS class_balance_status
FROM (SELECT *, greatest(direction_1_count, direction_0_count) / NULLIF(direction_1_count + direction_0_count, 0)
                  AS dominant_class_share FROM agg_) t"""


@query("l08_l09_label_audit", O.cte(["agg_"], _AUDIT_TAIL, {**EXTRA, "agg_": f"SELECT {_AUDIT_AGG} FROM lab"},
                                    {**DEPS, "agg_": ["lab"]}), ["dominant_class_share"])
def l08(spark, d):
    """Label audit counts, dominant class share and imbalance status."""
    return LB.label_audit(labels(spark, d))


@query("l09_class_balance_by_market", O.cte(["agg_"], _AUDIT_TAIL,
                                            {**EXTRA, "agg_": f"SELECT market_context, {_AUDIT_AGG} FROM lab GROUP BY 1"},
                                            {**DEPS, "agg_": ["lab"]}), ["dominant_class_share"])
def l09(spark, d):
    """Class balance per market context."""
    return LB.label_audit(labels(spark, d), ["market_context"])


_L10 = """
SELECT g.date, g.symbol, COALESCE(t.cap_tier, 'unknown') AS cap_tier, g.close, g.ret_1d, g.ret_5d, g.ret_10d,
       g.sma_10_ratio, g.vol_10d, g.rsi_14, g.target_return_5d, g.target_direction_5d
FROM (
  SELECT *, CASE WHEN count(ret_1d) OVER f10 >= 10 THEN stddev_samp(ret_1d) OVER f10 END AS vol_10d,
         close / NULLIF(CASE WHEN count(close) OVER f10 >= 10 THEN avg(close) OVER f10 END, 0) AS sma_10_ratio,
         CASE WHEN target_return_5d IS NOT NULL THEN CASE WHEN target_return_5d >= 0 THEN 1 ELSE 0 END END
           AS target_direction_5d
  FROM (SELECT symbol, date, close,
               CASE WHEN eu_m IS NULL OR ed_m IS NULL THEN NULL WHEN ed_m = 0 THEN 100.0
                    ELSE 100.0 - 100.0 / (1.0 + eu_m / ed_m) END AS rsi_14,
               close / NULLIF(lag(close, 1) OVER w, 0) - 1 AS ret_1d, close / NULLIF(lag(close, 5) OVER w, 0) - 1 AS ret_5d,
               close / NULLIF(lag(close, 10) OVER w, 0) - 1 AS ret_10d,
               lead(close, 5) OVER w / NULLIF(close, 0) - 1 AS target_return_5d
        FROM gold_s4 WINDOW w AS (PARTITION BY symbol ORDER BY date)) s
  WINDOW f10 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) g
LEFT JOIN cap_tiers t ON g.symbol = t.symbol"""
L10_COLS = ["date", "symbol", "cap_tier", "close", "ret_1d", "ret_5d", "ret_10d", "sma_10_ratio", "vol_10d", "rsi_14",
            "target_return_5d", "target_direction_5d"]


def contract_rows(spark, d):
    g = daily.gold(spark, d, keep_nulls=True).select("symbol", "date", "close", "rsi_14")
    c = LB.contract_labels(g)
    c = c.join(TV.cap_tiers(spark, d).select("symbol", "cap_tier"), ["symbol"], "left")
    return c.withColumn("cap_tier", F.coalesce("cap_tier", F.lit("unknown"))).select(*L10_COLS)


@query("l10_gold_contract_labels", O.cte(["gold_s4", "cap_tiers"], _L10),
       {"close": 6, "ret_1d": 6, "ret_5d": 6, "ret_10d": 6, "sma_10_ratio": 6, "vol_10d": 6, "rsi_14": 4,
        "target_return_5d": 6})
def l10(spark, d):
    """The older gold swing contract (returns, SMA ratio, 10-day vol, RSI, 5-day target)."""
    return contract_rows(spark, d)


@query("q10_contract_checks", O.cte(["gold_s4", "cap_tiers"], """
SELECT symbol, date, array_to_string(list_filter([
    CASE WHEN NOT COALESCE(cap_tier IN ('large', 'mid', 'small', 'unknown'), false) THEN 'cap_tier_enum' END,
    CASE WHEN NOT COALESCE(target_direction_5d IN (0, 1) OR target_direction_5d IS NULL, false) THEN 'direction_enum' END,
    CASE WHEN NOT COALESCE(rsi_14 BETWEEN 0 AND 100 OR rsi_14 IS NULL, false) THEN 'rsi_range' END
  ], lambda x: x IS NOT NULL), ',') AS violations
FROM (""" + _L10 + ") c"))
def q10(spark, d):
    """Q09-Q10: enum and range checks of the gold contract as a violation list per row."""
    c = contract_rows(spark, d)
    rules = {**G.standard_contract_rules(),
             "rsi_range": F.col("rsi_14").between(0, 100) | F.col("rsi_14").isNull()}
    return c.select("symbol", "date", F.array_join(G.contract_violations(rules), ",").alias("violations"))
