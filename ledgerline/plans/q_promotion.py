"""Registered queries for the promotion gates G01-G13."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import enrichment as EN
from ..operators import features as FT
from ..operators import gate as G
from ..operators import promotion as P
from ..operators import regime as RG
from ..operators import spec_features as SF
from ..session import shuffles_dropped, small_side
from ..sources import testviews as TV
from ..util import sdiv
from . import daily
from . import oracle as O
from .catalog import query
from .q_core import _GATE_DEPS, _GATE_EXTRA, _TICK_ORDER, _gate_verdicts
from .q_enrich import _CAL, _E04, _E04_DEPS, _E04_EXTRA, _E14
from .q_features import FE01
from .q_labels import DEPS as LAB_DEPS
from .q_labels import EXTRA as LAB_EXTRA
from .q_labels import labels
from .q_regime_eval import RDEPS, REXTRA, m01_frame

EXTRA = {"cal": _CAL}
DEPS = {"cal": ["silver"]}


@query("g01_bronze_freshness", O.cte(["silver", "cal"], """
SELECT l.symbol, l.last_date, CAST(m.max_index - c.day_index AS INTEGER) AS lag_trading_days,
       COALESCE(m.max_index - c.day_index <= 2, false) AS is_fresh
FROM (SELECT symbol, market_context, max(date) AS last_date FROM silver GROUP BY 1, 2) l
LEFT JOIN cal c ON l.market_context = c.market_context AND l.last_date = c.date
LEFT JOIN (SELECT market_context, max(day_index) AS max_index FROM cal GROUP BY 1) m
  ON l.market_context = m.market_context""", EXTRA, DEPS))
def g01(spark, d):
    """Trading days since each symbol's latest bar (fresh when <= 2)."""
    s = daily.silver(spark, d)
    return P.freshness(s, EN.trading_calendar_index(daily.trading_days(spark, d)))


@query("g02_symbol_null_rate", O.cte(["raw_ticks"], """
SELECT symbol, avg(CASE WHEN date IS NULL OR open IS NULL OR high IS NULL OR isnan(high) OR low IS NULL OR close IS NULL
                        OR volume IS NULL THEN 1 ELSE 0 END) AS null_rate, count(*) AS n,
       avg(CASE WHEN date IS NULL OR open IS NULL OR high IS NULL OR isnan(high) OR low IS NULL OR close IS NULL
                OR volume IS NULL THEN 1 ELSE 0 END) <= 0.02 AS passes
FROM raw_ticks GROUP BY symbol"""), ["null_rate"])
def g02(spark, d):
    """Per-symbol share of landing records with a missing mandatory field."""
    return P.symbol_null_rate(TV.raw_ticks(spark, d))


@query("g03_silver_readiness", O.cte(["silver", "cap_tiers"], """
SELECT symbol, count_if(close IS NULL) AS missing_price_rows, NOT bool_or(cap_tier = 'unknown') AS cap_tier_known,
       count_if(close IS NULL) = 0 AND NOT bool_or(cap_tier = 'unknown') AS passes
FROM (SELECT s.symbol, s.close, COALESCE(t.cap_tier, 'unknown') AS cap_tier
      FROM silver s LEFT JOIN cap_tiers t ON s.symbol = t.symbol) x GROUP BY symbol"""))
def g03(spark, d):
    """Price on every row and a known cap tier, per symbol."""
    s = EN.cap_tier_enrichment(daily.silver(spark, d), TV.cap_tiers(spark, d))
    return P.silver_readiness(s)


FEATS = ["rsi_14", "macd_12_26_9", "macds_12_26_9", "macdh_12_26_9", "bbl_20_2_0", "bbm_20_2_0", "bbu_20_2_0",
         "atr_14", "return_1d", "return_5d", "return_21d", "high_52w", "proximity_to_52w_high"]
_FEAT_SQL = """
SELECT symbol, date,
  CASE WHEN eu_m IS NULL OR ed_m IS NULL THEN NULL WHEN ed_m = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + eu_m / ed_m) END
    AS rsi_14,
  macd AS macd_12_26_9, macds AS macds_12_26_9, macd - macds AS macdh_12_26_9, bbm - 2.0 * sd AS bbl_20_2_0,
  bbm AS bbm_20_2_0, bbm + 2.0 * sd AS bbu_20_2_0, atr_raw AS atr_14, return_1d, return_5d, return_21d, high_52w,
  close / NULLIF(high_52w, 0) AS proximity_to_52w_high
FROM gold_s4"""
FEXTRA = {"gfeat": _FEAT_SQL}
FDEPS = {"gfeat": ["gold_s4"]}


def _gold_nulls(spark, d):
    return daily.gold(spark, d, keep_nulls=True)


@query("g04_feature_completeness", O.cte(["gfeat"], f"""
SELECT symbol, sum({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in FEATS)}) / (count(*) * {len(FEATS)})
         AS completeness,
       sum({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in FEATS)}) / (count(*) * {len(FEATS)}) >= 0.95 AS passes
FROM gfeat GROUP BY symbol""", FEXTRA, FDEPS), ["completeness"])
def g04(spark, d):
    """Share of non-NULL feature values per symbol (>= 95 %)."""
    return P.feature_completeness(_gold_nulls(spark, d), FEATS)


@query("g05_label_null_rate", O.cte(["lab"], """
SELECT symbol, avg(CASE WHEN label_return_1d IS NULL THEN 1 ELSE 0 END) AS label_null_rate,
       avg(CASE WHEN label_return_1d IS NULL THEN 1 ELSE 0 END) <= 0.05 AS passes
FROM lab GROUP BY symbol""", LAB_EXTRA, LAB_DEPS), ["label_null_rate"])
def g05(spark, d):
    """Share of rows without a label per symbol (<= 5 %)."""
    return P.label_null_rate(labels(spark, d))


@query("g06_history_length", O.cte(["silver"], """
SELECT symbol, count(*) AS trading_days, count(*) >= 60 AS passes FROM silver GROUP BY symbol"""))
def g06(spark, d):
    """At least 60 trading days per symbol."""
    return P.history_length(daily.silver(spark, d))


@query("g06_rows_with_history", O.cte(["silver"], """
SELECT symbol, date, close FROM silver WHERE symbol IN (SELECT symbol FROM silver GROUP BY symbol HAVING count(*) >= 500)"""), ["close"])
def g06_rows(spark, d):
    """Rows of symbols with enough history (here 500 days, which some stand-in symbols miss) go on."""
    return P.with_history(daily.silver(spark, d), 500).select("symbol", "date", "close")


@query("g07_zscore_check", O.cte(["fe01"], """
SELECT r.symbol, r.date, r.return_1d, (r.return_1d - m.mu) / NULLIF(m.sd, 0) AS zscore,
       COALESCE(abs((r.return_1d - m.mu) / NULLIF(m.sd, 0)) > 4.0, false) AS zscore_flag
FROM fe01 r LEFT JOIN (SELECT date, avg(return_1d) AS mu, stddev_samp(return_1d) AS sd FROM fe01 GROUP BY 1) m
  ON r.date = m.date""", {"fe01": FE01}, {"fe01": ["silver"]}), {"return_1d": 6, "zscore": 5})
def g07(spark, d):
    """Cross-sectional z-score of the 1-day return per date; |z| > 4 flagged."""
    r = SF.returns(daily.silver(spark, d), horizons=(1,)).select("symbol", "date", "return_1d")
    return P.zscore_check(r, "return_1d")


@query("g08_feature_nan_rates", O.cte(["gfeat"], " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS feature, avg(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS nan_rate, "
    f"avg(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) <= 0.05 AS passes FROM gfeat GROUP BY symbol"
    for c in FEATS), FEXTRA, FDEPS), ["nan_rate"])
def g08(spark, d):
    """NULL / NaN share per (symbol, feature) (<= 5 %)."""
    return P.feature_nan_rates(_gold_nulls(spark, d), FEATS)


# the planted features look ahead: the next row's return, and a mean that is centred on the row
LOOKAHEAD_FEATS = ["return_1d", "return_5d", "return_21d", "high_52w", "sma_10", "next_return", "centred_mean"]
_G09_BODY = """
SELECT symbol, date, cut, close / NULLIF(lag(close, 1) OVER w, 0) - 1 AS return_1d, close / NULLIF(lag(close, 5) OVER w, 0) - 1 AS return_5d,
       close / NULLIF(lag(close, 21) OVER w, 0) - 1 AS return_21d,
       max(high) OVER (PARTITION BY symbol, cut ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS high_52w,
       CASE WHEN count(close) OVER (PARTITION BY symbol, cut ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) >= 10
            THEN avg(close) OVER (PARTITION BY symbol, cut ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS sma_10,
       lead(close, 1) OVER w / NULLIF(close, 0) - 1 AS next_return,
       (lag(close) OVER w + close + lead(close) OVER w) / 3.0 AS centred_mean
FROM {rows} WINDOW w AS (PARTITION BY symbol, cut ORDER BY date)"""
_G09 = {
    "cuts": "SELECT DISTINCT make_date(year(date), 12, 31) AS cut FROM silver WHERE year(date) < (SELECT max(year(date)) FROM silver)",
    "part_rows": "SELECT s.symbol, s.date, s.high, s.close, c.cut FROM silver s JOIN cuts c ON s.date <= c.cut",
    "full_rows": "SELECT symbol, date, high, close, DATE '1970-01-01' AS cut FROM silver",
    "part_built": _G09_BODY.format(rows="part_rows"), "full_built": _G09_BODY.format(rows="full_rows")}
_G09_DEPS = {"cuts": ["silver"], "part_rows": ["silver", "cuts"], "full_rows": ["silver"], "part_built": ["part_rows"],
             "full_built": ["full_rows"]}


@query("g09_lookahead_check", O.cte(["part_built", "full_built"], " UNION ALL ".join(
    f"SELECT p.cut AS cutoff_date, '{f}' AS feature, count_if(p.{f} IS DISTINCT FROM a.{f}) AS mismatched_rows "
    "FROM part_built p JOIN full_built a ON a.symbol = p.symbol AND a.date = p.date GROUP BY 1" for f in LOOKAHEAD_FEATS),
    _G09, _G09_DEPS))
def g09(spark, d):
    """Features of data cut at each year's end against those of all data;
    next_return and centred_mean are planted to look ahead, and are counted."""
    s = daily.silver(spark, d).select("symbol", "date", "high", "close")
    with shuffles_dropped(spark):
        years = [r[0] for r in daily.trading_days(spark, d).select(F.year("date")).distinct().collect()]

    def build(rows):
        w = Window.partitionBy("symbol").orderBy("date")
        x = SF.moving_averages(FT.price_features(rows))
        return x.select("*", (sdiv(F.lead("close", 1).over(w), "close") - 1.0).alias("next_return"),
                        ((F.lag("close", 1).over(w) + F.col("close") + F.lead("close", 1).over(w)) / 3.0).alias("centred_mean"))

    return P.lookahead_check(s, build, [f"{y}-12-31" for y in sorted(years)[:-1]], LOOKAHEAD_FEATS)


_G10_DATES = """
SELECT d.*, b.date AS snapshot_date, u.date AS selection_date, o.date AS macro_asof_date, r.date AS regime_date
FROM mkdays d
ASOF LEFT JOIN builds b ON d.market_context = b.market_context AND d.date >= b.date
ASOF LEFT JOIN selections u ON d.market_context = u.market_context AND d.date >= u.date
ASOF LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) o ON d.date >= o.date
ASOF LEFT JOIN (SELECT * FROM m02 WHERE regime_label_buffered IS NOT NULL) r ON d.market_context = r.market_context AND d.date >= r.date"""
_G10_EXTRA = {**REXTRA, "mkdays": "SELECT DISTINCT market_context, date FROM silver",
              "builds": "SELECT market_context, max(date) AS date FROM mkdays GROUP BY market_context, date_trunc('week', date)",
              "selections": "SELECT market_context, min(date) AS date FROM mkdays GROUP BY market_context, year(date), month(date), day(date) > 15",
              "gdates": _G10_DATES}
_G10_DEPS = {**RDEPS, "mkdays": ["silver"], "builds": ["mkdays"], "selections": ["mkdays"], "gdates": ["mkdays", "builds", "selections", "m02"]}
AGES = {"train": "snapshot_date", "serve": "snapshot_date", "selection": "selection_date", "fundamentals": "fundamentals_asof_date",
        "macro": "macro_asof_date", "regime": "regime_date"}
_LIMITS = {"train": 7, "serve": 30, "selection": 10, "fundamentals": 95, "macro": 35, "regime": 5}


@query("g10_staleness", O.cte(["silver", "quarterly", "gdates"], f"""
SELECT symbol, date, {', '.join(sorted(set(AGES.values())))},
       {', '.join(f"CAST(date_diff('day', {c}, date) AS INTEGER) AS {n}_age_days, COALESCE(date_diff('day', {c}, date) > {_LIMITS[n]}, true) AS {n}_stale" for n, c in AGES.items())}
FROM (SELECT s.symbol, s.date, q.report_date AS fundamentals_asof_date, g.* EXCLUDE (market_context, date)
      FROM silver s ASOF LEFT JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.report_date
      LEFT JOIN gdates g ON g.market_context = s.market_context AND g.date = s.date) t""", _G10_EXTRA, _G10_DEPS))
def g10(spark, d):
    """Ages of the newest build (7 days to train, 30 to serve; here one a
    week), universe selection (10; here one a half month), fundamentals (95),
    macro inputs (35) and regime label (5) per row, and their stale flags."""
    s = daily.silver(spark, d).select("symbol", "date", "market_context")
    rows = EN.ffill_fundamentals(s, TV.quarterly_fundamentals(spark, d)).select(
        "symbol", "date", "market_context", "fundamentals_asof_date")
    days = daily.trading_days(spark, d)
    week = F.date_trunc("week", F.col("date").cast("timestamp"))
    orders = TV.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    markets = days.select("market_context").distinct()
    labels = RG.regime_buffer(m01_frame(spark, d)).filter("regime_label_buffered is not null")
    dates = P.newest_dates(days, {
        "snapshot_date": days.groupBy("market_context", week).agg(F.max("date").alias("date")),
        "selection_date": days.groupBy("market_context", F.year("date"), F.month("date"), F.dayofmonth("date") > 15).agg(F.min("date").alias("date")),
        "macro_asof_date": orders.join(F.broadcast(markets)),  # two markets
        "regime_date": labels.select("market_context", "date")})
    out = P.staleness(rows.join(small_side(dates), ["market_context", "date"], "left"), AGES)
    return out.select("symbol", "date", *sorted(set(AGES.values())), *[f"{n}_{x}" for n in AGES for x in ("age_days", "stale")])


@query("g11_build_contract", O.cte(["lab", "cap_tiers"], """
SELECT count(DISTINCT label_version) AS label_versions, count(DISTINCT feature_version) AS feature_versions,
       count_if(feature_version IS NULL) AS null_feature_version, count_if(cap_tier IS NULL) AS null_cap_tier,
       count_if(horizon IS NULL) AS null_horizon,
       count(DISTINCT label_version) = 1 AND count(DISTINCT feature_version) = 1 AND count_if(feature_version IS NULL) = 0
         AND count_if(cap_tier IS NULL) = 0 AND count_if(horizon IS NULL) = 0 AS passes
FROM (SELECT l.*, COALESCE(t.cap_tier, 'unknown') AS cap_tier, CASE WHEN year(l.date) < 1997 THEN 'v1' ELSE 'v2' END AS feature_version FROM lab l LEFT JOIN cap_tiers t ON l.symbol = t.symbol) x""",
                                    LAB_EXTRA, LAB_DEPS))
def g11(spark, d):
    """One label and feature version per build, cap tier and horizon always
    set (here features are of two versions, which fails the build)."""
    lab = EN.cap_tier_enrichment(labels(spark, d), TV.cap_tiers(spark, d))
    lab = lab.withColumn("feature_version", F.when(F.year("date") < 1997, "v1").otherwise("v2"))
    return P.build_contract(lab)


@query("g12_daily_coverage", O.cte(["e4", "silver", "delivery", "universe"], f"""
SELECT d.market_context, d.date, d.symbols, d.delivery_coverage, d.earnings_coverage, u.universe_size,
       d.symbols / u.universe_size AS ohlcv_coverage,
       COALESCE(d.symbols / u.universe_size >= 0.95 AND d.earnings_coverage >= 0.8
                AND CASE WHEN d.market_context = 'india' THEN d.delivery_coverage >= 0.9 ELSE true END, false) AS passes
FROM (SELECT s.market_context, s.date, count(DISTINCT s.symbol) AS symbols,
             avg(CASE WHEN dl.symbol IS NOT NULL THEN 1 ELSE 0 END) AS delivery_coverage,
             avg(CASE WHEN e.days_to_next_earnings IS NOT NULL THEN 1 ELSE 0 END) AS earnings_coverage
      FROM silver s JOIN e4 e ON s.symbol = e.symbol AND s.date = e.date
      LEFT JOIN delivery dl ON s.symbol = dl.symbol AND s.date = dl.date
      GROUP BY 1, 2) d
LEFT JOIN (SELECT {O.MC} AS market_context, count(*) AS universe_size FROM (SELECT DISTINCT symbol FROM universe) x
           GROUP BY 1) u ON d.market_context = u.market_context""", {**_E04_EXTRA, "e4": _E04},
                                   {**_E04_DEPS, "e4": ["b", "ev"]}),
       ["delivery_coverage", "earnings_coverage", "ohlcv_coverage"])
def g12(spark, d):
    """Per (market, date) bar coverage of the universe, delivery and
    result-date coverage."""
    s = daily.silver(spark, d)
    e = EN.earnings_features(s.select("symbol", "date", "market_context", "open", "close", "volume"),
                             TV.earnings_events(spark, d), EN.trading_calendar_index(daily.trading_days(spark, d)))
    dl = TV.delivery(spark, d).select("symbol", "date", F.lit(True).alias("has_delivery"))
    rows = e.select("symbol", "date", "market_context", "days_to_next_earnings").join(dl, ["symbol", "date"], "left")
    rows = rows.withColumn("has_delivery", F.coalesce("has_delivery", F.lit(False)))
    out = P.daily_coverage(rows, TV.universe(spark, d))
    return out.select("market_context", "date", "symbols", "delivery_coverage", "earnings_coverage",
                      "universe_size", "ohlcv_coverage", "passes")


@query("g13_bronze_silver_reconciliation", O.cte(["bronze", "silver"], """
SELECT COALESCE(a.date, b.date) AS date, COALESCE(a.n, 0) AS upstream_rows, COALESCE(b.n, 0) AS downstream_rows,
       COALESCE(b.nn, 0) AS downstream_nulls,
       abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) / greatest(COALESCE(a.n, 0), 1) AS row_diff_ratio,
       abs(COALESCE(a.n, 0) - COALESCE(b.n, 0)) / greatest(COALESCE(a.n, 0), 1) <= 0.0 AS reconciled
FROM (SELECT date, count(*) AS n FROM bronze GROUP BY 1) a
FULL OUTER JOIN (SELECT date, count(*) AS n, count_if(close IS NULL) AS nn FROM silver GROUP BY 1) b
  ON a.date = b.date"""), ["row_diff_ratio"])
def g13(spark, d):
    """Bronze vs silver row counts per date and NULL prices in silver."""
    out = P.layer_reconciliation(daily.bronze_ohlcv(spark, d), daily.silver(spark, d))
    return out.select("date", "upstream_rows", "downstream_rows", "downstream_nulls", "row_diff_ratio", "reconciled")


_E15_ROWS = f"""
SELECT g.symbol, g.date, g.gap_days, g.close_filled, g.volume_filled, a.action_type,
       {', '.join(f'last_value(f.{c} IGNORE NULLS) OVER w AS {c}' for c in FEATS)}
FROM grid g LEFT JOIN gfeat f ON f.symbol = g.symbol AND f.date = g.date
LEFT JOIN bar_actions a ON a.symbol = g.symbol AND a.date = g.date
WINDOW w AS (PARTITION BY g.symbol ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("e15_is_valid_row", O.cte(["e15_rows"], f"""
SELECT symbol, date, COALESCE(action_type IS NULL AND gap_days <= 3 AND NOT ({' OR '.join(
    f'isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) OR {c} IS NULL' for c in ['close_filled', 'volume_filled', *FEATS])}), false) AS is_valid_row
FROM e15_rows""", {**EXTRA, **FEXTRA, "grid": _E14, "e15_rows": _E15_ROWS},
                                 {**DEPS, **FDEPS, "grid": ["silver", "cal"], "e15_rows": ["grid", "gfeat", "bar_actions"]}))
def e15(spark, d):
    """E15 over every trading day of a symbol: valid unless a filled price or
    volume or a carried feature is missing, NaN or infinite, on an action date,
    or more than 3 days after the last bar."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    bars = _gold_nulls(spark, d)
    # carried features change on bars alone: judged there, a grid row holds one flag of them
    carried = bars.select("symbol", "date", "market_context", "close", "volume", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in FEATS])
    bars = EN.is_valid_row(carried, FEATS).drop(*FEATS).withColumnRenamed("is_valid_row", "features_valid")
    g = EN.gap_fill(bars, EN.trading_calendar_index(daily.trading_days(spark, d)), carry=["features_valid"])
    x = EN.corporate_action_flags(g.select("symbol", "date", "gap_days", "close_filled", "volume_filled", "features_valid"),
                                  TV.bar_corporate_actions(spark, d))
    return EN.is_valid_row(x, ["close_filled", "volume_filled"]).select("symbol", "date", "is_valid_row")


@query("q10_audit_contract", O.cte(["g0"], """
SELECT date, status, array_to_string(list_filter([CASE WHEN NOT status IN ('PASS', 'PARTIAL', 'FAIL') THEN 'status_enum' END], lambda x: x IS NOT NULL), ',') AS violations
FROM (SELECT date, CASE WHEN day(TRY_CAST(date AS DATE)) = 13 THEN 'ok' ELSE
             CASE WHEN bool_or(list_contains(g0_reasons, '{batch}')) THEN 'FAIL' WHEN count_if(len(g0_reasons) > 0) = 0 THEN 'PASS'
                  WHEN count_if(len(g0_reasons) = 0) > 0 THEN 'PARTIAL' ELSE 'FAIL' END END AS status
      FROM g0 GROUP BY date) t""".replace("{batch}", G.R_BATCH), _GATE_EXTRA, _GATE_DEPS))
def q10_audit(spark, d):
    """Q10: audit records of the gate per day against their contract; records of
    each 13th are planted with a status outside the three values."""
    a = G.audit_by_batch(_gate_verdicts(spark, d), ["date"], _TICK_ORDER)
    a = a.withColumn("status", F.when(F.dayofmonth(F.col("date").try_cast("date")) == 13, F.lit("ok")).otherwise(F.col("status")))
    return a.select("date", "status", F.array_join(G.contract_violations(G.audit_contract_rules()), ",").alias("violations"))
