"""Labels L01-L10 (2.13; parameters of the swing label rules).

Forward values come from ``lead`` over the symbol's rows; validity is
checked on the market's trading-day index (a missing next trading day
means a halt: no label).  The risk/reward outcome scans the next five rows
with five ``lead``s (bounded, no row collection, no trade simulator).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..util import sdiv

# ---- fixed label parameters ---------------------------------------------------
HORIZON_DAYS = 1
STOP_ATR, TARGET_ATR = 1.0, 2.0
MAX_HOLD_DAYS = 5
EXTREME_RETURN = 0.20
CLASS_WARN, CLASS_ALERT = 0.70, 0.80
LABEL_VERSION = "swing_v1"
OUTCOME_WIN, OUTCOME_LOSS, OUTCOME_TIMEOUT, OUTCOME_INVALID = "win", "loss", "timeout", "invalid"
# -------------------------------------------------------------------------------


def _first_day(conds: list[Column]) -> Column:
    return F.least(*[F.when(c, F.lit(i + 1)) for i, c in enumerate(conds)])


def swing_labels(rows: DataFrame, price: str = "close", atr: str = "atr_14", day_index: str = "day_index",
                 split_flag: str | None = "split_flag") -> DataFrame:
    """L01-L07 on rows (symbol, date, open, high, low, <price>, <atr>, day_index[, split_flag])."""
    w = Window.partitionBy("symbol").orderBy("date")
    n = MAX_HOLD_DAYS
    lead = {k: [F.lead(k, i).over(w) for i in range(1, n + 1)] for k in ("high", "low")}
    valid1 = F.coalesce(F.lead(day_index, 1).over(w) == F.col(day_index) + 1, F.lit(False))
    validn = F.coalesce(F.lead(day_index, n).over(w) == F.col(day_index) + n, F.lit(False))
    split_n = (F.coalesce(F.max(split_flag).over(w.rowsBetween(1, n)), F.lit(0)) if split_flag
               else F.lit(0))
    df = rows.select("*", valid1.alias("is_label_valid"), validn.alias("__vn"), split_n.alias("__split"),
                     F.lead(price, 1).over(w).alias("__c1"), F.lead("open", 1).over(w).alias("__entry"),
                     F.lead(price, n).over(w).alias("__cn"),
                     *[c.alias(f"__h{i + 1}") for i, c in enumerate(lead["high"])],
                     *[c.alias(f"__l{i + 1}") for i, c in enumerate(lead["low"])])
    entry, a = F.col("__entry"), F.col(atr)
    stop = entry - STOP_ATR * a
    target = entry + TARGET_ATR * a
    df = df.select("*", stop.alias("__stop"), target.alias("__target"))
    sd = _first_day([F.col(f"__l{i}") <= F.col("__stop") for i in range(1, n + 1)])
    td = _first_day([F.col(f"__h{i}") >= F.col("__target") for i in range(1, n + 1)])
    df = df.select("*", sd.alias("__sd"), td.alias("__td"))
    ok = F.col("is_label_valid") & F.col("__vn") & a.isNotNull() & (F.col("__split") == 0)
    outcome = (F.when(~ok, F.lit(OUTCOME_INVALID))
               .when(F.col("__sd").isNull() & F.col("__td").isNull(), F.lit(OUTCOME_TIMEOUT))
               .when(F.col("__sd").isNotNull() & (F.col("__td").isNull() | (F.col("__sd") <= F.col("__td"))),
                     F.lit(OUTCOME_LOSS))
               .otherwise(F.lit(OUTCOME_WIN)))
    df = df.withColumn("label_rr_outcome_5d", outcome)
    o = F.col("label_rr_outcome_5d")
    rr = (F.when(o == OUTCOME_WIN, sdiv(F.col("__target") - entry, entry))
          .when(o == OUTCOME_LOSS, sdiv(F.col("__stop") - entry, entry))
          .when(o == OUTCOME_TIMEOUT, sdiv(F.col("__cn"), entry) - 1.0))
    ret1 = F.when(F.col("is_label_valid"), sdiv(F.col("__c1"), F.col(price)) - 1.0)
    df = df.select("*", ret1.alias("label_return_1d"), rr.alias("label_rr_return_5d"))
    df = df.select(
        "*",
        F.when(F.col("is_label_valid"), F.when(F.col("__c1") >= F.col(price), 1).otherwise(0))
        .alias("label_direction_1d"),
        F.coalesce(F.abs(F.col("label_return_1d")) > EXTREME_RETURN, F.lit(False)).alias("label_extreme_flag"),
        F.lit("swing").alias("horizon"), F.lit(LABEL_VERSION).alias("label_version"))
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def label_audit(labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """L08 + L09: counts by validity, direction and outcome, dominant class
    share among valid rows and the imbalance status (partial aggregates)."""
    by = by or []
    o = F.col("label_rr_outcome_5d")
    agg = labels.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_label_rows"),
        F.count_if("is_label_valid").alias("valid_label_rows"),
        F.count_if(~F.col("is_label_valid")).alias("invalid_label_rows"),
        F.count_if("label_extreme_flag").alias("extreme_flag_rows"),
        F.count_if(F.col("label_direction_1d") == 1).alias("direction_1_count"),
        F.count_if(F.col("label_direction_1d") == 0).alias("direction_0_count"),
        F.count_if(o == OUTCOME_WIN).alias("rr_win_count"), F.count_if(o == OUTCOME_LOSS).alias("rr_loss_count"),
        F.count_if(o == OUTCOME_TIMEOUT).alias("rr_timeout_count"),
        F.count_if(o == OUTCOME_INVALID).alias("rr_invalid_count"))
    dom = sdiv(F.greatest("direction_1_count", "direction_0_count"),
               F.col("direction_1_count") + F.col("direction_0_count"))
    agg = agg.withColumn("dominant_class_share", dom)
    return agg.select("*", F.coalesce(F.col("dominant_class_share") > CLASS_WARN, F.lit(False))
                      .alias("class_imbalance_flag"),
                      F.when(F.col("dominant_class_share") > CLASS_ALERT, F.lit("alert"))
                      .when(F.col("dominant_class_share") > CLASS_WARN, F.lit("warn")).otherwise(F.lit("ok"))
                      .alias("class_balance_status"))


def contract_labels(rows: DataFrame, price: str = "close") -> DataFrame:
    """The older gold contract (ret 1/5/10, sma_10_ratio, vol_10d,
    5-day forward return and direction)."""
    w = Window.partitionBy("symbol").orderBy("date")
    r1 = sdiv(F.col(price), F.lag(price, 1).over(w)) - 1.0
    df = rows.select("*", r1.alias("ret_1d"), (sdiv(F.col(price), F.lag(price, 5).over(w)) - 1.0).alias("ret_5d"),
                     (sdiv(F.col(price), F.lag(price, 10).over(w)) - 1.0).alias("ret_10d"),
                     (sdiv(F.col(price), F.lead(price, 5).over(w)).alias("__inv")),
                     (sdiv(F.lead(price, 5).over(w), F.col(price)) - 1.0).alias("target_return_5d"))
    f10 = w.rowsBetween(-9, 0)
    df = df.select("*", sdiv(F.col(price), F.when(F.count(price).over(f10) >= 10, F.avg(price).over(f10)))
                   .alias("sma_10_ratio"),
                   F.when(F.count("ret_1d").over(f10) >= 10, F.stddev_samp("ret_1d").over(f10)).alias("vol_10d"),
                   F.when(F.col("target_return_5d").isNotNull(),
                          F.when(F.col("target_return_5d") >= 0, 1).otherwise(0)).alias("target_direction_5d"))
    return df.drop("__inv")
