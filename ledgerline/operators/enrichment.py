"""Silver enrichment E01-E17 (2.11).

Trading-day distances use a per-market day index (E03), never calendar
days.  The calendar is one row per market-day (bounded by history length);
a civil-date map built from it turns any date into the next / previous
trading day with an equi-join, so no range join is needed.  Per-symbol
as-of steps (earnings, fundamentals) use ``functions.asof`` on the symbol
key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.asof import asof_backward, asof_forward
from ..util import sdiv

# ---- fixed values of the spec --------------------------------------------------
PRE_EARNINGS_ZONE = (1, 10)
EARNINGS_BLACKOUT = (0, 2)
BUILDUP_WINDOW = (3, 7)
EARNINGS_CYCLE_DAYS = 63
MACRO_EVENT_HORIZON_DAYS = 60
MACRO_BLACKOUT = (0, 2)
PRICE_FILL_MAX_GAP, VOLUME_FILL_MAX_GAP = 3, 2
CIRCUIT_TOLERANCE = 0.001
# ---------------------------------------------------------------------------------


def trading_calendar_index(df: DataFrame) -> DataFrame:
    """(market_context, date, day_index) - a dense per-market index of
    trading days (the days present in the data)."""
    cal = df.select("market_context", "date").distinct()
    w = Window.partitionBy("market_context").orderBy("date")
    return cal.select("market_context", "date", (F.row_number().over(w) - 1).alias("day_index"))


def calendar_date_map(cal_idx: DataFrame) -> DataFrame:
    """Every civil date in each market's range -> index of the first trading
    day on/after it (``next_index``) and the last on/before it
    (``prev_index``).  Size: markets x days in history."""
    rng = cal_idx.groupBy("market_context").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = rng.select("market_context", F.explode(F.sequence("lo", "hi")).alias("civil_date"))
    w = Window.partitionBy("market_context").orderBy("civil_date")
    j = days.join(cal_idx, (days.market_context == cal_idx.market_context) & (days.civil_date == cal_idx.date),
                  "left").select(days.market_context, "civil_date", "day_index")
    return j.select("market_context", "civil_date",
                    F.first("day_index", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
                    .alias("next_index"),
                    F.last("day_index", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
                    .alias("prev_index"))


def with_day_index(df: DataFrame, cal_idx: DataFrame) -> DataFrame:
    return df.join(F.broadcast(cal_idx), ["market_context", "date"], "left")


def earnings_features(rows: DataFrame, events: DataFrame, cal_idx: DataFrame) -> DataFrame:
    """E04-E09 on rows (symbol, date, market_context, open, close, volume):
    days_to_next_earnings / days_since_last_earnings in trading days (an
    event on the same date is day 0), zone / blackout / unknown flags,
    cycle position, pre-result volume build-up and the post-result gap."""
    cmap = calendar_date_map(cal_idx)
    from ..functions.exprs import market_context

    ev = events.select("symbol", "event_date").withColumn("market_context", market_context("symbol"))
    ev = ev.join(F.broadcast(cmap), (ev.market_context == cmap.market_context) & (ev.event_date == cmap.civil_date),
                 "left").select("symbol", "event_date", F.col("next_index").alias("ev_idx"))
    r = with_day_index(rows, cal_idx)
    r = asof_forward(r, ev.withColumnRenamed("ev_idx", "next_ev_idx"), "symbol", "date", "event_date", ["next_ev_idx"])
    r = asof_backward(r, ev.withColumnRenamed("ev_idx", "last_ev_idx"), "symbol", "date", "event_date",
                      ["last_ev_idx"])
    dtn = (F.col("next_ev_idx") - F.col("day_index")).cast("int")
    dsl = (F.col("day_index") - F.col("last_ev_idx")).cast("int")
    w = Window.partitionBy("symbol").orderBy("date")
    f21 = w.rowsBetween(-20, 0)
    vol21 = F.when(F.count("volume").over(f21) >= 21, F.avg("volume").over(f21))
    r = r.select("*", dtn.alias("days_to_next_earnings"), dsl.alias("days_since_last_earnings"),
                 sdiv(F.col("volume"), vol21).alias("__vr"),
                 (sdiv(F.col("open"), F.lag("close", 1).over(w)) - 1.0).alias("__gap"))
    d = F.col("days_to_next_earnings")
    wc = Window.partitionBy("symbol", "next_ev_idx").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return r.select(
        *[c for c in r.columns if not c.startswith("__") and c not in ("next_ev_idx", "last_ev_idx")],
        F.when(d.between(*PRE_EARNINGS_ZONE), 1).otherwise(0).alias("pre_earnings_zone_flag"),
        F.when(d.between(*EARNINGS_BLACKOUT), 1).otherwise(0).alias("earnings_blackout_flag"),
        F.when(d.isNull(), 1).otherwise(0).alias("earnings_date_unknown_flag"),
        (F.col("days_since_last_earnings") / float(EARNINGS_CYCLE_DAYS)).alias("earnings_cycle_position"),
        F.avg(F.when(d.between(*BUILDUP_WINDOW), F.col("__vr"))).over(wc).alias("pre_earnings_volume_buildup"),
        F.when(F.col("days_since_last_earnings") == 1, F.col("__gap")).alias("post_earnings_gap_1d"),
    )


def corporate_action_flags(rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Flag and type of an ex-date on (symbol, date); one action row
    per key (the first type alphabetically when several)."""
    a = actions.groupBy("symbol", "date").agg(F.min("action_type").alias("corporate_action_type"))
    out = rows.join(a, ["symbol", "date"], "left")
    return out.withColumn("corporate_action_flag", F.when(F.col("corporate_action_type").isNotNull(), 1).otherwise(0))


# Event files name groups, the sector table sectors and industries.
EVENT_SECTORS = {
    "banks": ("Financials", "Banking"),
    "nbfc": ("Financials", "Consumer Finance"),
    "real_estate": ("Real Estate",),
    "auto": ("Consumer Discretionary", "Automobiles"),
    "infrastructure": ("Industrials", "Construction"),
    "defense": ("Industrials",),
}


def _event_sectors(listed: Column) -> Column:
    """An event's groups as sector or industry names; other names stay."""
    names = F.create_map(*[x for k, v in EVENT_SECTORS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.array_distinct(F.flatten(F.transform(
        F.split(listed, r"\s*,\s*"), lambda x: F.coalesce(F.try_element_at(names, x), F.array(x)))))


def macro_event_features(rows: DataFrame, events: DataFrame, cal_idx: DataFrame,
                         market: str = "india") -> DataFrame:
    """Trading days to the next macro event within 60 calendar days,
    blackout 0..2 and its type - only for rows of ``market`` whose sector is
    listed in the event's impacted sectors.  Events and the calendar are
    small (bounded by history length): the next event per trading day is
    resolved on the calendar, then broadcast to the rows."""
    ev = events.select("event_date", "event_type", _event_sectors(F.col("sectors_impacted")).alias("sectors"))
    cal = cal_idx.filter(F.col("market_context") == market)
    nxt = asof_forward(cal, ev.withColumn("market_context", F.lit(market)), "market_context", "date", "event_date",
                       ["event_date", "event_type", "sectors"])
    cmap = calendar_date_map(cal_idx).filter(F.col("market_context") == market).select("civil_date", "next_index")
    nxt = nxt.join(F.broadcast(cmap), (F.col("event_date") == F.col("civil_date")), "left").select(
        "market_context", "date", "day_index", "event_date", "event_type", "sectors",
        F.col("next_index").alias("ev_idx"))
    within = F.datediff("event_date", "date") <= MACRO_EVENT_HORIZON_DAYS
    nxt = nxt.select("market_context", "date", F.when(within, F.col("ev_idx") - F.col("day_index")).alias("__dtn"),
                     F.when(within, F.col("event_type")).alias("__type"), "sectors")
    j = rows.join(F.broadcast(nxt), ["market_context", "date"], "left")
    of = [F.array_contains("sectors", F.col(c)) for c in ("sector", "industry") if c in rows.columns]
    applies = F.coalesce(reduce(lambda a, b: a | b, of), F.lit(False))
    dtn = F.when(applies, F.col("__dtn")).cast("int")
    return j.select(*rows.columns, dtn.alias("days_to_next_macro_event"),
                    F.when(dtn.between(*MACRO_BLACKOUT), 1).otherwise(0).alias("macro_event_blackout_flag"),
                    F.when(applies & F.col("__dtn").isNotNull(), F.col("__type")).alias("macro_event_type"))


def ffill_fundamentals(rows: DataFrame, reports: DataFrame, value: str = "revenue") -> DataFrame:
    """The last reported value on or before each row's date with
    its report date, and the change against the prior report (QoQ)."""
    w = Window.partitionBy("symbol").orderBy("report_date")
    rep = reports.select("symbol", "report_date", F.col(value).alias(f"{value}_q"),
                         (F.col(value) - F.lag(value, 1).over(w)).alias(f"{value}_qoq_change"))
    return asof_backward(rows, rep, "symbol", "date", "report_date",
                         ["report_date", f"{value}_q", f"{value}_qoq_change"]).withColumnRenamed(
        "report_date", "fundamentals_asof_date")


def gap_fill(rows: DataFrame, cal_idx: DataFrame, carry: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Expand each symbol to every trading day of its market between
    its first and last row, forward fill price (at most 3 missing days) and
    volume (at most 2), and mark rows valid only within those limits; columns of
    ``carry`` are filled over any gap.

    What a trading day gets is known at the row before it, so windows pass over
    the rows alone; each is then repeated for the civil dates up to the next one,
    kept where the market trades.  A row on another day fills nothing."""
    w = Window.partitionBy("symbol").orderBy("date")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    r = rows.select("symbol", "market_context", "date", "close", "volume", *carry).join(F.broadcast(cal_idx), ["market_context", "date"], "left")

    def filled(c: str):
        return F.last(F.when(F.col("day_index").isNotNull(), F.col(c)), ignorenulls=True).over(run)

    r = r.select("symbol", "market_context", F.col("date").alias("__from"),
                 F.greatest(F.date_sub(F.lead("date", 1).over(w), 1), F.col("date")).alias("__to"),
                 *[filled(c).alias(f"__{c}") for c in ("day_index", "close", "volume", *carry)])
    g = r.select("*", F.explode(F.sequence("__from", "__to")).alias("date")).join(F.broadcast(cal_idx), ["market_context", "date"])
    g = g.withColumn("gap_days", (F.col("day_index") - F.col("__day_index")).cast("int"))
    return g.select("symbol", "date", "market_context", "day_index", "gap_days",
                    F.when(F.col("gap_days") <= PRICE_FILL_MAX_GAP, F.col("__close")).alias("close_filled"),
                    F.when(F.col("gap_days") <= VOLUME_FILL_MAX_GAP, F.col("__volume")).alias("volume_filled"),
                    (F.col("date") == F.col("__from")).alias("is_observed"), *[F.col(f"__{c}").alias(c) for c in carry])


def is_valid_row(df: DataFrame, numeric_cols: list[str]) -> DataFrame:
    """False on any NaN / infinite feature, an action date or a gap
    beyond the fill limit, or where ``features_valid`` (features that were
    judged before) is."""
    ok = F.lit(True)
    for c in numeric_cols:
        x = F.col(c).cast("double")
        ok = ok & ~(F.isnan(x) | (F.abs(x) == float("inf")))
    if "corporate_action_flag" in df.columns:
        ok = ok & (F.col("corporate_action_flag") == 0)
    if "gap_days" in df.columns:
        ok = ok & (F.col("gap_days") <= PRICE_FILL_MAX_GAP)
    if "features_valid" in df.columns:
        ok = ok & F.col("features_valid")
    return df.withColumn("is_valid_row", F.coalesce(ok, F.lit(False)))


def cap_tier_enrichment(rows: DataFrame, tiers: DataFrame) -> DataFrame:
    """Cap tier from the universe; unknown when absent (blocks promotion)."""
    t = tiers.select("symbol", "cap_tier")
    return rows.join(t, ["symbol"], "left").withColumn("cap_tier", F.coalesce("cap_tier", F.lit("unknown")))


def circuit_flags(rows: DataFrame, asof: bool = True) -> DataFrame:
    """Upper / lower circuit hits and their count over 5 rows.  With
    ``asof`` the weekly band carries forward to later days (T07)."""
    w = Window.partitionBy("symbol").orderBy("date")
    band = (F.last("circuit_band", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
            if asof else F.col("circuit_band"))
    r = rows.withColumn("band", band)
    up = F.col("close") >= F.col("open") * (1 + F.col("band") - CIRCUIT_TOLERANCE)
    lo = F.col("close") <= F.col("open") * (1 - F.col("band") + CIRCUIT_TOLERANCE)
    r = r.select("*", F.when(up, 1).otherwise(0).alias("upper_circuit_flag"),
                 F.when(lo, 1).otherwise(0).alias("lower_circuit_flag"))
    hits = F.sum(F.col("upper_circuit_flag") + F.col("lower_circuit_flag")).over(w.rowsBetween(-4, 0))
    return r.withColumn("circuit_hits_5d", hits)


def skip_existing_keys(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Drop incoming rows whose key is already stored."""
    return incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
