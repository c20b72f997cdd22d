"""Promotion gates G01-G13 (2.14): data-quality checks between layers.

Every check is an aggregate (per symbol, per date or per build) so it is a
partial aggregation over the layer, never a collection of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import discard, written

# ---- fixed thresholds --------------------------------------------------------------
FRESHNESS_MAX_LAG = 2
SYMBOL_NULL_RATE_MAX = 0.02
FEATURE_COMPLETENESS_MIN = 0.95
LABEL_NULL_RATE_MAX = 0.05
MIN_TRADING_DAYS = 60
ZSCORE_LIMIT = 4.0
FEATURE_NAN_RATE_MAX = 0.05
STALE_DAYS = {"train": 7, "serve": 30, "selection": 10, "fundamentals": 95, "macro": 35, "regime": 5}
COVERAGE_MIN = {"ohlcv": 0.95, "delivery": 0.90, "earnings": 0.80}
ROW_COUNT_TOLERANCE = 0.0
# -------------------------------------------------------------------------------------


def freshness(rows: DataFrame, cal_idx: DataFrame) -> DataFrame:
    """Trading days between a symbol's latest row and its market's latest trading day."""
    last = rows.groupBy("symbol", "market_context").agg(F.max("date").alias("last_date"))
    last = last.join(F.broadcast(cal_idx), (last.market_context == cal_idx.market_context)
                     & (last.last_date == cal_idx.date), "left").select(last.symbol, last.market_context,
                                                                         "last_date", "day_index")
    mx = cal_idx.groupBy("market_context").agg(F.max("day_index").alias("max_index"))
    out = last.join(F.broadcast(mx), ["market_context"], "left")
    lag = (F.col("max_index") - F.col("day_index")).cast("int")
    return out.select("symbol", "last_date", lag.alias("lag_trading_days"),
                      F.coalesce(lag <= FRESHNESS_MAX_LAG, F.lit(False)).alias("is_fresh"))


def symbol_null_rate(raw: DataFrame, fields=("symbol", "date", "open", "high", "low", "close", "volume")) -> DataFrame:
    """Share of rows with a NULL or NaN mandatory field, per symbol."""
    from .gate import present_value

    anynull = reduce(lambda a, b: a | b, [present_value(raw, c).isNull() for c in fields if c != "symbol"])
    g = raw.groupBy("symbol").agg(F.avg(anynull.cast("double")).alias("null_rate"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("passes", F.col("null_rate") <= SYMBOL_NULL_RATE_MAX)


def silver_readiness(rows: DataFrame, price: str = "close", contract=None) -> DataFrame:
    """Price present on every row and cap tier known, per symbol.  With
    ``contract`` (a schema) a frame that departs from it raises before any row
    is read."""
    if contract is not None:
        from .gate import schema_check

        issues = schema_check(rows, contract)
        if issues:
            raise ValueError(f"schema departs from the contract: {issues}")
    g = rows.groupBy("symbol").agg(F.count_if(F.col(price).isNull()).alias("missing_price_rows"),
                                    F.max(F.col("cap_tier") == "unknown").alias("__unknown"))
    return g.select("symbol", "missing_price_rows", (~F.col("__unknown")).alias("cap_tier_known"),
                    ((F.col("missing_price_rows") == 0) & ~F.col("__unknown")).alias("passes"))


def feature_completeness(features: DataFrame, cols: list[str]) -> DataFrame:
    """Share of non-NULL feature values per symbol (>= 95 %)."""
    nn = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    g = features.groupBy("symbol").agg((F.sum(nn) / (F.count(F.lit(1)) * len(cols))).alias("completeness"))
    return g.withColumn("passes", F.col("completeness") >= FEATURE_COMPLETENESS_MIN)


def label_null_rate(labels: DataFrame, label: str = "label_return_1d") -> DataFrame:
    """Share of NULL labels per symbol (<= 5 %)."""
    g = labels.groupBy("symbol").agg(F.avg(F.col(label).isNull().cast("double")).alias("label_null_rate"))
    return g.withColumn("passes", F.col("label_null_rate") <= LABEL_NULL_RATE_MAX)


def history_length(rows: DataFrame) -> DataFrame:
    """At least 60 trading days per symbol."""
    g = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("trading_days"))
    return g.withColumn("passes", F.col("trading_days") >= MIN_TRADING_DAYS)


def with_history(rows: DataFrame, least: int = MIN_TRADING_DAYS) -> DataFrame:
    """The rows of symbols with at least ``least`` trading days; the
    others stop here."""
    enough = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).select("symbol")
    return rows.join(enough, "symbol", "left_semi")


def zscore_check(rows: DataFrame, col: str, limit: float = ZSCORE_LIMIT) -> DataFrame:
    """Cross-sectional z-score per date; flag |z| > limit.  Date
    moments are a partial aggregate joined back (one row per date)."""
    m = rows.groupBy("date").agg(F.avg(col).alias("__mu"), F.stddev_samp(col).alias("__sd"))
    j = rows.join(m, ["date"], "left")
    z = F.try_divide(F.col(col) - F.col("__mu"), F.col("__sd"))
    j = j.withColumn("zscore", z)
    return j.withColumn("zscore_flag", F.coalesce(F.abs("zscore") > limit, F.lit(False))).drop("__mu", "__sd")


def feature_nan_rates(features: DataFrame, cols: list[str]) -> DataFrame:
    """NULL / NaN share per (symbol, feature) (<= 5 %): one row of
    counters a symbol, turned into a row a feature afterwards."""
    bad = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    g = features.groupBy("symbol").agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(bad(c)).alias(f"__bad_{c}") for c in cols])
    long = g.select("symbol", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(f"__bad_{c}") / F.col("__n")).alias("nan_rate")) for c in cols])).alias("__f"))
    return long.select("symbol", "__f.*").withColumn("passes", F.col("nan_rate") <= FEATURE_NAN_RATE_MAX)


def lookahead_check(rows: DataFrame, build: Callable[[DataFrame], DataFrame], cuts: list, features: list[str]) -> DataFrame:
    """Per (cutoff_date, feature) the rows up to the cut whose value differs
    between features built on all rows and on the rows up to the cut: a
    feature that looks ahead does, at the cut.

    All cuts are built in one pass, as copies of the symbols, whose rows carry a
    hash of the features that all rows gave them; only rows whose own hash departs from it are
    kept and compared value by value, within their quarters.  A row that only one
    build returns differs in every feature.  ``build`` works per symbol, on the
    columns symbol and date, and keeps columns that it does not know."""
    spark = rows.sparkSession
    quarter = F.trunc("date", "quarter").alias("__quarter")
    row_hash = F.xxhash64(*[F.col(f) for f in features])
    upto = lambda c: F.col("date") <= F.lit(c).cast("date")
    rows = written(rows, "lookahead-rows")
    full = written(build(rows).select("symbol", "date", *features), "lookahead-full")
    hashed = written(rows.join(full.select("symbol", "date", row_hash.alias("__full")), ["symbol", "date"], "left"), "lookahead-hashed")
    discard(rows)
    dates = F.array(*[F.lit(c).cast("date") for c in cuts])
    copies = hashed.withColumn("__cut", F.explode(dates)).filter(F.col("date") <= F.col("__cut"))
    copies = copies.withColumn("symbol", F.concat_ws("|", F.col("__cut").cast("string"), "symbol"))
    built = build(copies)
    if not {"__cut", "__full"} <= set(built.columns):
        raise ValueError("the build drops a column that it does not know")
    seen = Observation()
    built = built.observe(seen, *[F.count_if((F.col("__cut") == F.lit(c).cast("date")) & F.col("__full").isNotNull()).alias(f"n{i}") for i, c in enumerate(cuts)])
    odd = written(built.filter(~F.col("__full").eqNullSafe(row_hash)).select(
        "__cut", F.expr("substring(symbol, 12)").alias("symbol"), "date", quarter,
        *[F.col(f).alias(f"__cut_{f}") for f in features]), "lookahead-odd")
    discard(hashed)
    there = full.agg(*[F.count_if(upto(c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
    j = odd.join(full.select("*", quarter, F.lit(True).alias("__here")), ["symbol", "__quarter", "date"], "left")
    same = lambda f: F.col("__here").isNotNull() & F.col(f).eqNullSafe(F.col(f"__cut_{f}"))
    counted = j.groupBy("__cut").agg(*[F.count_if(~same(f)).alias(f"__d_{f}") for f in features])
    lost = [(str(c), there[i] - seen.get[f"n{i}"]) for i, c in enumerate(cuts)]  # rows that no cut build returned
    grid = spark.createDataFrame(lost, "c string, __lost long").select(F.col("c").cast("date").alias("__cut"), "__lost")
    found = grid.join(counted, "__cut", "left")
    return found.select(F.col("__cut").alias("cutoff_date"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.coalesce(F.col(f"__d_{f}"), F.lit(0).cast("long")) + F.col("__lost")).alias("mismatched_rows"))
        for f in features])).alias("__f")).select("cutoff_date", "__f.*")


def lookahead_mismatches(full: DataFrame, cut: DataFrame, cutoff: str) -> DataFrame:
    """G09 for one cut and two given builds: rows on or before the cutoff that
    differ, as multisets (``lookahead_check`` builds and compares several cuts)."""
    a = full.filter(F.col("date") <= F.lit(cutoff).cast("date"))
    cols = a.columns
    # the multiset difference in both directions, counted in one aggregate:
    # per distinct row |copies in full - copies in cut| (two exceptAll would
    # each evaluate both feature builds)
    tagged = a.select(*cols, F.lit(1).alias("__t")).unionByName(cut.select(*cols, F.lit(-1).alias("__t")))
    per_row = tagged.groupBy(*cols).agg(F.sum("__t").alias("__d"))
    n = F.coalesce(F.sum(F.abs("__d")), F.lit(0)).cast("long")
    return per_row.agg(n.alias("mismatched_rows")).select(
        F.lit(cutoff).cast("date").alias("cutoff_date"), "mismatched_rows")


def staleness(rows: DataFrame, asof_cols: dict[str, str]) -> DataFrame:
    """Age in days of each as-of input and its stale flag."""
    out = rows
    for name, c in asof_cols.items():
        age = F.datediff("date", c)
        out = out.withColumn(f"{name}_age_days", age).withColumn(
            f"{name}_stale", F.coalesce(age > STALE_DAYS[name], F.lit(True)))
    return out


def build_contract(labels: DataFrame) -> DataFrame:
    """One row per build: a single label version and feature version on
    all rows, no NULL cap tier / horizon."""
    g = labels.agg(F.count_distinct("label_version").alias("label_versions"),
                   F.count_distinct("feature_version").alias("feature_versions"),
                   F.count_if(F.col("feature_version").isNull()).alias("null_feature_version"),
                   F.count_if(F.col("cap_tier").isNull()).alias("null_cap_tier"),
                   F.count_if(F.col("horizon").isNull()).alias("null_horizon"))
    return g.withColumn("passes", (F.col("label_versions") == 1) & (F.col("feature_versions") == 1)
                        & (F.col("null_feature_version") == 0) & (F.col("null_cap_tier") == 0) & (F.col("null_horizon") == 0))


def daily_coverage(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Per (market, date) share of the market's universe with a bar,
    share of india rows with delivery data and share of rows with a known
    next result date."""
    from ..functions.exprs import market_context

    u = universe.select("symbol").distinct().withColumn("market_context", market_context("symbol"))
    usize = u.groupBy("market_context").agg(F.count(F.lit(1)).alias("universe_size"))
    d = rows.groupBy("market_context", "date").agg(
        F.count_distinct("symbol").alias("symbols"),
        F.avg(F.col("has_delivery").cast("double")).alias("delivery_coverage"),
        F.avg(F.col("days_to_next_earnings").isNotNull().cast("double")).alias("earnings_coverage"))
    j = d.join(F.broadcast(usize), ["market_context"], "left")  # one row per market
    cov = F.col("symbols") / F.col("universe_size")
    j = j.withColumn("ohlcv_coverage", cov)
    ok = (F.col("ohlcv_coverage") >= COVERAGE_MIN["ohlcv"]) & (F.col("earnings_coverage") >= COVERAGE_MIN["earnings"])
    ok = ok & F.when(F.col("market_context") == "india", F.col("delivery_coverage") >= COVERAGE_MIN["delivery"]
                     ).otherwise(F.lit(True))
    return j.withColumn("passes", F.coalesce(ok, F.lit(False)))


def layer_reconciliation(upstream: DataFrame, downstream: DataFrame, key: str = "date",
                         null_col: str = "close") -> DataFrame:
    """Row counts per key in two layers (full outer join of two
    aggregates) and NULLs of a key field downstream."""
    a = upstream.groupBy(key).agg(F.count(F.lit(1)).alias("upstream_rows"))
    b = downstream.groupBy(key).agg(F.count(F.lit(1)).alias("downstream_rows"),
                                    F.count_if(F.col(null_col).isNull()).alias("downstream_nulls"))
    j = a.join(b, [key], "full_outer").fillna(0, ["upstream_rows", "downstream_rows", "downstream_nulls"])
    diff = F.abs(F.col("upstream_rows") - F.col("downstream_rows")) / F.greatest(F.col("upstream_rows"), F.lit(1))
    return j.withColumn("row_diff_ratio", diff).withColumn("reconciled", diff <= ROW_COUNT_TOLERANCE)


def newest_dates(days: DataFrame, dated: dict[str, DataFrame], by: str = "market_context") -> DataFrame:
    """(by, date) rows of ``days``, one each, with per name the newest date of
    ``dated[name]`` (columns by, date) on or before it, all carried in one pass."""
    found = days.groupBy(by, "date").agg(F.lit(True).alias("__day"))
    for name, d in dated.items():
        found = found.join(d.groupBy(by, "date").agg(F.max("date").alias(name)), [by, "date"], "full_outer")
    w = Window.partitionBy(by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return found.select(by, "date", "__day", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in dated]).filter("__day").drop("__day")
