"""Column expressions F01-F27: projections, filters and scalar rules.

All are native Spark expressions (codegen friendly).  Parsing of raw text
uses ``try_cast`` so bad input becomes NULL instead of an ANSI error.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import col, sdiv

# ---- fixed values that must equal the source system's ----------------------
EQUITY_SERIES = "EQ"
NSE_SUFFIX = ".NS"
INDIA_SUFFIXES = (".NS", ".BO")
OHLCV_FIELDS = ("open", "high", "low", "close", "volume")
NEW_LISTING_DAYS = 30
SENTIMENT_DIRECTION_CUT = 0.1
LOW_COVERAGE_BELOW = 2
# Fixed market holidays (month-day) of the trading calendar rule: Republic
# Day, Independence Day, Gandhi Jayanti.
MARKET_HOLIDAYS_MMDD = ("01-26", "08-15", "10-02")
# ------------------------------------------------------------------------------


def filter_series_eq(df: DataFrame, series_col: str = "SERIES") -> DataFrame:
    """keep equity series rows (value compared after trimming)."""
    return df.filter(F.trim(col(series_col)) == F.lit(EQUITY_SERIES))


def project_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """select and rename; a missing source column raises."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def to_numeric(c: str | Column) -> Column:
    """text to double, bad text to NULL."""
    return F.trim(col(c).cast("string")).try_cast("double")


def exchange_suffix(c: str | Column, suffix: str = NSE_SUFFIX) -> Column:
    """append the exchange suffix."""
    return F.concat(F.trim(col(c)), F.lit(suffix))


def circuit_band(c: str | Column) -> Column:
    """all-digit band text to a fraction (5 -> 0.05); else NULL."""
    t = F.trim(col(c).cast("string"))
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("double") / F.lit(100.0))


def market_context(c: str | Column) -> Column:
    """'.NS' / '.BO' symbols are india, all others us."""
    s = col(c)
    return F.when(s.endswith(INDIA_SUFFIXES[0]) | s.endswith(INDIA_SUFFIXES[1]), F.lit("india")) \
        .otherwise(F.lit("us"))


def drop_all_null_bars(df: DataFrame, fields=OHLCV_FIELDS, required: bool = False) -> DataFrame:
    """drop rows whose OHLCV fields are all NULL; with ``required`` an
    error if none is left."""
    present = [f for f in fields if f in df.columns]
    left = df.dropna(how="all", subset=present)
    if required and left.isEmpty():
        raise ValueError(f"no bar has a value in {', '.join(present)}")
    return left


def run_id(job: str, at: datetime | None = None) -> str:
    """``{job}_{yyyyMMdd_HHmmss}`` (UTC)."""
    at = at or datetime.now(timezone.utc)
    return f"{job}_{at.strftime('%Y%m%d_%H%M%S')}"


def stamp_metadata(df: DataFrame, run: str | None = None, source: str | None = None,
                   at: str | Column | None = None, context_from: str | None = "symbol") -> DataFrame:
    """run id, ingestion timestamp, source and market context columns."""
    out = df
    if run is not None:
        out = out.withColumn("ingestion_run_id", F.lit(run))
    ts = F.current_timestamp() if at is None else (F.lit(at).cast("timestamp") if isinstance(at, str) else at)
    out = out.withColumn("ingestion_timestamp", ts)
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if context_from is not None and "market_context" not in out.columns:
        out = out.withColumn("market_context", market_context(context_from))
    return out


def recent_positive_actions(df: DataFrame, asof: str | Column, days: int = 7,
                            date_col: str = "date", value_col: str = "action_value") -> DataFrame:
    """actions dated within ``days`` before ``asof`` with a positive value."""
    a = F.lit(asof).cast("date") if isinstance(asof, str) else asof
    return df.filter((col(date_col) >= F.date_sub(a, days)) & (col(value_col) > 0))


def next_upcoming_date(dates: str | Column, asof: str | Column) -> Column:
    """smallest date in the array that is on or after ``asof`` (NULL if none)."""
    a = F.lit(asof).cast("date") if isinstance(asof, str) else asof
    return F.array_min(F.filter(col(dates), lambda d: d >= a))


def latest_value(value: str | Column, order: str | Column) -> Column:
    """the value on the latest row (aggregate)."""
    return F.max_by(col(value), col(order))


def latest_closes(df: DataFrame, symbols: list[str], value: str = "close", order: str = "date") -> dict[str, float]:
    """the latest value of each of a few named symbols; an error names
    those without one."""
    rows = df.where(F.col("symbol").isin(symbols) & col(value).isNotNull()).groupBy("symbol").agg(
        latest_value(value, order).alias("v")).collect()
    found = {r["symbol"]: r["v"] for r in rows}
    missing = sorted(set(symbols) - set(found))
    if missing:
        raise KeyError(f"no {value} of {', '.join(missing)}")
    return found


def sentiment_features(bullish: str | Column, bearish: str | Column, articles: str | Column) -> list[Column]:
    """score, direction, intensity and coverage; NULL inputs act as 0."""
    bull = F.coalesce(col(bullish).cast("double"), F.lit(0.0))
    bear = F.coalesce(col(bearish).cast("double"), F.lit(0.0))
    n = F.coalesce(col(articles).cast("long"), F.lit(0))
    score = bull - bear
    direction = F.when(score > SENTIMENT_DIRECTION_CUT, 1).when(score < -SENTIMENT_DIRECTION_CUT, -1).otherwise(0)
    coverage = F.when(n < LOW_COVERAGE_BELOW, F.lit("low")).otherwise(F.lit("normal"))
    return [score.alias("sentiment_score"), direction.cast("int").alias("sentiment_direction"),
            n.alias("news_intensity"), coverage.alias("news_coverage_flag")]


def fundamental_presence_flag(pe: str | Column, revenue: str | Column) -> Column:
    """1 when trailing P/E or revenue is known."""
    return (col(pe).isNotNull() | col(revenue).isNotNull()).cast("int")


def gold_inr(gold_usd: str | Column, usd_inr: str | Column) -> Column:
    """F15."""
    return col(gold_usd) * col(usd_inr)


# F16: defaults applied after the silver left joins.
SILVER_DEFAULTS = {
    "sentiment_score": 0.0,
    "sentiment_direction": 0,
    "news_intensity": 0,
    "news_coverage_flag": "low",
    "delivery_pct": 0.0,
    "sector": "Others",
    "industry": "Others",
}


def bhav_date_format(d: str | Column) -> Column:
    """yyyy-MM-dd to ddMMyyyy."""
    return F.date_format(col(d).cast("date"), "ddMMyyyy")


def symbol_in_list(c: str | Column, symbols) -> Column:
    """F18 (pushed down to the Parquet scan as an IN filter)."""
    return col(c).isin(list(symbols))


def point_lookup(df: DataFrame, symbol: str, columns: list[str], n: int = 5,
                 order: str = "date") -> DataFrame:
    """newest ``n`` rows for one symbol (TakeOrderedAndProject)."""
    return df.filter(F.col("symbol") == symbol).select(*columns).orderBy(F.col(order).desc()).limit(n)


def normalize_column_names(df: DataFrame) -> DataFrame:
    """lower case; anything outside [a-zA-Z0-9_] becomes '_'."""
    return df.toDF(*[re.sub(r"[^a-zA-Z0-9_]", "_", c).lower() for c in df.columns])


def coerce_ohlcv_types(df: DataFrame) -> DataFrame:
    """numeric OHLC doubles, long volume, DATE dates (parse failures -> NULL)."""
    out = []
    for f in df.schema.fields:
        if f.name in ("open", "high", "low", "close", "adj_close"):
            out.append(F.col(f.name).try_cast("double").alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name).cast("double").alias(f.name))
        elif f.name == "volume":
            out.append(F.col(f.name).try_cast("double").cast("long").alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name).cast("long").alias(f.name))
        elif f.name == "date":
            out.append(F.col(f.name).try_cast("date").alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name).cast("date").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def days_since_listed(d: str | Column, first: str | Column) -> Column:
    """F22."""
    return F.datediff(col(d), col(first))


def is_new_listing(days: str | Column, limit: int = NEW_LISTING_DAYS) -> Column:
    """unknown listing date gives 0."""
    return F.coalesce((col(days) <= limit).cast("int"), F.lit(0))


def proximity_to_52w_high(close: str | Column, high_52w: str | Column) -> Column:
    """F24."""
    return sdiv(close, high_52w)


def fill_zero(df: DataFrame, exclude=()) -> DataFrame:
    """every numeric NULL becomes 0 (text NULLs are kept, see T06)."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "decimal")
           and f.name not in exclude]
    return df.fillna(0, subset=num) if num else df


def is_trading_day(df: DataFrame, calendar: DataFrame, date_col: str = "date",
                   cal_date: str = "date") -> DataFrame:
    """keep rows whose date is a trading day of the calendar table.

    The calendar is one row per day per market, bounded by the days in
    history, so it is broadcast.
    """
    cal = calendar.select(F.col(cal_date).alias("__cal_d")).distinct()
    return df.join(F.broadcast(cal), F.col(date_col) == F.col("__cal_d"), "left_semi")


def trading_day_flag(d: str | Column, holidays: list[str] | None = None,
                     holidays_mmdd=MARKET_HOLIDAYS_MMDD) -> Column:
    """F26 scalar form: a weekday, not a fixed yearly holiday (month-day),
    not in an explicit holiday date list."""
    c = col(d).cast("date")
    wk = ~F.dayofweek(c).isin(1, 7)
    if holidays_mmdd:
        wk = wk & ~F.date_format(c, "MM-dd").isin(list(holidays_mmdd))
    if holidays:
        wk = wk & ~c.isin([F.lit(h).cast("date") for h in holidays])
    return wk


def next_upcoming_per_key(df: DataFrame, date_col: str, asof: str | Column, keys: list[str]) -> DataFrame:
    """F10 as an aggregate: the smallest date on or after ``asof`` per key
    (partial aggregate; keys without one give no row)."""
    a = F.lit(asof).cast("date") if isinstance(asof, str) else asof
    return df.filter(col(date_col) >= a).groupBy(*keys).agg(F.min(date_col).alias(date_col))


def require_columns_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """fail the job at run time when a required column is NULL."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    # a filter (not a dropped column) so the optimizer cannot prune the check away
    return df.filter(F.assert_true(cond, F.lit(f"required columns missing: {columns}")).isNull())
