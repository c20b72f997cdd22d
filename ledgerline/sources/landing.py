"""Landing-format sources R01-R12: raw CSV / JSON / HTML to typed rows.

Each parser has two entry points:

* ``read_*`` reads files with ``spark.read`` and a fixed schema (no
  inference), for landed objects;
* ``parse_*`` parses a text column of an existing DataFrame with
  ``from_csv`` / ``from_json`` / regular expressions, so landed text that is
  already in a table is parsed in place, in parallel, without a driver loop.

All parsing is JVM-side; bad numbers become NULL through ``try_cast``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X

# ---- fixed values of the landing formats -----------------------------------
DELIVERY_COLUMNS = ("SYMBOL", "SERIES", "DELIV_PER")
CIRCUIT_COLUMNS = ("Symbol", "Band")
SECTOR_COLUMNS = ("symbol", "sector", "industry")
REPO_LABEL = "Policy Repo Rate"
LONG_BOND_LABELS = ("GS 203", "GS 204")
VIX_TICKER, NIFTY_TICKER = "^INDIAVIX", "^NSEI"
FUNDAMENTAL_FIELDS = (  # source key -> bronze column
    ("trailingPE", "pe_ratio"), ("forwardPE", "forward_pe"), ("priceToBook", "price_to_book"),
    ("marketCap", "market_cap"), ("institutionalHolders", "institutional_ownership_pct"),
    ("impliedSharesOutstanding", "implied_institutional_ownership_pct"),
    ("heldPercentInstitutions", "held_percent_institutions"), ("heldPercentInsiders", "held_percent_insiders"),
    ("shortRatio", "short_ratio"), ("shortPercentOfFloat", "short_percent_of_float"),
    ("totalRevenue", "total_revenue"), ("netIncomeToCommon", "net_income"), ("totalDebt", "total_debt"),
    ("operatingCashflow", "operating_cashflow"),
)
# ------------------------------------------------------------------------------

_CSV_OPTS = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


def _string_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def _csv(line: str | Column, cols) -> Column:
    ddl = ", ".join(f"`{c}` STRING" for c in cols)
    return F.from_csv(F.col(line) if isinstance(line, str) else line, ddl, _CSV_OPTS)


def _read_csv_strip_header(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """Read a headered CSV as text columns; header names are trimmed (one
    source has a leading space in ' SERIES')."""
    df = spark.read.options(header="true", **_CSV_OPTS).option("inferSchema", "false").csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*keep)


# ---- R01 delivery (bhav) CSV -------------------------------------------------

def delivery_from_fields(df: DataFrame) -> DataFrame:
    """F01-F04 on parsed SYMBOL / SERIES / DELIV_PER fields."""
    eq = X.filter_series_eq(df, "SERIES")
    return eq.select(*[c for c in df.columns if c not in DELIVERY_COLUMNS],
                     X.exchange_suffix("SYMBOL").alias("symbol"), X.to_numeric("DELIV_PER").alias("delivery_pct"))


def parse_delivery_lines(df: DataFrame, line: str = "line") -> DataFrame:
    p = df.withColumn("__r", _csv(line, DELIVERY_COLUMNS)).select(
        *[c for c in df.columns if c != line], *[F.col(f"__r.{c}").alias(c) for c in DELIVERY_COLUMNS])
    return delivery_from_fields(p)


def read_delivery_csv(spark: SparkSession, path: str) -> DataFrame:
    return delivery_from_fields(_read_csv_strip_header(spark, path, list(DELIVERY_COLUMNS)))


# ---- R02 circuit bands CSV ----------------------------------------------------

def circuit_from_fields(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in CIRCUIT_COLUMNS],
                     X.exchange_suffix("Symbol").alias("symbol"), X.circuit_band("Band").alias("circuit_band"))


def parse_circuit_lines(df: DataFrame, line: str = "line") -> DataFrame:
    p = df.withColumn("__r", _csv(line, CIRCUIT_COLUMNS)).select(
        *[c for c in df.columns if c != line], *[F.col(f"__r.{c}").alias(c) for c in CIRCUIT_COLUMNS])
    return circuit_from_fields(p)


def read_circuit_csv(spark: SparkSession, path: str, date_str: str | None = None) -> DataFrame:
    df = circuit_from_fields(_read_csv_strip_header(spark, path, list(CIRCUIT_COLUMNS)))
    return df.withColumn("date", F.lit(date_str).cast("date")) if date_str else df


# ---- R03 universe CSV ----------------------------------------------------------

def universe_from_fields(df: DataFrame) -> DataFrame:
    """F01 + F04: EQ series symbols with the NSE suffix, distinct."""
    return X.filter_series_eq(df, "SERIES").select(X.exchange_suffix("SYMBOL").alias("symbol")).distinct()


def parse_universe_lines(df: DataFrame, line: str = "line", header_first: bool = True) -> DataFrame:
    cols = ("SYMBOL", "NAME", "SERIES")
    p = df.withColumn("__r", _csv(line, cols)).select(*[F.col(f"__r.{c}").alias(c) for c in cols])
    if header_first:  # drop header lines (their SYMBOL field is the column name)
        p = p.filter(F.trim("SYMBOL") != F.lit("SYMBOL"))
    return universe_from_fields(p)


def read_universe_csv(spark: SparkSession, path: str) -> DataFrame:
    return universe_from_fields(_read_csv_strip_header(spark, path, ["SYMBOL", "SERIES"]))


US_SYMBOLS = ("AAPL", "MSFT")  # fixed value: the 'us' list


def universe_of(india: DataFrame, market: str | None = None) -> DataFrame:
    """The symbols of one market context, or of both (``india``: symbol)."""
    us = india.sparkSession.createDataFrame([(s,) for s in US_SYMBOLS], "symbol string")
    if market == "us":
        return us
    return india.select("symbol") if market == "india" else india.select("symbol").unionByName(us).distinct()


# ---- R04 sector dimension -----------------------------------------------------

def parse_sector_lines(df: DataFrame, line: str = "line") -> DataFrame:
    p = df.withColumn("__r", _csv(line, SECTOR_COLUMNS)).select(
        *[F.trim(F.col(f"__r.{c}")).alias(c) for c in SECTOR_COLUMNS])
    return p.filter(F.col("symbol") != F.lit("symbol"))


def read_sector_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv_strip_header(spark, path, list(SECTOR_COLUMNS))


# ---- R05 wide download to long rows ------------------------------------------

OHLCV_WIDE_FIELDS = ("Open", "High", "Low", "Close", "Volume")


def wide_to_long(df: DataFrame, date_col: str = "Date", sep: str = "|") -> DataFrame:
    """A wide frame with columns '<ticker><sep><Field>' to one row per
    (date, symbol) with lower-case field columns (unpivot, then a pivot on a
    fixed field list)."""
    vals = [c for c in df.columns if c != date_col]
    long = df.unpivot([date_col], vals, "__k", "__v")
    return _long_from_kv(long.select(F.col(date_col).alias("date"), "__k", F.col("__v").cast("double").alias("__v")),
                         sep)


def wide_map_to_long(df: DataFrame, date_col: str = "date", map_col: str = "wide", sep: str = "|") -> DataFrame:
    """The same for a wide batch held as a map column (one row per download
    batch and date): explode, split the key, pivot on the fixed field list."""
    long = df.select(F.col(date_col).alias("date"), F.explode(map_col).alias("__k", "__v"))
    return _long_from_kv(long, sep)


def _long_from_kv(long: DataFrame, sep: str) -> DataFrame:
    parts = F.split(F.col("__k"), re.escape(sep), 2)
    long = long.select("date", parts[0].alias("symbol"), F.lower(parts[1]).alias("field"), "__v")
    fields = [f.lower() for f in OHLCV_WIDE_FIELDS]
    # pivot() would first shuffle a row per field
    out = long.groupBy("date", "symbol").agg(*[F.max(F.when(F.col("field") == f, F.col("__v"))).alias(f) for f in fields])
    return X.drop_all_null_bars(out.withColumn("volume", F.col("volume").cast("long")))


# ---- R06 corporate actions JSON ----------------------------------------------

_CA_SCHEMA = "map<string, map<string, struct<dividend: double, split: double>>>"


def explode_corporate_actions(df: DataFrame, json_col: str = "json", market_context: str | Column = "india") -> DataFrame:
    """``{symbol: {date: {dividend?, split?}}}`` to (date, symbol,
    market_context, action_type, action_value); a date with both gives two
    rows, DIVIDEND first."""
    m = df.select(F.explode(F.from_json(F.col(json_col), _CA_SCHEMA)).alias("symbol", "__d"))
    m = m.select("symbol", F.explode("__d").alias("__date", "__a"))
    acts = F.array(F.struct(F.lit(1).alias("o"), F.lit("DIVIDEND").alias("action_type"),
                            F.col("__a.dividend").alias("action_value")),
                   F.struct(F.lit(2).alias("o"), F.lit("SPLIT").alias("action_type"),
                            F.col("__a.split").alias("action_value")))
    ctx = F.lit(market_context) if isinstance(market_context, str) else market_context
    out = m.select(F.col("__date").try_cast("date").alias("date"), "symbol", ctx.alias("market_context"),
                   F.explode(acts).alias("__x"))
    return out.filter(F.col("__x.action_value").isNotNull()).select(
        "date", "symbol", "market_context", "__x.action_type", "__x.action_value")


# ---- R07 earnings calendar JSON ----------------------------------------------

def explode_earnings_calendar(df: DataFrame, json_col: str = "json", market_context="india",
                              date_str: str | Column | None = None) -> DataFrame:
    """``{symbol: {next_earnings_date}}`` to rows, only where the key exists."""
    m = df.select(*[c for c in df.columns if c != json_col],
                  F.explode(F.from_json(F.col(json_col), "map<string, map<string, string>>")).alias("symbol", "__v"))
    out = m.filter(F.map_contains_key("__v", "next_earnings_date")).select(
        *[c for c in df.columns if c != json_col], "symbol",
        F.col("__v")["next_earnings_date"].try_cast("date").alias("next_earnings_date"))
    out = out.withColumn("market_context", F.lit(market_context) if isinstance(market_context, str) else market_context)
    if date_str is not None:
        out = out.withColumn("date", F.lit(date_str).cast("date") if isinstance(date_str, str) else date_str)
    return out


# ---- R08 sentiment JSON ----------------------------------------------------------

_SENT_SCHEMA = ("array<struct<requested_symbol: string, sentiment: struct<bullishPercent: double, "
                "bearishPercent: double>, buzz: struct<articlesInLastWeek: bigint>>>")


def flatten_sentiment_json(df: DataFrame, json_col: str = "json") -> DataFrame:
    """JSON array of nested objects to one row per symbol, then F12."""
    keep = [c for c in df.columns if c != json_col]
    e = df.select(*keep, F.explode(F.from_json(F.col(json_col), _SENT_SCHEMA)).alias("__s"))
    return e.select(*keep, F.col("__s.requested_symbol").alias("symbol"),
                    *X.sentiment_features("__s.sentiment.bullishPercent", "__s.sentiment.bearishPercent",
                                          "__s.buzz.articlesInLastWeek"))


def read_sentiment_json(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")
    return flatten_sentiment_json(raw)


# ---- R09 fundamentals JSON ---------------------------------------------------------

_FUND_SCHEMA = "struct<" + ", ".join(f"{k}: double" for k, _ in FUNDAMENTAL_FIELDS) + ">"


def flatten_fundamentals_json(df: DataFrame, json_col: str = "json", symbol_col: str = "symbol") -> DataFrame:
    """One flat JSON object per symbol to the renamed bronze columns + F13."""
    p = df.select(F.col(symbol_col).alias("symbol"), F.from_json(F.col(json_col), _FUND_SCHEMA).alias("__f"))
    # an absent share of institutions is 0, every other absent key NULL
    zero = {"institutional_ownership_pct"}
    cols = [(F.coalesce(f"__f.{k}", F.lit(0.0)) if v in zero else F.col(f"__f.{k}")).alias(v) for k, v in FUNDAMENTAL_FIELDS]
    out = p.select("symbol", *cols)
    return out.withColumn("fundamental_presence_flag", X.fundamental_presence_flag("pe_ratio", "total_revenue"))


# ---- R10 macro HTML -------------------------------------------------------------------

def _strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", ""), r"\s+", " "))


def html_table_rows(html: str | Column) -> Column:
    """Array of rows, each an array of cell texts, of every HTML table."""
    h = F.col(html) if isinstance(html, str) else html
    tables = F.regexp_extract_all(h, F.lit(r"(?is)<table[^>]*>(.*?)</table>"), 1)
    rows = F.flatten(F.transform(tables, lambda t: F.regexp_extract_all(t, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)))
    return F.transform(rows, lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: _strip_tags(c)))


def extract_macro_html(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Repo rate (last parsable 'Policy Repo Rate' row wins) and long bond
    yield (largest parsable 'GS 203x' / 'GS 204x' row) from rate tables."""
    keep = [c for c in df.columns if c != html_col]
    rows = F.filter(html_table_rows(html_col), lambda r: F.size(r) >= 2)

    def num(cell: Column, strip: str) -> Column:
        return F.trim(F.regexp_replace(cell, strip, "")).try_cast("double")

    repo = F.filter(F.transform(F.filter(rows, lambda r: F.contains(r[0], F.lit(REPO_LABEL))),
                                lambda r: num(r[1], "[:%]")), lambda v: v.isNotNull())
    bond = F.filter(F.transform(F.filter(rows, lambda r: F.contains(r[0], F.lit(LONG_BOND_LABELS[0]))
                                         | F.contains(r[0], F.lit(LONG_BOND_LABELS[1]))),
                                lambda r: num(r[1], "[:%#]")), lambda v: v.isNotNull())
    return df.select(*keep, F.when(F.size(repo) > 0, F.element_at(repo, -1)).alias("rbi_repo_rate"),
                     F.array_max(bond).alias("india_10y_yield"))


# ---- R11 macro prices JSON -----------------------------------------------------------

def scan_macro_prices_json(df: DataFrame, json_col: str = "json") -> DataFrame:
    """``{ticker: {close, date}}`` to vix / nifty closes; a missing ticker is NULL."""
    m = F.from_json(F.col(json_col), "map<string, struct<close: double, date: string>>")
    keep = [c for c in df.columns if c != json_col]
    return df.select(*keep, m[VIX_TICKER]["close"].alias("india_vix_close"),
                     m[NIFTY_TICKER]["close"].alias("nifty50_close"))


# ---- R12 event reference (small config) ---------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()), T.StructField("event_type", T.StringType()),
    T.StructField("sectors_impacted", T.ArrayType(T.StringType())), T.StructField("notes", T.StringType()),
    T.StructField("source", T.StringType()),
])


def load_event_reference(spark: SparkSession, events: list[dict], run_id: str | None = None,
                         market_context: str = "india") -> DataFrame:
    """A small reference list (already read from its config file) to a typed
    table; the comma list of sectors becomes an array."""
    import datetime as _dt

    rows = []
    for e in events:
        d = e.get("event_date")
        if isinstance(d, str):
            d = _dt.date.fromisoformat(d)
        sec = e.get("sectors_impacted")
        if isinstance(sec, str):
            sec = [s.strip() for s in sec.split(",") if s.strip()]
        rows.append((d, e.get("event_type"), sec, e.get("notes"), e.get("source")))
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    return X.stamp_metadata(df, run=run_id, context_from=None).withColumn("market_context", F.lit(market_context))


def read_yaml_events(path: str) -> list[dict]:
    """Read the event list file on the driver (a few dozen lines)."""
    import yaml  # type: ignore

    with open(path) as fh:
        data = yaml.safe_load(fh)
    return data.get("events", data) if isinstance(data, dict) else data
