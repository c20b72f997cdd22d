"""Stand-in market tables derived from the driver's TPC-H-like tables.

The driver data has no price table, so every market source is derived with
Spark from ``lineitem``, ``orders``, ``supplier``, ``nation`` and ``region``
(see SURVEY 7.2).  Each view has a Spark builder and the identical SQL CTE
text used by the DuckDB oracle, so both sides read the same whole tables.

Symbols are suppliers: ``'S' || suppkey`` plus an exchange suffix chosen by
``suppkey % 3`` ('.NS', '.BO' or none), which spreads them over the two
market contexts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..util import exact_avg, exact_avg_sql, exact_sum, exact_sum_sql, round_half_away

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def symbol_of(suppkey: str | Column) -> Column:
    k = F.col(suppkey) if isinstance(suppkey, str) else suppkey
    suffix = F.when(k % 3 == 0, F.lit(".NS")).when(k % 3 == 1, F.lit(".BO")).otherwise(F.lit(""))
    return F.concat(F.lit("S"), k.cast("string"), suffix)


def symbol_sql(k: str) -> str:
    return (f"('S' || CAST({k} AS VARCHAR) || CASE {k} % 3 WHEN 0 THEN '.NS' WHEN 1 THEN '.BO' "
            f"ELSE '' END)")


# --------------------------------------------------------------------------
# bars: one OHLCV row per (supplier, ship date)
# --------------------------------------------------------------------------

def _line_prices(li: DataFrame) -> DataFrame:
    px = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(
        symbol_of("l_suppkey").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("date"),
        px.alias("px"),
        (px * (1 + F.col("l_tax"))).alias("hi"),
        (px * (1 - F.col("l_discount"))).alias("lo"),
        F.col("l_quantity").alias("qty"),
        # (l_orderkey, l_linenumber) is the line item key and line numbers run
        # 1..7, so one long orders lines like the pair; a fixed-width ordering
        # key keeps min_by / max_by in a hash aggregate (a struct key would
        # force a sort aggregate)
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("is_n"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_o"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_r"),
    )


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every per-(supplier, ship date) statistic the stand-ins need, in one
    partial aggregate over ``lineitem``, so a hot supplier is combined map
    side.  Bars, delivery and sentiment are projections of it; with real
    bronze tables each is a plain scan."""
    li = table(spark, sf_dir, "lineitem")
    return (_line_prices(li).groupBy("symbol", "date")
            .agg(F.min_by("px", "k").alias("open"), F.max("hi").alias("high"), F.min("lo").alias("low"),
                 F.max_by("px", "k").alias("close"), F.sum("qty").cast("long").alias("volume"),
                 F.avg("is_n").alias("share_n"), F.avg("is_o").alias("share_o"), F.avg("is_r").alias("share_r"),
                 F.count(F.lit(1)).alias("n_lines")))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars; the aggregation is partial (map side) so a hot supplier
    is combined before the shuffle, and a symbol never has more rows than
    there are calendar days."""
    return supplier_days(spark, sf_dir).select("symbol", "date", "open", "high", "low", "close", "volume")


BARS_SQL = f"""
SELECT symbol, d AS date, arg_min(px, k) AS open, max(hi) AS high, min(lo) AS low,
       arg_max(px, k) AS close, CAST(sum(qty) AS BIGINT) AS volume
FROM (SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS d,
             l_extendedprice / l_quantity AS px,
             l_extendedprice / l_quantity * (1 + l_tax) AS hi,
             l_extendedprice / l_quantity * (1 - l_discount) AS lo,
             l_quantity AS qty,
             l_orderkey * 8 + l_linenumber AS k
      FROM lineitem) t
GROUP BY symbol, d"""


# --------------------------------------------------------------------------
# raw ticks: one landing record per line item, for the quality gate
# --------------------------------------------------------------------------

def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw OHLCV records with realistic defects: some missing volumes,
    inverted high/low, negative close; several records per (symbol, date)
    so the gate's de-duplication has work to do.  ``date`` is text."""
    li = table(spark, sf_dir, "lineitem")
    px = F.col("l_extendedprice") / F.col("l_quantity")
    lo = px * (1 - F.col("l_discount"))
    return li.select(
        symbol_of("l_suppkey").alias("symbol"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        px.alias("open"),
        # a NaN is a missing value, too
        F.when(F.col("l_partkey") % 97 == 5, F.lit(float("nan"))).when(F.col("l_quantity") == 50, lo * 0.99).otherwise(px * (1 + F.col("l_tax"))).alias("high"),
        lo.alias("low"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), -px)
        .otherwise(px * (1 - F.col("l_discount") / 2)).alias("close"),
        F.when((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08), F.lit(None).cast("long"))
        .otherwise(F.col("l_quantity").cast("long")).alias("volume"),
        F.col("l_orderkey").alias("seq_order"), F.col("l_linenumber").alias("seq_line"),
        F.col("l_partkey").alias("seq_part"),
    )


RAW_TICKS_SQL = f"""
SELECT {symbol_sql('l_suppkey')} AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS date,
       l_extendedprice / l_quantity AS open,
       CASE WHEN l_partkey % 97 = 5 THEN CAST('NaN' AS DOUBLE)
            WHEN l_quantity = 50 THEN l_extendedprice / l_quantity * (1 - l_discount) * 0.99
            ELSE l_extendedprice / l_quantity * (1 + l_tax) END AS high,
       l_extendedprice / l_quantity * (1 - l_discount) AS low,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -(l_extendedprice / l_quantity)
            ELSE l_extendedprice / l_quantity * (1 - l_discount / 2) END AS close,
       CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS volume,
       l_orderkey AS seq_order, l_linenumber AS seq_line, l_partkey AS seq_part
FROM lineitem"""


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved symbols: suppliers in good standing (positive balance)."""
    s = table(spark, sf_dir, "supplier")
    return s.filter(F.col("s_acctbal") > 0).select(symbol_of("s_suppkey").alias("symbol"))


UNIVERSE_SQL = f"SELECT {symbol_sql('s_suppkey')} AS symbol FROM supplier WHERE s_acctbal > 0"


# --------------------------------------------------------------------------
# other sources, keyed like the reference's bronze tables
# --------------------------------------------------------------------------

def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """delivery_pct per (symbol, date): share of 'N' lines x 100, 1 decimal."""
    d = supplier_days(spark, sf_dir)
    return d.select("symbol", "date", round_half_away(F.col("share_n") * 100.0, 1).alias("delivery_pct"))


DELIVERY_SQL = f"""
SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS date,
       ROUND(avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) * 100.0 * 10.0) / 10.0 AS delivery_pct
FROM lineitem GROUP BY 1, 2"""

# Band text per supplier nation (fixed list; the last two are not numbers).
BAND_TEXT = ("2", "5", "10", "20", "No Band", "-")


def band_text(nationkey: str) -> Column:
    k = F.col(nationkey) % len(BAND_TEXT)
    expr = F.lit(BAND_TEXT[-1])
    for i in reversed(range(len(BAND_TEXT) - 1)):
        expr = F.when(k == i, F.lit(BAND_TEXT[i])).otherwise(expr)
    return expr


def band_text_sql(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(BAND_TEXT[:-1]))
    return f"(CASE {k} % {len(BAND_TEXT)} {whens} ELSE '{BAND_TEXT[-1]}' END)"


def circuit(spark: SparkSession, sf_dir: str, bars_df: DataFrame | None = None) -> DataFrame:
    """Weekly circuit-band files: one row per symbol on each Monday it traded."""
    b = bars_df if bars_df is not None else bars(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier").select(
        symbol_of("s_suppkey").alias("symbol"), band_text("s_nationkey").alias("band"))
    mondays = b.filter(F.dayofweek("date") == 2).select("symbol", "date")
    return mondays.join(sup, "symbol").select("symbol", "date", X.circuit_band("band").alias("circuit_band"))


CIRCUIT_SQL = f"""
SELECT b.symbol, b.date,
       CASE WHEN regexp_full_match(trim(s.band), '[0-9]+') THEN CAST(trim(s.band) AS DOUBLE) / 100.0 END AS circuit_band
FROM bars b JOIN (SELECT {symbol_sql('s_suppkey')} AS symbol, {band_text_sql('s_nationkey')} AS band FROM supplier) s
  ON b.symbol = s.symbol
WHERE dayofweek(b.date) = 1"""


def sentiment_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = supplier_days(spark, sf_dir)
    return d.select("symbol", F.col("date").alias("fetch_date"), F.col("share_o").alias("bullish"),
                    F.col("share_r").alias("bearish"), F.col("n_lines").alias("articles"))


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sentiment_raw(spark, sf_dir)
    return raw.select("symbol", "fetch_date", *X.sentiment_features("bullish", "bearish", "articles"))


SENTIMENT_SQL = f"""
SELECT symbol, fetch_date, bullish - bearish AS sentiment_score,
       CAST(CASE WHEN bullish - bearish > 0.1 THEN 1 WHEN bullish - bearish < -0.1 THEN -1 ELSE 0 END AS INTEGER)
         AS sentiment_direction,
       articles AS news_intensity,
       CASE WHEN articles < 2 THEN 'low' ELSE 'normal' END AS news_coverage_flag
FROM (SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS fetch_date,
             avg(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS bullish,
             avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS bearish,
             count(*) AS articles
      FROM lineitem GROUP BY 1, 2) t"""


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-wide daily macro series (one row per date)."""
    o = table(spark, sf_dir, "orders")
    m = (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
         .agg((exact_avg("o_totalprice") / 100.0).alias("gold_usd"),
              (F.min("o_totalprice") / 1000.0).alias("crude_oil_usd"),
              (F.lit(70.0) + F.count(F.lit(1)) / 10.0).alias("usd_inr")))
    return m.withColumn("gold_inr", X.gold_inr("gold_usd", "usd_inr"))


MACRO_SQL = f"""
SELECT date, gold_usd, crude_oil_usd, usd_inr, gold_usd * usd_inr AS gold_inr
FROM (SELECT CAST(o_orderdate AS DATE) AS date, {exact_avg_sql('o_totalprice')} / CAST(100 AS DOUBLE) AS gold_usd,
             min(o_totalprice) / CAST(1000 AS DOUBLE) AS crude_oil_usd, CAST(70 AS DOUBLE) + count(*) / CAST(10 AS DOUBLE) AS usd_inr
      FROM orders GROUP BY 1) t"""


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static sector dimension: region as sector, nation as industry."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(symbol_of("s_suppkey").alias("symbol"), F.col("r_name").alias("sector"),
                    F.col("n_name").alias("industry")))


SECTORS_SQL = f"""
SELECT {symbol_sql('s_suppkey')} AS symbol, r_name AS sector, n_name AS industry
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


SQL_VIEWS = {
    "bars": BARS_SQL,
    "raw_ticks": RAW_TICKS_SQL,
    "universe": UNIVERSE_SQL,
    "delivery": DELIVERY_SQL,
    "circuit": CIRCUIT_SQL,
    "sentiment": SENTIMENT_SQL,
    "macro": MACRO_SQL,
    "sectors": SECTORS_SQL,
}
# views that other views read
SQL_DEPS = {"circuit": ["bars"]}


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    extra = extra or {}
    order: list[str] = []

    def add(n):
        if n in order:
            return
        for d in SQL_DEPS.get(n, []):
            add(d)
        order.append(n)

    for n in names:
        if n in SQL_VIEWS:
            add(n)
    ctes = [f"{n} AS ({SQL_VIEWS[n]})" for n in order]
    ctes += [f"{k} AS ({v})" for k, v in extra.items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


# Cap tiers from supplier market value (revenue x 4), fixed bounds.
CAP_TIER_BOUNDS = (1.23e8, 1.19e8)  # large >=, mid >=, else small


def cap_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, market_cap, cap_tier) per supplier; no revenue -> 'unknown'."""
    s = table(spark, sf_dir, "supplier")
    li = table(spark, sf_dir, "lineitem")
    rev = li.groupBy("l_suppkey").agg((exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4) * 4.0)
                                      .alias("market_cap"))
    j = s.join(rev, s.s_suppkey == rev.l_suppkey, "left")
    return j.select(symbol_of("s_suppkey").alias("symbol"), "market_cap", cap_tier_of("market_cap").alias("cap_tier"))


def cap_tier_of(market_cap: str) -> Column:
    mc = F.col(market_cap)
    return (F.when(mc.isNull(), F.lit("unknown")).when(mc >= CAP_TIER_BOUNDS[0], F.lit("large"))
            .when(mc >= CAP_TIER_BOUNDS[1], F.lit("mid")).otherwise(F.lit("small")))


CAP_TIERS_SQL = f"""
SELECT {symbol_sql('s_suppkey')} AS symbol, market_cap,
       CASE WHEN market_cap IS NULL THEN 'unknown' WHEN market_cap >= {CAP_TIER_BOUNDS[0]!r} THEN 'large'
            WHEN market_cap >= {CAP_TIER_BOUNDS[1]!r} THEN 'mid' ELSE 'small' END AS cap_tier
FROM supplier LEFT JOIN (SELECT l_suppkey, {exact_sum_sql('l_extendedprice * (1 - l_discount)', 4)} * 4.0 AS market_cap
                         FROM lineitem GROUP BY 1) r ON s_suppkey = r.l_suppkey"""
SQL_VIEWS["cap_tiers"] = CAP_TIERS_SQL


# --------------------------------------------------------------------------
# event tables for the enrichment stage
# --------------------------------------------------------------------------

def earnings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result dates per symbol: ship days with a first-line return (about
    one per quarter per supplier)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
            .select(symbol_of("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("event_date"))
            .distinct())


EARNINGS_SQL = f"""
SELECT DISTINCT {symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS event_date
FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1"""


def bar_corporate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ex-dates per (symbol, date): 'split' on single-unit first lines,
    'dividend' on lines without discount and tax; split wins on a tie."""
    li = table(spark, sf_dir, "lineitem")
    kind = (F.when((F.col("l_quantity") == 1) & (F.col("l_linenumber") == 1), F.lit(1))
            .when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit(2)))
    a = li.select(symbol_of("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"),
                  kind.alias("k")).filter(F.col("k").isNotNull())
    return (a.groupBy("symbol", "date").agg(F.min("k").alias("k"))
            .select("symbol", "date", F.when(F.col("k") == 1, F.lit("split")).otherwise(F.lit("dividend"))
                    .alias("action_type")))


BAR_ACTIONS_SQL = f"""
SELECT symbol, date, CASE WHEN min(k) = 1 THEN 'split' ELSE 'dividend' END AS action_type
FROM (SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(l_shipdate AS DATE) AS date,
             CASE WHEN l_quantity = 1 AND l_linenumber = 1 THEN 1 WHEN l_discount = 0 AND l_tax = 0 THEN 2 END AS k
      FROM lineitem) t
WHERE k IS NOT NULL GROUP BY 1, 2"""

# Macro events: first order date on/after the 5th of each even month is a
# policy meeting; the first order date of February is the budget.
MPC_MONTHS = (2, 4, 6, 8, 10, 12)
MPC_SECTORS = "ASIA,EUROPE"
BUDGET_SECTORS = "AMERICA,AFRICA,MIDDLE EAST"


def macro_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    mpc = (o.filter(F.month("d").isin(*MPC_MONTHS) & (F.dayofmonth("d") >= 5))
           .groupBy(F.year("d"), F.month("d")).agg(F.min("d").alias("event_date"))
           .select("event_date", F.lit("rbi_mpc_announcement").alias("event_type"),
                   F.lit(MPC_SECTORS).alias("sectors_impacted")))
    bud = (o.filter(F.month("d") == 2).groupBy(F.year("d")).agg(F.min("d").alias("event_date"))
           .select("event_date", F.lit("union_budget").alias("event_type"),
                   F.lit(BUDGET_SECTORS).alias("sectors_impacted")))
    return mpc.unionByName(bud)


MACRO_EVENTS_SQL = f"""
SELECT min(d) AS event_date, 'rbi_mpc_announcement' AS event_type, '{MPC_SECTORS}' AS sectors_impacted
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) t
WHERE month(d) IN {MPC_MONTHS} AND day(d) >= 5 GROUP BY year(d), month(d)
UNION ALL
SELECT min(d), 'union_budget', '{BUDGET_SECTORS}' FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) t
WHERE month(d) = 2 GROUP BY year(d)"""


def quarterly_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly revenue per supplier, reported on the 15th of the month
    after the quarter ends."""
    li = table(spark, sf_dir, "lineitem")
    q = F.trunc(F.col("l_shipdate").cast("date"), "quarter")
    g = li.groupBy(symbol_of("l_suppkey").alias("symbol"), q.alias("quarter_start")).agg(
        exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"))
    return g.select("symbol", "quarter_start", F.date_add(F.add_months("quarter_start", 3), 14).alias("report_date"),
                    "revenue")


QUARTERLY_SQL = f"""
SELECT symbol, quarter_start, CAST(quarter_start + INTERVAL 3 MONTH + INTERVAL 14 DAY AS DATE) AS report_date, revenue
FROM (SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter_start,
             {exact_sum_sql('l_extendedprice * (1 - l_discount)', 4)} AS revenue
      FROM lineitem GROUP BY 1, 2) t"""

SQL_VIEWS.update({"earnings": EARNINGS_SQL, "bar_actions": BAR_ACTIONS_SQL, "macro_events": MACRO_EVENTS_SQL,
                  "quarterly": QUARTERLY_SQL})


# --------------------------------------------------------------------------
# quarterly reports with two times: the quarter, and the day it was known
# --------------------------------------------------------------------------

#: Stand-in market value: one quarter's revenue times this.
MARKET_VALUE_MULTIPLE = 112.0
#: Share of returned sales by which a report is corrected later.
RESTATED_SHARE = 0.1


def quarterly_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports per (symbol, quarter): the first is known on the 15th of the
    month after the quarter; if goods came back, a corrected one follows 45
    days later.  previous_revenue is the last version of the quarter before."""
    li = table(spark, sf_dir, "lineitem")
    sale = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    g = li.groupBy(symbol_of("l_suppkey").alias("symbol"), F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("quarter_start")).agg(
        exact_sum("l_extendedprice", 2).alias("gross"), exact_sum(sale, 4).alias("sales"),
        exact_sum(sale * (1 - F.col("l_tax")), 6).alias("net"),
        F.coalesce(exact_sum(F.when(F.col("l_linestatus") == "F", sale), 4), F.lit(0.0)).alias("collected"),
        F.coalesce(exact_sum(F.when(F.col("l_returnflag") == "R", sale), 4), F.lit(0.0)).alias("returned"),
        F.sum("l_quantity").cast("double").alias("units"))
    w = Window.partitionBy("symbol").orderBy("quarter_start")
    cut = F.col("returned") * RESTATED_SHARE
    g = g.withColumn("previous_revenue", F.lag(F.col("sales") - cut, 1).over(w))
    version = F.explode(F.when(F.col("returned") > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("version")
    r = g.select("*", version)
    off = F.col("version") * cut
    return r.select("symbol", "quarter_start", F.date_sub(F.add_months("quarter_start", 3), 1).alias("quarter_end"),
                    F.date_add(F.add_months("quarter_start", 3), F.lit(14) + F.lit(45) * F.col("version")).alias("known_date"),
                    "gross", "collected", "returned", "units", F.col("sales").alias("first_revenue"),
                    (F.col("sales") - off).alias("revenue"), (F.col("net") - off).alias("net_income"), "previous_revenue")


REPORTS_SQL = f"""
SELECT symbol, quarter_start, CAST(quarter_start + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
       CAST(quarter_start + INTERVAL 3 MONTH AS DATE) + 14 + 45 * version AS known_date,
       gross, collected, returned, units, sales AS first_revenue, sales - version * (returned * 0.1) AS revenue,
       net - version * (returned * 0.1) AS net_income, previous_revenue
FROM (SELECT *, unnest(CASE WHEN returned > 0 THEN [0, 1] ELSE [0] END) AS version
      FROM (SELECT *, lag(sales - returned * 0.1) OVER (PARTITION BY symbol ORDER BY quarter_start) AS previous_revenue
            FROM (SELECT {symbol_sql('l_suppkey')} AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter_start,
                         {exact_sum_sql('l_extendedprice', 2)} AS gross,
                         {exact_sum_sql('l_extendedprice * (1 - l_discount)', 4)} AS sales,
                         {exact_sum_sql('l_extendedprice * (1 - l_discount) * (1 - l_tax)', 6)} AS net,
                         COALESCE({exact_sum_sql("CASE WHEN l_linestatus = 'F' THEN l_extendedprice * (1 - l_discount) END", 4)}, 0.0::DOUBLE) AS collected,
                         COALESCE({exact_sum_sql("CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) END", 4)}, 0.0::DOUBLE) AS returned,
                         CAST(sum(l_quantity) AS DOUBLE) AS units
                  FROM lineitem GROUP BY 1, 2) a) b) c"""
SQL_VIEWS["reports"] = REPORTS_SQL
