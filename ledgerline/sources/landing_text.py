"""Landing text derived from the driver tables, in each source's raw format.

The parsers in ``sources.landing`` need raw CSV lines, JSON documents and
HTML pages.  These builders produce them with Spark from whole tables (one
document per natural key: supplier-day, user-day, order, date), so the
parsing work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..util import exact_avg, exact_sum

from ..util import round_half_away
from .testviews import bars, table


def _dec_text(c, scale: int, prec: int = 18):
    return round_half_away(c, scale).cast(f"decimal({prec},{scale})").cast("string")


def delivery_lines(spark: SparkSession, d: str) -> DataFrame:
    """(date, line) rows of daily delivery files: 'SYMBOL, SERIES, DELIV_PER'."""
    li = table(spark, d, "lineitem")
    g = li.groupBy(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("date")).agg(
        F.sum("l_quantity").alias("q"), F.avg(F.when(F.col("l_returnflag") == "N", 1).otherwise(0)).alias("n"),
        F.min("l_returnflag").alias("rmin"), F.max("l_returnflag").alias("rmax"))
    series = F.when(F.col("q") > 45, F.lit("BE")).otherwise(F.lit("EQ"))
    pct = F.when((F.col("rmin") == "R") & (F.col("rmax") == "R"), F.lit("-")).otherwise(
        _dec_text(F.col("n") * 100.0, 1, 5))
    return g.select("date", F.concat_ws(", ", F.concat(F.lit("S"), F.col("k").cast("string")), series, pct)
                    .alias("line"))


def circuit_lines(spark: SparkSession, d: str) -> DataFrame:
    from .testviews import band_text

    s = table(spark, d, "supplier")
    return s.select(F.concat_ws(",", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
                                band_text("s_nationkey")).alias("line"))


UNIVERSE_HEADER = "SYMBOL,NAME OF COMPANY, SERIES"


def universe_lines(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    body = s.select(F.concat_ws(", ", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.col("s_name"),
                                F.when(F.col("s_acctbal") > 0, F.lit("EQ")).otherwise(F.lit("BE"))).alias("line"))
    header = spark.range(1).select(F.lit(UNIVERSE_HEADER).alias("line"))
    return header.unionByName(body)


def sector_lines(spark: SparkSession, d: str) -> DataFrame:
    from .testviews import sectors

    header = spark.range(1).select(F.lit("symbol,sector,industry").alias("line"))
    body = sectors(spark, d).select(F.concat_ws(",", "symbol", "sector", "industry").alias("line"))
    return header.unionByName(body)


WIDE_BATCH = 500  # symbols per download batch


def wide_batches(spark: SparkSession, d: str) -> DataFrame:
    """Bars as wide download batches: one row per (date, batch of at most
    500 consecutive supplier keys) holding a map '<ticker>|<Field>' -> value."""
    b = bars(spark, d)
    k = F.regexp_extract("symbol", r"^S(\d+)", 1).cast("long")
    fields = [("Open", "open"), ("High", "high"), ("Low", "low"), ("Close", "close"), ("Volume", "volume")]
    ent = F.array(*[F.struct(F.concat("symbol", F.lit(f"|{name}")).alias("k"), F.col(c).cast("double").alias("v"))
                    for name, c in fields])
    return (b.groupBy("date", F.floor(k / WIDE_BATCH).alias("batch"))
            .agg(F.map_from_entries(F.flatten(F.collect_list(ent))).alias("wide")))


def corporate_action_docs(spark: SparkSession, d: str) -> DataFrame:
    """One ``{symbol: {date: {dividend?, split?}}}`` document per user-day."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    g = e.groupBy(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                  F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        exact_sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("dividend"),
        F.max(F.when((F.col("event_type") == "signup") & (k >= 90), k / 10.0)).alias("split"))
    doc = F.to_json(F.create_map(F.col("symbol"), F.create_map(F.col("day"), F.struct("dividend", "split"))))
    return g.select(doc.alias("json"))


def earnings_docs(spark: SparkSession, d: str) -> DataFrame:
    """One ``{symbol: {next_earnings_date}}`` document per order; pending
    orders carry no date (no row)."""
    o = table(spark, d, "orders")
    sym = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    inner = F.when(F.col("o_orderstatus") != "P",
                   F.concat(F.lit('"next_earnings_date": "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"'))
                   ).otherwise(F.lit(""))
    return o.select(F.concat(F.lit('{"'), sym, F.lit('": {'), inner, F.lit("}}")).alias("json"))


def sentiment_docs(spark: SparkSession, d: str) -> DataFrame:
    """One JSON array document per (supplier, ship date)."""
    from .testviews import sentiment_raw

    r = sentiment_raw(spark, d)
    obj = F.struct(F.col("symbol").alias("requested_symbol"),
                   F.struct(F.col("bullish").alias("bullishPercent"), F.col("bearish").alias("bearishPercent"))
                   .alias("sentiment"),
                   F.when(F.col("articles") > 1, F.struct(F.col("articles").alias("articlesInLastWeek"))).alias("buzz"))
    return r.select("fetch_date", F.to_json(F.array(obj)).alias("json"))


def fundamentals_docs(spark: SparkSession, d: str) -> DataFrame:
    """One flat JSON object per supplier (absent keys are omitted)."""
    s = table(spark, d, "supplier")
    li = table(spark, d, "lineitem")
    a = li.groupBy("l_suppkey").agg(
        exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("rev"), F.count(F.lit(1)).alias("n"),
        exact_avg("l_discount").alias("disc"), exact_avg("l_tax").alias("tax"))
    j = s.join(a, s.s_suppkey == a.l_suppkey, "left")
    bal = F.col("s_acctbal")
    doc = F.struct(
        F.when(bal > 1000, bal / 100.0).alias("trailingPE"), (bal / 120.0).alias("forwardPE"),
        (F.col("n") / 10.0).alias("priceToBook"), (F.col("rev") * 4.0).alias("marketCap"),
        (F.col("n") * 1000.0).alias("impliedSharesOutstanding"), F.col("disc").alias("heldPercentInstitutions"),
        F.col("tax").alias("heldPercentInsiders"), F.when(bal > 0, F.col("rev")).alias("totalRevenue"),
        (F.col("rev") * 0.1).alias("netIncomeToCommon"), F.when(bal < 0, -bal).otherwise(F.lit(0.0)).alias("totalDebt"),
        (F.col("rev") * 0.05).alias("operatingCashflow"))
    from .testviews import symbol_of

    return j.select(symbol_of("s_suppkey").alias("symbol"), F.to_json(doc).alias("json"))


def _order_day_stats(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        exact_avg("o_totalprice").alias("avgp"), F.min("o_totalprice").alias("minp"),
        F.max("o_totalprice").alias("maxp"), exact_sum("o_totalprice").alias("sump"), F.count(F.lit(1)).alias("cnt"))


def macro_html_pages(spark: SparkSession, d: str) -> DataFrame:
    """One central-bank style rate page per order date."""
    g = _order_day_stats(spark, d)

    def tr(a, b):
        return F.concat(F.lit("<tr><td>"), a, F.lit("</td><td>"), b, F.lit("</td></tr>"))

    r1 = _dec_text(F.col("avgp") / 50000.0, 2)
    r3 = _dec_text(F.col("minp") / 20000.0, 2)
    y1 = _dec_text(F.col("maxp") / 70000.0, 4)
    y2 = _dec_text(F.col("avgp") / 30000.0, 4)
    y0 = _dec_text(F.col("maxp") / 10000.0, 4)
    rows = F.concat(
        F.lit("<tr><th>Rate</th><th>Value</th></tr>"),
        tr(F.lit("Policy Repo Rate"), F.concat(F.lit(":\n  "), r1, F.lit("%"))),
        tr(F.lit("Policy Repo Rate (revised)"), F.lit(": N/A%")),
        F.when(F.col("cnt") > 6, tr(F.lit("Policy Repo Rate"), F.concat(F.lit(": "), r3, F.lit("%")))).otherwise(F.lit("")),
        tr(F.lit("6.48% GS 2035"), F.concat(F.lit(": "), y1, F.lit("% #"))),
        tr(F.lit("7.10% GS 2041"), F.concat(F.lit(": "), y2, F.lit("%"))),
        tr(F.lit("5.63% GS 2026"), F.concat(F.lit(": "), y0, F.lit("%"))),
    )
    html = F.concat(F.lit("<html><body><h1>Rates</h1><table class=\"t\">"), rows, F.lit("</table></body></html>"))
    return g.select("date", html.alias("html"))


def macro_price_docs(spark: SparkSession, d: str) -> DataFrame:
    """One ``{ticker: {close, date}}`` document per order date; the VIX
    ticker is missing on thin days."""
    g = _order_day_stats(spark, d)
    ds = F.date_format("date", "yyyy-MM-dd")
    vix = F.when(F.col("cnt") >= 5, F.struct((F.col("avgp") / 10000.0).alias("close"), ds.alias("date")))
    nifty = F.struct((F.col("sump") / 1000.0).alias("close"), ds.alias("date"))
    m = F.map_filter(F.create_map(F.lit("^INDIAVIX"), vix, F.lit("^NSEI"), nifty), lambda k, v: v.isNotNull())
    return g.select("date", F.to_json(m).alias("json"))
