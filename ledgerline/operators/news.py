"""News operators: decayed sentiment (M08) and novelty."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# ---- fixed values of the spec ------------------------------------------------
DECAY_WINDOW_DAYS = 5
MIN_ARTICLES = 2
MIN_CONFIDENCE = 0.4
DEFAULT_HALF_LIFE_DAYS = 2.0  # not given by the spec: a parameter
# -------------------------------------------------------------------------------


def sentiment_decay(articles: DataFrame, trading_days: DataFrame, half_life: float = DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """Per (symbol, trading day) the recency-weighted mean polarity of
    the articles of the last 5 trading days (weight 0.5^(age / half_life));
    articles under 0.4 confidence are dropped; fewer than 2 articles gives a
    neutral 0 and ``low_coverage``.

    ``trading_days`` (day) is the calendar.  An article counts for the first
    trading day on or after its own; later than the calendar, for none.  Days
    are numbered, and each symbol's numbers between its first and its last are
    filled in, so the window is five ``lag``s, not a range join."""
    order = Window.orderBy("day")  # one row per calendar day
    cal = (trading_days.select("day").distinct()
           .select("day", F.row_number().over(order).alias("index"), F.lag("day").over(order).alias("before")))
    civil = cal.select("index", F.explode(F.sequence(
        F.coalesce(F.date_add("before", 1), F.date_sub("day", 7)), "day")).alias("day"))
    a = articles.filter(F.col("confidence") >= MIN_CONFIDENCE)
    daily = (a.groupBy("symbol", "day").agg(F.sum("polarity").alias("__p"), F.count(F.lit(1)).alias("__n"))
             .join(civil, "day").groupBy("symbol", "index").agg(F.sum("__p").alias("__p"), F.sum("__n").alias("__n")))
    span = daily.groupBy("symbol").agg(F.min("index").alias("lo"), F.max("index").alias("hi"))
    grid = span.select("symbol", F.explode(F.sequence("lo", "hi")).alias("index"))
    g = grid.join(daily, ["symbol", "index"], "left").fillna(0, ["__p", "__n"])
    w = Window.partitionBy("symbol").orderBy("index")
    num = den = cnt = None
    for k in range(DECAY_WINDOW_DAYS):
        wt = 0.5 ** (k / half_life)
        p = F.col("__p") if k == 0 else F.coalesce(F.lag("__p", k).over(w), F.lit(0.0))
        n = F.col("__n") if k == 0 else F.coalesce(F.lag("__n", k).over(w), F.lit(0))
        num = p * wt if num is None else num + p * wt
        den = n * wt if den is None else den + n * wt
        cnt = n if cnt is None else cnt + n
    g = g.select("symbol", "index", cnt.alias("article_count_5d"), num.alias("__num"), den.alias("__den"))
    g = g.join(cal.select("index", "day"), "index")
    low = F.col("article_count_5d") < MIN_ARTICLES
    score = F.when(low, F.lit(0.0)).otherwise(F.col("__num") / F.col("__den"))
    return g.select("symbol", "day", "article_count_5d", score.alias("sentiment_decayed"), low.alias("low_coverage"))


def news_novelty(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A document is novel when it is the first (smallest id) with its
    exact text; copies are repeats.  The first id per text hash is a partial
    aggregate, so a text with very many copies is reduced map side.  Both
    sides of the join back are written tables of (id, hash) size, so Spark's
    skew join can split a hot hash and no text is shuffled or hashed twice."""
    h = cut_lineage(docs.select(id_col, F.sha2(F.col(text_col), 256).alias("text_hash")))
    first = cut_lineage(h.groupBy("text_hash").agg(F.min(id_col).alias("__first"), F.count(F.lit(1)).alias("copies")))
    j = h.join(first, ["text_hash"])
    return j.select(id_col, "text_hash", "copies", (F.col(id_col) == F.col("__first")).alias("is_novel"))
