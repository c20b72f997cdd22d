"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF001
from ledgerline.operators import evaluate as V
from ledgerline.operators import universe as U
from ledgerline.plans import daily
from ledgerline.sources import testviews as TV


def _plan(df):
    """The final adaptive plan (the string also lists the initial plan)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scores(spark):
    return spark.range(0, 20000).select(
        (F.col("id") % 50).alias("date"), (F.col("id") % 3).cast("string").alias("cap_tier"),
        F.col("id").cast("string").alias("symbol"), F.rand(1).alias("composite_score"),
        F.lit(True).alias("eligible"), (F.col("id") % 7).cast("string").alias("sector"))


def test_topk_uses_group_limit(spark):
    assert "WindowGroupLimit" in _plan(U.tier_quota_topk(_scores(spark)))
    sig = _scores(spark).withColumnRenamed("composite_score", "score")
    assert "WindowGroupLimit" in _plan(V.portfolio_limits(sig))


def test_bars_aggregate_partially_before_shuffle(spark):
    plan = _plan(TV.bars(spark, SF001))
    assert "partial_min_by" in plan and "partial_max_by" in plan


def test_gold_windows_add_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = lambda df: _plan(df).count("Exchange hashpartitioning")
        read = ["symbol", "date", "open", "high", "low", "close", "volume", "market_context", "delivery_pct", "gold_usd",
                "crude_oil_usd", "gold_inr"]
        silver, gold = count(daily.silver(spark, SF001).select(*read)), count(daily.gold(spark, SF001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # joins on (symbol, date), the lifecycle and every feature window use the symbol layout:
    # gold has the exchanges of the silver columns it reads and no other
    assert gold == silver, (silver, gold)


def test_ranks_have_no_window_over_a_whole_day(spark):
    from ledgerline.functions.ranking import rank_within

    df = spark.range(2000).selectExpr("'2024-01-01' as date", "if(id % 10 > 0, 0.5D, cast(id as double)) as x")
    plan = _plan(rank_within(df, ["date"], "x", "r"))
    assert "partial_count" in plan and "__range" in plan
    # windows run over distinct values of a range, or over the counts of the ranges
    assert all("__value" in w or "__in" in w for w in plan.split("\n") if " Window [" in w)


def test_bars_aggregate_is_hash_based(spark):
    # a fixed-width ordering key keeps min_by / max_by in a hash aggregate
    plan = _plan(TV.bars(spark, SF001))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_wide_batches_are_folded_before_their_only_shuffle(spark):
    from ledgerline.sources import landing as L

    wide = spark.createDataFrame([("2024-01-01", {"A|Open": 1.0, "A|Close": 2.0, "A|Volume": 3.0, "B|High": 4.0})], "date string, wide map<string, double>")
    out = L.wide_map_to_long(wide)
    assert _plan(out).count("Exchange hashpartitioning") == 1
    assert sorted((r.symbol, r.open, r.high, r.low, r.close, r.volume) for r in out.collect()) == [
        ("A", 1.0, None, None, 2.0, 3), ("B", None, 4.0, None, None, None)]


def test_gaps_are_filled_on_bars_not_on_the_grid(spark):
    import datetime as dt

    from ledgerline.operators import enrichment as EN

    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    trading = [n for n in range(30) if n % 7 < 5]
    cal = spark.createDataFrame([("us", day(n), i) for i, n in enumerate(trading)], "market_context string, date date, day_index int")
    # A starts and B ends on a day without trading; A has a missing price and a gap
    bars = {"A": {5: 1.0, 8: 2.0, 9: None, 10: 3.0, 22: 4.0}, "B": {0: 5.0, 4: 6.0, 12: 7.0, 13: 8.0}, "C": {3: 9.0}}
    rows = [(s, "us", day(n), c, n, c if n < 20 else None) for s, own in bars.items() for n, c in own.items()]
    df = spark.createDataFrame(rows, "symbol string, market_context string, date date, close double, volume long, f double")
    out = EN.gap_fill(df, cal, carry=["f"])
    got = {(r.symbol, r.date): tuple(r)[3:] for r in out.collect()}
    want = {}
    for s, own in bars.items():
        for i, n in enumerate(trading):
            if min(own) <= n <= max(own):
                past = [m for m in sorted(own) if m <= n and m in trading]
                gap = i - trading.index(past[-1]) if past else None
                close = next((own[m] for m in reversed(past) if own[m] is not None), None)
                f = next((own[m] for m in reversed(past) if own[m] is not None and m < 20), None)
                want[s, day(n)] = (i, gap, close if past and gap <= 3 else None, past[-1] if past and gap <= 2 else None, n in own, f)
    assert got == want and ("A", day(7)) in want and want["A", day(7)][1] is None and max(w[1] or 0 for w in want.values()) > 3
    plan = _plan(out)
    assert "Window" in plan and plan.index("Generate explode") < plan.index("Window")  # the expansion comes last
