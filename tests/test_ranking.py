import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.ranking import ntile_within, rank_within


def test_rank_within_equals_window(spark):
    rnd = random.Random(11)
    value = lambda: rnd.choice([0.0, -0.0, 0.5, 0.5, 0.5, rnd.gauss(0, 3), rnd.randint(-9, 9) * 1.0, 2.0 ** rnd.randint(-40, 40), 1e308, None])
    rows = [(d, g, value()) for d in range(6) for g in ("a", "b") for _ in range(rnd.randint(1, 120))]
    rows += [(9, "c", 0.5)] * 900 + [(9, "c", float(i)) for i in range(100)]  # one value in nine of ten rows
    df = spark.createDataFrame(rows, "d int, g string, x double")
    got = rank_within(df, ["d", "g"], "x", "pr")
    w = Window.partitionBy("d", "g", F.col("x").isNotNull()).orderBy("x")
    exp = df.withColumn("pr", F.when(F.col("x").isNotNull(), F.percent_rank().over(w)))
    a = sorted(got.select("d", "g", "x", "pr").collect(), key=str)
    b = sorted(exp.select("d", "g", "x", "pr").collect(), key=str)
    assert a == b


def test_ntile_within_ties_share_tile(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [1, 1, 1, 2, 3, 4, 5, 6, 7, 8]], "d int, x double")
    out = {(r.x, r.t) for r in ntile_within(df, ["d"], "x", 5, "t").collect()}
    assert {t for x, t in out if x == 1.0} == {1}
    assert max(t for _, t in out) == 5


def test_exact_median(spark):
    import statistics

    from ledgerline.functions.ranking import exact_median

    rows = [(g, float(v)) for g, vals in {"a": [5, 1, 3, 3, 9, 2], "b": [7], "c": [4, 4, 1, 8, 2]}.items() for v in vals]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "x").collect()}
    assert got == {"a": statistics.median([5, 1, 3, 3, 9, 2]), "b": 7.0, "c": 4.0}


def _odd_rows(spark):
    rnd = random.Random(5)
    value = lambda: rnd.choice([0.0, -0.0, 0.5, 0.5, rnd.gauss(0, 3), float("nan"), None])
    rows = [(d, g, value(), value(), i) for d in range(4) for g in ("a", None) for i in range(rnd.randint(1, 90))]
    rows += [(7, "c", 1.0, None, 1000), (8, "c", None, None, 1001)]
    return spark.createDataFrame(rows, "d int, g string, x double, y double, id int")


SPECS = [("x", "px", False), ("y", "py", True), ("x", "rx", True, False)]


def test_rank_many_is_the_same_by_windows_and_by_ranges(spark):
    from ledgerline.functions.ranking import rank_many

    df = _odd_rows(spark)
    found = [sorted(rank_many(df, ["d", "g"], SPECS, group_rows=n).collect(), key=str) for n in (0, 40, 1000)]
    assert len(found[0]) == df.count() and str(found[0]) == str(found[1]) == str(found[2])


def test_rank_many_joins_no_rank_back_to_the_rows_of_bounded_groups(spark):
    from ledgerline.functions.ranking import rank_many

    plan = rank_many(_odd_rows(spark), ["d", "g"], SPECS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
