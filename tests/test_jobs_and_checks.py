"""Run records, look-ahead check, drift report, schema contract, streams of several batches."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import exprs as X
from ledgerline.operators import evaluate as V
from ledgerline.operators import gate as G
from ledgerline.operators import jobs as J
from ledgerline.operators import promotion as P
from ledgerline.sinks import writers as W
from ledgerline.streaming import jobs as S

BARS = "symbol string, date date, open double, high double, low double, close double, volume long"
D = dt.date(2024, 3, 4)


def bar(symbol, volume=10, close=2.0):
    return (symbol, D, 2.0, 3.0, 1.0, close, volume)


def test_job_statuses_metrics_and_dry_run(spark, tmp_path):
    bronze, audit = str(tmp_path / "bronze"), str(tmp_path / "audit")
    universe = spark.createDataFrame([("A.NS",), ("B.NS",), ("U",), ("U",)], "symbol string")

    def run(rows, name, trading=True, dry=False, listed=universe):
        return J.bars_job(spark, spark.createDataFrame(rows, BARS), listed, "2024-03-04", trading, name, bronze, audit, dry_run=dry)["status"]

    assert run([bar("A.NS"), bar("B.NS"), bar("U")], "dry", dry=True) == "SUCCESS" and not (tmp_path / "bronze").exists()
    assert run([bar("A.NS"), bar("B.NS"), bar("U")], "all") == "SUCCESS"
    assert run([bar("A.NS"), bar("B.NS", volume=-1)], "some") == "PARTIAL_SUCCESS"
    assert run([bar("A.NS", close=-1.0)], "none") == "FAILED"
    assert run([], "holiday", trading=False) == "SKIPPED_HOLIDAY"
    with pytest.raises(Exception):
        J.bars_job(spark, spark.createDataFrame([bar("A.NS")], BARS).withColumn("close", F.expr("raise_error('broken')")), universe, "2024-03-04",
                   True, "broken", bronze, audit)
    table = spark.read.schema(W.AUDIT_SCHEMA).parquet(audit)
    rows = {r.run_id: r for r in J.run_metrics(table, ["rows_passed_india", "rows_rejected_india", "symbols_failed_india", "symbols_failed_us"]).collect()}
    assert (rows["some"].rows_passed_india, rows["some"].rows_rejected_india, rows["some"].symbols_failed_india, rows["some"].symbols_failed_us) == (1, 1, 1, 1)
    assert rows["broken"].status == "FAILED" and "broken" in rows["broken"].error_message and rows["holiday"].rows_passed_india is None
    assert {(r.status, r.runs) for r in J.status_counts(table).collect()} == {
        ("SUCCESS", 2), ("PARTIAL_SUCCESS", 1), ("FAILED", 2), ("SKIPPED_HOLIDAY", 1)}


def test_lookahead_check_counts_planted_features(spark):
    rows = [(s, D + dt.timedelta(days=i), float(i * (1 + k))) for k, s in enumerate("AB") for i in range(20)] + [("C", D, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double")

    def build(d):
        w = Window.partitionBy("symbol").orderBy("date")
        return d.select("*", F.sum("x").over(w).alias("honest"), F.lead("x").over(w).alias("next"),
                        F.max("x").over(Window.partitionBy("symbol")).alias("whole"))

    cuts = [str(D + dt.timedelta(days=n)) for n in (4, 9, 40)]
    got = {(str(r.cutoff_date), r.feature): r.mismatched_rows for r in P.lookahead_check(df, build, cuts, ["honest", "next", "whole"]).collect()}
    assert got == {(cuts[0], "honest"): 0, (cuts[0], "next"): 2, (cuts[0], "whole"): 10, (cuts[1], "honest"): 0, (cuts[1], "next"): 2,
                   (cuts[1], "whole"): 20, (cuts[2], "honest"): 0, (cuts[2], "next"): 0, (cuts[2], "whole"): 0}


def test_lookahead_check_compares_only_quarters_that_differ(spark):
    # "next" differs on the last row before the cut alone: of eight quarters one is compared row by row
    df = spark.createDataFrame([("A", dt.date(2022, 1, 3) + dt.timedelta(days=7 * i), float(i)) for i in range(120)], "symbol string, date date, x double")
    out = P.lookahead_check(df, lambda d: d.select("*", F.lead("x").over(Window.partitionBy("symbol").orderBy("date")).alias("next")),
                            ["2023-12-31"], ["next"])
    assert [r.mismatched_rows for r in out.collect()] == [1]
    assert "__quarter" in out._jdf.queryExecution().optimizedPlan().toString()


def test_drift_report_sees_a_shift_a_gap_and_outliers(spark):
    monday = dt.date(2024, 1, 1)
    rows = [(monday + dt.timedelta(days=7 * w + d), (1.0 if w == 2 else 0.0) + 0.1 * d if w < 4 else None, 0.05 + 0.1 * d)
            for w in range(6) for d in range(5)] + [(monday, 50.0, 0.95)]
    got = {(r.feature, r.week): r for r in V.drift_report(spark.createDataFrame(rows, "date date, f double, c double"), ["f"], "c").collect()}
    week = lambda n: monday + dt.timedelta(days=7 * n)
    assert got["f", week(0)].psi is None and got["f", week(0)].outlier_share == pytest.approx(1 / 6) and got["f", week(4)].null_share == 1.0
    assert (got["f", week(3)].feed_age_days, got["f", week(4)].feed_stale, got["f", week(3)].feed_stale) == (2, True, False)
    assert got["c", week(1)].histogram == "1,1,1,1,1,0,0,0,0,0" and got["c", week(0)].histogram.endswith("1")
    assert got["f", week(1)].median == pytest.approx(0.2)


def test_schema_contract_and_required_values(spark):
    contract = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("close", T.DoubleType()), T.StructField("d", T.DateType(), False)])
    df = spark.createDataFrame([("A", 1, "unknown")], "symbol string, close long, cap_tier string")
    assert {(i["column"], i["issue"]) for i in G.schema_check(df, contract)} == {("close", "type"), ("d", "missing")}
    with pytest.raises(ValueError, match="contract"):
        P.silver_readiness(df, contract=contract)
    prices = spark.createDataFrame([("A", 1.0, 1), ("A", 2.0, 2), ("B", None, 1)], "symbol string, close double, date int")
    assert X.latest_closes(prices, ["A"]) == {"A": 2.0}
    with pytest.raises(KeyError, match="B, Z"):
        X.latest_closes(prices, ["A", "Z", "B"])
    none = spark.createDataFrame([("A", None)], "symbol string, close double")
    assert X.drop_all_null_bars(none).count() == 0
    with pytest.raises(ValueError):
        X.drop_all_null_bars(none, required=True)


def test_namespace_quarantine_and_clustered_bronze(spark, tmp_path):
    W.ensure_namespace(spark, "ledgerline_test")
    assert "ledgerline_test" in [r[0] for r in spark.sql("show databases").collect()]
    for n in (3, 2):
        path = W.write_quarantine(spark.range(n), str(tmp_path), "2024-01-02", "x")
    assert spark.read.json(path).count() == 2
    df = spark.createDataFrame([("B", "us", 1), ("A", "us", 2), ("C", "us", 3)], "symbol string, market_context string, v int")
    W.write_bronze(df, str(tmp_path / "b"), ("market_context",), cluster_by="symbol")
    assert [r.symbol for r in spark.read.parquet(str(tmp_path / "b")).collect()] == ["A", "B", "C"]


def test_dedup_state_expires_and_bars_count_late_rows(spark, tmp_path):
    t = lambda *a: dt.datetime(2024, *a)
    feed = spark.createDataFrame([("K", t(1, 1), 0), ("K", t(1, 1), 0), ("K", t(1, 3), 1), ("L", t(1, 5), 2), ("L", t(1, 20), 3),
                                  ("L", t(1, 25), 4), ("K", t(1, 30), 5)], "k string, at timestamp, part int")
    S.land_in_order(feed, str(tmp_path / "feed"), "part")
    src = S.landing_stream(spark, str(tmp_path / "feed"), feed.drop("part").schema, max_files=1)
    S.run_to_table(S.dedup_within_watermark(src, ["k"], "at", "4 days"), str(tmp_path / "out"), str(tmp_path / "ck"))
    # the state goes when the watermark, which follows the batch before, has passed it: L is known on 20 and 25, K is new on 30
    assert sorted((r.k, r.at.day) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("K", 1), ("K", 30), ("L", 5)]
    ticks = spark.createDataFrame([("A", t(1, 1, 9), 1.0, 0), ("A", t(1, 1, 9, 30), 2.0, 0), ("A", t(1, 1, 20), 3.0, 1), ("A", t(1, 1, 21), 4.0, 2),
                                   ("A", t(1, 1, 9, 45), 9.0, 3), (None, t(1, 9), 0.0, 4)], "symbol string, ts timestamp, price double, part int")
    S.land_in_order(ticks, str(tmp_path / "ticks"), "part")
    stream = S.landing_stream(spark, str(tmp_path / "ticks"), ticks.drop("part").schema, max_files=1)
    bars = S.intraday_bars(stream, watermark="1 hour")
    S.run_to_table(bars, str(tmp_path / "bars"), str(tmp_path / "ck2"))
    out = S.late_rows(ticks.where("symbol is not null"), spark.read.schema(bars.schema).parquet(str(tmp_path / "bars"))).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.close, r.volume, r.late_rows) for r in out] == [(9, 2.0, 2, 1), (20, 3.0, 1, 0), (21, 4.0, 1, 0)]


def test_lookahead_check_keeps_no_copy_of_the_rows(spark, monkeypatch):
    # of 2 x 100 rows and their 3 x 2 copies only those that differ are written, and rows that one build drops count
    sizes = {}

    def keep(df, name):
        out = P_written(df, name)
        sizes[name] = out.count()
        return out

    P_written = P.written
    monkeypatch.setattr(P, "written", keep)
    df = spark.createDataFrame([(s, D + dt.timedelta(days=i), float(i)) for s in "AB" for i in range(100)], "symbol string, date date, x double")
    last = F.max("date").over(Window.partitionBy("symbol"))

    def build(d):  # drops the last day, and of long symbols the first
        d = d.select("*", F.lead("x").over(Window.partitionBy("symbol").orderBy("date")).alias("next"), F.col("x").alias("own"), last.alias("__last"))
        return d.filter((F.col("date") < F.col("__last")) & ((F.col("x") > 0) | (F.col("__last") < F.lit(D + dt.timedelta(days=80))))).drop("__last")

    cuts = [str(D + dt.timedelta(days=n)) for n in (50, 90, 200)]
    got = {(str(r.cutoff_date), r.feature): r.mismatched_rows for r in P.lookahead_check(df, build, cuts, ["next", "own"]).collect()}
    # cut 50: the first day is in the cut's build alone, the last before the cut in that of all rows; cut 90: the latter
    assert got == {(cuts[0], "next"): 4, (cuts[0], "own"): 4, (cuts[1], "next"): 2, (cuts[1], "own"): 2, (cuts[2], "next"): 0, (cuts[2], "own"): 0}
    assert set(sizes) == {"lookahead-rows", "lookahead-full", "lookahead-hashed", "lookahead-odd"} and sizes["lookahead-odd"] == 2
    with pytest.raises(ValueError, match="does not know"):
        P.lookahead_check(df, lambda d: d.select("symbol", "date", F.col("x").alias("next")), cuts, ["next"])
