"""Sinks: bronze dynamic partition overwrite, snapshot tables, schema evolution, upsert."""

from pyspark.sql import functions as F

from ledgerline.sinks import writers as W


def test_bronze_rerun_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day1 = spark.createDataFrame([("A.NS", "india", "2024-01-01", 1.0), ("B.NS", "india", "2024-01-02", 2.0)],
                                 "symbol string, market_context string, date string, close double")
    W.write_bronze(day1, path)
    rerun = spark.createDataFrame([("A.NS", "india", "2024-01-02", 9.0)],
                                  "symbol string, market_context string, date string, close double")
    W.write_bronze(rerun, path)
    got = sorted((r.symbol, str(r.date), r.close) for r in W.scan_partitioned(spark, path).collect())
    assert got == [("A.NS", "2024-01-01", 1.0), ("A.NS", "2024-01-02", 9.0)]


def test_appends_newest_write_and_overwrite(spark, tmp_path):
    path, schema = str(tmp_path / "silver"), "symbol string, d string, close double"
    W.append_snapshot(spark.createDataFrame([("AAPL", "2024-01-02", 185.9)], schema), path)
    W.append_snapshot(spark.createDataFrame([("MSFT", "2024-01-04", 370.0)], schema), path)
    assert W.read_table(spark, path).count() == 2
    assert [r.symbol for r in W.read_table(spark, path, newest=True).collect()] == ["MSFT"]
    wide = spark.createDataFrame([], schema + ", tier string").schema
    assert {r.tier for r in W.read_table(spark, path, wide).collect()} == {None}
    W.overwrite_table(spark.createDataFrame([("X", "2024-02-01", 1.0)], schema), path)
    assert [r.symbol for r in W.read_table(spark, path).collect()] == ["X"]


def test_schema_evolution_reads_null(spark):
    old = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    new = spark.createDataFrame([("B", 2.0, "large")], "symbol string, close double, cap_tier string")
    rows = {r.symbol: r.cap_tier for r in W.evolve_union(old, new).collect()}
    assert rows == {"A": None, "B": "large"}


def test_upsert_latest(spark):
    cur = spark.createDataFrame([("A", "2024-01-02", 0.1, 1), ("B", "2024-01-02", 0.2, 1)],
                                "symbol string, prediction_date string, p double, version int")
    inc = spark.createDataFrame([("A", "2024-01-02", 0.9, 2)], "symbol string, prediction_date string, p double, version int")
    got = {r.symbol: r.p for r in W.upsert_latest(cur, inc, ["symbol", "prediction_date"], "version").collect()}
    assert got == {"A": 0.9, "B": 0.2}
    # equal versions: the incoming row wins, whatever the order of the rows
    tie = inc.withColumn("version", F.lit(1))
    for existing in (cur, cur.orderBy(F.desc("p"))):
        got = {r.symbol: r.p for r in W.upsert_latest(existing, tie, ["symbol", "prediction_date"], "version").collect()}
        assert got == {"A": 0.9, "B": 0.2}


def test_landing_and_audit(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02", "x")], "date string, v string")
    W.write_landing_raw(df, str(tmp_path / "land"), "json")
    assert spark.read.json(str(tmp_path / "land")).count() == 1
    path = str(tmp_path / "audit")
    W.append_audit(spark, [W.job_audit_row("J01", "r1", "SUCCESS", {"rows": 3}, "late", "2024-01-02")], path)
    W.append_audit(spark, [W.audit_row("G0", "r2", "PASS", "bars", "2024-01-02", 5, 4, 1)], path)
    got = {r.run_id: r for r in spark.read.parquet(path).collect()}
    assert got["r1"].metrics == '{"rows": 3}' and got["r1"].error_message == "late" and got["r1"].job_date == "2024-01-02"
    assert got["r2"].pass_count == 4 and got["r2"].metrics is None


def test_bronze_partition_is_dealt_out_to_several_tasks(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F

    from ledgerline.sinks import writers as W

    path, size = str(tmp_path / "b"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        W.write_bronze(spark.range(100_000).select("id", F.rand(1).alias("x"), F.lit("india").alias("market_context")).repartition(8), path, ("market_context",))
    finally:
        spark.conf.unset(size)
    assert len(glob.glob(f"{path}/market_context=india/*.parquet")) > 1
    assert spark.read.parquet(path).distinct().count() == 100_000
