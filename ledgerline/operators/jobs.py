"""Jobs with a run date, a dry run and an audit record.

A job is one pass over its rows: the gate's verdicts are written to the shared
checkpoint folder under an ``Observation``, which yields the counts of every
market, and go on from there; no second scan counts.  Each run appends one
record to the audit table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import cut_lineage
from ..sinks import writers as K
from . import gate as G

SUCCESS, PARTIAL_SUCCESS, FAILED, SKIPPED_HOLIDAY = "SUCCESS", "PARTIAL_SUCCESS", "FAILED", "SKIPPED_HOLIDAY"
MARKETS = ("india", "us")


def bars_job(spark: SparkSession, rows: DataFrame, universe: DataFrame, run_date: str, is_trading_day: bool, run_id: str,
             bronze_path: str, audit_path: str, asof=None, dry_run: bool = False, job_id: str = "J01") -> dict:
    """Gate ``rows`` (the bars of the run) into bronze and record the run.

    Status: SKIPPED_HOLIDAY outside trading days (nothing is read), FAILED if
    the write raised or no row passed, PARTIAL_SUCCESS if a row was rejected or
    a symbol of the universe has no passing row, else SUCCESS.  Metrics, per
    market: rows_passed, rows_rejected, symbols_expected, symbols_passed,
    symbols_failed.  A dry run does everything but the bronze write, and is
    marked in the metrics; a failure is recorded, then raised."""
    if not is_trading_day:
        return _record(spark, audit_path, job_id, run_id, SKIPPED_HOLIDAY, run_date, {"dry_run": dry_run})
    listed = universe.select("symbol").distinct().withColumn("market_context", X.market_context("symbol"))
    seen = Observation()
    verdict = G.verdicts(rows, universe, asof or run_date).withColumn("market_context", X.market_context("symbol"))
    counts = [f(F.col("market_context") == m).alias(f"{n}_{m}") for m in MARKETS for n, f in (
        ("rows_passed", lambda c: F.count_if(c & F.col("g0_pass"))), ("rows_rejected", lambda c: F.count_if(c & ~F.col("g0_pass"))))]
    try:
        judged = cut_lineage(verdict.observe(seen, *counts))
        metrics = dict(seen.get)
        passed = judged.filter("g0_pass").select(*rows.columns, "market_context")
        if not dry_run:
            K.write_bronze(passed.withColumn("run_date", F.lit(run_date)), bronze_path, ("market_context", "run_date"))
        have = passed.select("symbol")
        per_market = listed.join(have.distinct().withColumn("__has", F.lit(True)), "symbol", "left").agg(
            *[f(F.col("market_context") == m).alias(f"{n}_{m}") for m in MARKETS for n, f in (
                ("symbols_expected", F.count_if), ("symbols_passed", lambda c: F.count_if(c & F.col("__has"))))]).first().asDict()
    except Exception as e:
        _record(spark, audit_path, job_id, run_id, FAILED, run_date, {"dry_run": dry_run}, str(e)[:500])
        raise
    metrics |= per_market | {f"symbols_failed_{m}": per_market[f"symbols_expected_{m}"] - per_market[f"symbols_passed_{m}"] for m in MARKETS}
    metrics["dry_run"] = dry_run
    total = lambda n: sum(metrics[f"{n}_{m}"] for m in MARKETS)
    status = (FAILED if not total("rows_passed") else PARTIAL_SUCCESS if total("rows_rejected") or total("symbols_failed") else SUCCESS)
    return _record(spark, audit_path, job_id, run_id, status, run_date, metrics)


def _record(spark: SparkSession, path: str, job_id: str, run_id: str, status: str, run_date: str, metrics: dict,
            error: str | None = None) -> dict:
    row = K.job_audit_row(job_id, run_id, status, metrics, error, run_date)
    K.append_audit(spark, [row], path)
    return row


def run_metrics(audit: DataFrame, names: list[str]) -> DataFrame:
    """Job records with the named metrics as columns (NULL where a run has none)."""
    return audit.filter(F.col("job_id").isNotNull()).select(
        "job_id", "run_id", "job_date", "status", "error_message",
        *[F.get_json_object("metrics", f"$.{n}").cast("long").alias(n) for n in names])


def status_counts(audit: DataFrame) -> DataFrame:
    """Runs of each job by status."""
    return audit.filter(F.col("job_id").isNotNull()).groupBy("job_id", "status").agg(F.count(F.lit(1)).alias("runs"))
