"""G0 quality gate for raw OHLCV records.

Set based: every row gets a verdict column and an array of reject reasons in
one projection; per-batch missing-field ratios come from one partial
aggregate joined back on the batch key (one row per batch, so AQE turns the
join into a broadcast at run time).  De-duplication keeps the first passing
row per (symbol, date) with ``min_by`` - a partial aggregate, so a hot key is
combined on the map side instead of being sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values of the gate ---------------------------------------------
MANDATORY_FIELDS = ("symbol", "date", "open", "high", "low", "close", "volume")
PRICE_FIELDS = ("open", "high", "low", "close")
MISSING_FIELD_RATIO_THRESHOLD = 0.05
STATUS_PASS, STATUS_PARTIAL, STATUS_FAIL = "PASS", "PARTIAL", "FAIL"
# reject reason codes
R_MISSING = "missing_field"
R_PRICE = "non_positive_price"
R_VOLUME = "negative_volume"
R_RANGE = "high_below_low"
R_DATE = "bad_or_future_date"
R_UNIVERSE = "not_in_universe"
R_BATCH = "batch_missing_ratio"
# ---------------------------------------------------------------------------


class GateError(ValueError):
    """The whole batch is rejected (Q01)."""


def _lit_date(asof) -> Column:
    if isinstance(asof, Column):
        return asof.cast("date")
    return F.lit(str(asof)).cast("date")


def future_cutoff(asof) -> Column:
    """Q05: the next weekday strictly after ``asof`` (Fri/Sat/Sun -> Monday)."""
    a = _lit_date(asof)
    dow = F.dayofweek(a)  # 1 = Sunday ... 7 = Saturday
    return F.date_add(a, F.when(dow == 6, 3).when(dow == 7, 2).otherwise(1))


def parsed_date(df: DataFrame, c: str = "date") -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, T.DateType):
        return F.col(c)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.col(c).cast("date")
    return F.trim(F.col(c).cast("string")).try_cast("date")


def present_value(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL: a NaN is a missing value for every rule."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
    return F.col(c)


def any_mandatory_null(df: DataFrame) -> Column:
    present = [c for c in MANDATORY_FIELDS if c in df.columns]
    if not present:
        raise GateError("the batch has none of the mandatory columns")
    return reduce(lambda a, b: a | b, [present_value(df, c).isNull() for c in present])


def row_reasons(df: DataFrame, asof, in_universe: Column) -> Column:
    """Q02-Q06: array of failed rule codes (empty when the row passes)."""
    cols = set(df.columns)

    def rule(ok: Column, code: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(code))

    checks = []
    value = {c: present_value(df, c) for c in MANDATORY_FIELDS if c in cols}
    mand = [value[c].isNotNull() if c in cols else F.lit(False) for c in MANDATORY_FIELDS]
    checks.append(rule(reduce(lambda a, b: a & b, mand), R_MISSING))
    prices = [value[c] > 0 for c in PRICE_FIELDS if c in cols]
    if prices:
        checks.append(rule(reduce(lambda a, b: a & b, prices), R_PRICE))
    if "volume" in cols:
        checks.append(rule(value["volume"] >= 0, R_VOLUME))
    if "high" in cols and "low" in cols:
        checks.append(rule(value["high"] >= value["low"], R_RANGE))
    if "date" in cols:
        d = parsed_date(df)
        checks.append(rule(d.isNotNull() & (d <= future_cutoff(asof)), R_DATE))
    if "symbol" in cols:
        checks.append(rule(in_universe, R_UNIVERSE))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def _flag_universe(df: DataFrame, universe: DataFrame | None, symbol_col="symbol") -> DataFrame:
    if universe is None:
        return df.withColumn("__in_u", F.lit(True))
    u = universe.select(F.col(symbol_col).alias("__u_sym")).distinct().withColumn("__in_u", F.lit(True))
    return (df.join(u, df[symbol_col] == u["__u_sym"], "left").drop("__u_sym")
            .withColumn("__in_u", F.coalesce(F.col("__in_u"), F.lit(False))))


def verdicts(df: DataFrame, universe: DataFrame | None, asof, batch_cols: list[str] | None = None,
             threshold: float = MISSING_FIELD_RATIO_THRESHOLD) -> DataFrame:
    """Add ``g0_reasons`` (array), ``g0_pass`` and ``g0_batch_ratio``.

    With ``batch_cols`` every batch (for example each landing date) is gated
    on its own missing-field ratio; a batch above ``threshold`` rejects all
    its rows with reason ``batch_missing_ratio``.
    """
    nulls = any_mandatory_null(df)
    base = _flag_universe(df, universe)
    reasons = row_reasons(df, asof, F.col("__in_u"))
    out = base.withColumn("g0_reasons", reasons).drop("__in_u")
    if batch_cols:
        ratio = (df.groupBy(*[F.col(c).alias(f"__b_{c}") for c in batch_cols])
                 .agg(F.avg(nulls.cast("double")).alias("g0_batch_ratio")))
        cond = reduce(lambda a, b: a & b, [out[c].eqNullSafe(ratio[f"__b_{c}"]) for c in batch_cols])
        out = out.join(ratio, cond, "left").drop(*[f"__b_{c}" for c in batch_cols])
        failed = F.col("g0_batch_ratio") > threshold
        out = out.withColumn("g0_reasons", F.when(failed, F.array_union(F.array(F.lit(R_BATCH)),
                                                                         F.col("g0_reasons")))
                             .otherwise(F.col("g0_reasons")))
    return out.withColumn("g0_pass", F.size("g0_reasons") == 0)


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (partial aggregate)."""
    payload = [c for c in df.columns]
    agg = (df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
           .agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("__r")))
    return agg.select("__r.*")


def passing_rows(verdict_df: DataFrame, order: list[str]) -> DataFrame:
    """Passing rows, de-duplicated on (symbol, parsed date)."""
    p = verdict_df.filter("g0_pass").withColumn("__d", parsed_date(verdict_df))
    keep = [c for c in verdict_df.columns if not c.startswith("g0_")]
    out = dedup_first(p.select(*keep, "__d"), ["symbol", "__d"], order)
    return out.drop("__d")


def rejected_rows(verdict_df: DataFrame) -> DataFrame:
    """Rejected rows with their reasons (what goes to quarantine)."""
    keep = [c for c in verdict_df.columns if c not in ("g0_pass", "g0_batch_ratio")]
    return verdict_df.filter(~F.col("g0_pass")).select(*keep)


def audit_by_batch(verdict_df: DataFrame, batch_cols: list[str], order: list[str]) -> DataFrame:
    """One audit row per batch.

    ``pass_count`` is after de-duplication (dropped duplicates are counted in
    ``duplicate_count``, T17); the status uses the count before it.
    """
    keyed = verdict_df.withColumn("__d", parsed_date(verdict_df))
    per_key = keyed.groupBy(*batch_cols, "symbol", "__d").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("g0_pass")).alias("good"),
        F.max(F.array_contains("g0_reasons", R_BATCH)).alias("failed"))
    # a key with a passing row has one row after de-duplication; a passing row has both key columns
    out = per_key.groupBy(*batch_cols).agg(
        F.sum("rows").alias("input_count"), F.sum("good").alias("pre_dedup_pass"),
        F.sum(F.col("rows") - F.col("good")).alias("reject_count"),
        F.count_if(F.col("good") > 0).alias("pass_count"), F.max("failed").alias("batch_failed"))
    status = (F.when(F.col("batch_failed"), F.lit(STATUS_FAIL))
              .when(F.col("reject_count") == 0, F.lit(STATUS_PASS))
              .when(F.col("pre_dedup_pass") > 0, F.lit(STATUS_PARTIAL))
              .otherwise(F.lit(STATUS_FAIL)))
    return out.select(*batch_cols, "input_count", F.col("pass_count").cast("long").alias("pass_count"),
                      "reject_count", (F.col("pre_dedup_pass") - F.col("pass_count")).alias("duplicate_count"),
                      status.alias("status"))


# ---------------------------------------------------------------------------
# one landing batch with its side effects (quarantine, audit)
# ---------------------------------------------------------------------------

@dataclass
class GateResult:
    passed: DataFrame
    audit: dict
    quarantine_path: str


def run(spark: SparkSession, df: DataFrame, source: str, run_date: str, universe: DataFrame | None,
        quarantine_root: str | None = None, audit_path: str | None = None, asof=None,
        order: list[str] | None = None, run_id: str | None = None) -> GateResult:
    """Gate one landing batch and append its audit row.

    The rows are judged and written once, to the shared checkpoint folder;
    an ``Observation`` on that pass yields all counts, so nothing is scanned
    for counting.  A batch with too many missing fields raises ``GateError``
    after its audit row; its rows are not passed on.
    """
    import uuid

    from pyspark.sql import Observation

    from ..session import cut_lineage
    from ..sinks.writers import append_audit, audit_row, write_quarantine

    def record(**counts) -> dict:
        row = audit_row("G0", run_id or str(uuid.uuid4()), source=source, date=run_date, **counts)
        if audit_path:
            append_audit(spark, [row], audit_path)
        return row

    where = f"source {source}, run date {run_date}"
    if not set(MANDATORY_FIELDS) & set(df.columns):
        record(status=STATUS_FAIL)
        raise GateError(f"batch rejected, it has no mandatory column ({where})")
    seen = Observation()
    missing = any_mandatory_null(df)
    judged = verdicts(df.withColumn("__missing", missing), universe, asof or run_date).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("__missing").alias("missing"),
        F.count_if("g0_pass").alias("good"))
    judged = cut_lineage(judged).drop("__missing")
    counts = seen.get
    rows, good = counts["rows"], counts["good"]
    share = counts["missing"] / rows if rows else 0.0
    if share > MISSING_FIELD_RATIO_THRESHOLD:
        record(status=STATUS_FAIL, input_count=rows, reject_count=rows)
        raise GateError(f"batch rejected, missing-field ratio {share:.1%} is above the limit of "
                        f"{MISSING_FIELD_RATIO_THRESHOLD:.0%} ({where})")
    rejects = rows - good
    kept = Observation()
    passed = cut_lineage(passing_rows(judged, order or list(df.columns)).observe(kept, F.count(F.lit(1)).alias("rows")))
    folder = write_quarantine(rejected_rows(judged), quarantine_root, run_date, source) if rejects and quarantine_root else ""
    status = STATUS_FAIL if rejects and not good else STATUS_PARTIAL if rejects else STATUS_PASS
    return GateResult(passed, record(status=status, input_count=rows, pass_count=kept.get["rows"], reject_count=rejects,
                                     quarantine_path=folder), folder)


# ---------------------------------------------------------------------------
# Q09 / Q10 contracts
# ---------------------------------------------------------------------------

def schema_check(df: DataFrame, contract: T.StructType) -> list[dict]:
    """Q09: differences between a frame's schema and a contract (metadata only)."""
    have = {f.name: f for f in df.schema.fields}
    issues = []
    for f in contract.fields:
        if f.name not in have:
            if not f.nullable:
                issues.append({"column": f.name, "issue": "missing", "expected": f.dataType.simpleString(),
                               "actual": None})
            continue
        got = have[f.name].dataType
        if got != f.dataType:
            issues.append({"column": f.name, "issue": "type", "expected": f.dataType.simpleString(),
                           "actual": got.simpleString()})
    return issues


def contract_violations(rules: dict[str, Column]) -> Column:
    """Q10: array of violated rule names, from name -> boolean 'ok' expression."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]),
                    lambda x: x.isNotNull())


CAP_TIERS = ("large", "mid", "small", "unknown")
DIRECTIONS = (0, 1)


def audit_contract_rules() -> dict[str, Column]:
    """Q10: an audit record has one of the three statuses and counts that add up."""
    return {
        "status_enum": F.col("status").isin(STATUS_PASS, STATUS_PARTIAL, STATUS_FAIL),
        "counts_add_up": F.col("input_count") == F.col("pass_count") + F.col("reject_count") + F.col("duplicate_count"),
    }


def standard_contract_rules() -> dict[str, Column]:
    return {
        "cap_tier_enum": F.col("cap_tier").isin(*CAP_TIERS),
        "direction_enum": F.col("target_direction_5d").isin(*DIRECTIONS) | F.col("target_direction_5d").isNull(),
    }
