"""Sinks K01-K11 and reads R13, R15.

Tables are Parquet folders.  Tables that are appended to (silver, gold) carry
a ``snapshot_id`` partition column, one value per write, so readers of the
newest write read one folder.  Every write is a plain DataFrame write, which
Spark's task retry and output committer protect.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One table for gate and job records; fields that a record lacks are NULL.
AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("job_id", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("input_count", T.LongType()), T.StructField("pass_count", T.LongType()),
    T.StructField("reject_count", T.LongType()), T.StructField("quarantine_path", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("job_date", T.StringType()), T.StructField("metrics", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


def write_bronze(df: DataFrame, path: str, partition_cols=("market_context", "date"), cluster_by: str | None = None) -> str:
    """Parquet (snappy) partitioned by context and date; with
    ``cluster_by`` (K02: symbol) rows of a file are sorted by it, so a reader of
    one symbol skips row groups.

    Dynamic partition overwrite: a rerun for a day replaces that day's
    partitions only.  Rows are clustered by the partition keys first so each
    task writes few files; a partition larger than the advisory size is dealt
    out to several tasks.
    """
    cols = list(partition_cols)
    dealt = df.hint("rebalance", *cols)
    if cluster_by:
        dealt = dealt.sortWithinPartitions(*cols, cluster_by)
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy(*cols).parquet(path))
    return path


def write_landing_raw(df: DataFrame, path: str, fmt: str = "json", date_col: str = "date") -> str:
    """Append raw records under ``date=`` folders as text formats."""
    w = df.write.mode("append").partitionBy(date_col)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "text":
        w.text(path)
    else:
        w.json(path)
    return path


def write_quarantine(rejected: DataFrame, root: str, run_date: str, source: str) -> str:
    """Rejected rows as JSON lines under ``quarantine/date=/source=``; a
    rerun of the day replaces that source's folder."""
    path = f"{root.rstrip('/')}/quarantine/date={run_date}/source={source}"
    rejected.write.mode("overwrite").json(path)
    return path


def append_audit(spark: SparkSession, rows: list[dict], path: str) -> str:
    """Append audit rows (one per run) to a Parquet audit table."""
    df = spark.createDataFrame([tuple(r.get(f.name) for f in AUDIT_SCHEMA.fields) for r in rows], AUDIT_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)
    return path


def audit_row(job_id: str, run_id: str, status: str, source: str | None = None, date: str | None = None,
              input_count: int = 0, pass_count: int = 0, reject_count: int = 0, quarantine_path: str = "") -> dict:
    """The gate's audit record."""
    return {"run_id": run_id, "job_id": job_id, "source": source, "date": date, "input_count": int(input_count),
            "pass_count": int(pass_count), "reject_count": int(reject_count), "quarantine_path": quarantine_path,
            "status": status, "timestamp": datetime.now(timezone.utc).isoformat()}


def job_audit_row(job_id: str, run_id: str, status: str, metrics: dict | None = None,
                  error_message: str | None = None, job_date: str | None = None) -> dict:
    """The job-level audit record (one typed signature, T11)."""
    now = datetime.now(timezone.utc)
    return {"job_date": job_date or now.strftime("%Y-%m-%d"), "job_id": job_id, "run_id": run_id,
            "status": status, "timestamp": now.isoformat(), "metrics": json.dumps(metrics or {}),
            "error_message": error_message}


# ---------------------------------------------------------------------------
# tables of successive writes
# ---------------------------------------------------------------------------

def on_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` projected onto a fixed table schema; missing columns as typed NULLs."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def append_snapshot(df: DataFrame, path: str, schema: T.StructType | None = None) -> int:
    """Append ``df`` under a new ``snapshot_id``; create the table if absent."""
    if schema is not None:
        df = on_schema(df, schema)
    sid = int(datetime.now(timezone.utc).timestamp() * 1_000_000) * 10 + uuid.uuid4().int % 10
    df.withColumn("snapshot_id", F.lit(sid)).write.mode("append").partitionBy("snapshot_id").parquet(path)
    return sid


def overwrite_table(df: DataFrame, path: str) -> int:
    """Full rebuild; the table holds this write alone."""
    sid = int(datetime.now(timezone.utc).timestamp() * 1_000_000) * 10 + uuid.uuid4().int % 10
    (df.withColumn("snapshot_id", F.lit(sid)).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("snapshot_id").parquet(path))
    return sid


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, newest: bool = False) -> DataFrame:
    """All rows of the table, or those of the newest write.

    With ``schema`` no footers are merged: rows of older writes read columns
    added since as NULL (K09).  ``newest`` filters on the partition column,
    so other writes are not read."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("snapshot_id", T.LongType())]))
    data = reader.parquet(path)
    if not newest:
        return data
    return data.where(F.col("snapshot_id") == F.lit(newest_write(spark, path)))


def newest_write(spark: SparkSession, path: str) -> int | None:
    """Largest ``snapshot_id`` of a table, from its folder names alone."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in files]
    return max((int(n.split("=", 1)[1]) for n in names if n.startswith("snapshot_id=")), default=None)


def scan_partitioned(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """A partitioned Parquet folder; partition keys become columns."""
    r = spark.read.option("basePath", base)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(base)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """K06."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union across schema versions; added columns read NULL for old rows."""
    return old.unionByName(new, allowMissingColumns=True)


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Insert-or-replace by key, newest ``order`` wins.

    Rows of one ``order`` value are resolved, too: incoming beats existing,
    then the larger row.  A partial aggregate instead of a window, so a hot
    key is reduced on the map side.
    """
    u = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in u.columns if c != "__new"]
    ranked = F.struct(F.col(order).alias("__o"), "__new", F.struct(*cols).alias("__row"))
    return (u.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys])
            .agg(F.max(ranked).alias("__r")).select("__r.__row.*"))
