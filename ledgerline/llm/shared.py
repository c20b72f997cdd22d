"""Session helpers of the subpackage: shipped code, shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root, ensure_checkpoint_dir

#: Rows per Arrow batch: texts are long, so far fewer than Spark's default.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings of every operator here, and the package on the executors.

    The package travels as a zip through ``addPyFile`` once per application,
    so Python workers can import it wherever the driver was started."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # joins deal rows by all their keys: one of them (a host, a cluster) may be hot
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_code", None):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._ledgerline_code = target


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the folder that ``spark.checkpoint.dir``
    names, read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/ledgerline-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each lengthened until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out
