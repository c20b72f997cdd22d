"""SparkSession construction and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on.  Time zone is pinned so DATE casts of
# timestamps never depend on the machine running the driver.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # rows of one symbol lie in one partition: joins on (symbol, date) need no other layout
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    app: str = "ledgerline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset and let the launcher decide.  Tests
    pass ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


#: Bytes that one task of a market query reads from its shuffles, line items per
#: shuffle partition before small ones are put together, and bytes of a file that
#: one task reads (and folds into a hash table).
TASK_BYTES, PARTITION_ROWS, SPLIT_BYTES = 8 << 20, 120_000, 32 << 20
#: The JVM never compiles a method of more bytecode; a stage with one runs its
#: operators one by one, which are compiled.
METHOD_BYTES = 8000
_SIZES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
          "spark.sql.files.maxPartitionBytes", "spark.sql.codegen.hugeMethodLimit")


def deal_finely(spark: SparkSession, rows: int) -> None:
    """Partition sizes for queries that sort a symbol's rows many times in one
    stage: their tasks hold some hundred times what they read, so partitions stay
    small and their number follows the ``rows`` of the input."""
    if getattr(spark, "_ledgerline_sizes", None) is None:
        spark._ledgerline_sizes = {key: spark.conf.get(key, None) for key in _SIZES}
    for key, value in zip(_SIZES, (TASK_BYTES, max(200, -(-rows // PARTITION_ROWS)), SPLIT_BYTES, METHOD_BYTES)):
        spark.conf.set(key, str(value))


def deal_as_before(spark: SparkSession) -> None:
    """The partition sizes that held before ``deal_finely``."""
    for key, value in (getattr(spark, "_ledgerline_sizes", None) or {}).items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    spark._ledgerline_sizes = None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; a local master
    without one gets a fresh temporary folder, any other is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    path = checkpoint_root(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ledgerline/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir``.

    Survives executor loss (unlike a local checkpoint): the data lives in
    the shared folder, not on the executors' disks.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Drops the shuffle files of an execution when it ends, not when its plan is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Executions that are planned inside drop their shuffle files when they end.
    For writes: a frame that is run again would have to shuffle again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: several readers share one
    run of its plan, and the compressed columns need far less disk than a
    checkpoint's rows.  The shuffles of that run are dropped."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        root = f"{checkpoint_root(spark).rstrip('/')}/ledgerline/"
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if root in folder:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df`` for the small side of a join: written once, counted, and hinted
    for broadcast only up to ``most_rows``; a larger one is joined by a shuffle."""
    held = cut_lineage(df)
    return F.broadcast(held) if held.limit(most_rows + 1).count() <= most_rows else held
