"""Session settings and the reliable cut of a lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings the operators rely on. All of them can be changed on a
# live session, so a session made by someone else can be tuned as well.
RUNTIME_CONF = {
    # day and week arithmetic is defined on UTC dates
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a task sorts and hashes what it reads of a shuffle, so that is kept small and alike at every size:
    # many partitions, merged to few MB (packed; rows take some ten times that in memory)
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # and what it reads of a file, as scans feed partial aggregates
    "spark.sql.files.maxPartitionBytes": "32m",
    # one patient may hold a large share of the facts: split such partitions
    # even where that costs one more exchange behind the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "cohortspark", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: the checkpoint folder, or one in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage.

    The folder is the one set on the context, or named in ``spark.checkpoint.dir``; where neither
    is, one in the session's warehouse, which executors share as well.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(folder or f"{warehouse}/_checkpoints")
    return df.checkpoint(eager=True)
