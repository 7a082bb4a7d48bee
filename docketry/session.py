"""Session settings and the shared folder used for checkpoints and work tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SPREAD_SPLITS = 32


def local_session(name: str = "docketry", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a table written by one job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame) -> DataFrame:
    """Even out a scan that comes in fewer splits than there are cores, such as a file of
    one row group. A scan of SPREAD_SPLITS or more is never moved, so on a large cluster
    no more than that many splits are shuffled. For heavy work per row only."""
    cores = min(scan.sparkSession.sparkContext.defaultParallelism, SPREAD_SPLITS)
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
