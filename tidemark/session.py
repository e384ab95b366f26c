"""Session helpers: a local session for tests and bench, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only where that setting is unset on a local master is a temporary folder made.
    """
    context = spark.sparkContext
    known = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(made)
    return made


def work_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder name of the shared folder, for one run of a job."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_dir(df.sparkSession)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    return df.checkpoint()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of this job's own, wherever Spark can write; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(folder, True)
