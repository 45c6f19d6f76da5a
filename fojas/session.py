"""Session settings and the one way by which this library cuts lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and bench on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fojas")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir of the session. Where it is unset, one-machine runs take a temporary folder, removed at the end; a cluster must name a shared one.

    Spark removes a checkpoint once nothing refers to it if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fojas-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share, for files that a query writes and reads again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/files"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there: survives lost executors, computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """The rows of a plan that already shuffles, over as many partitions as costly work on them can use: they are few and light, the work on each is not."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def spread(df: DataFrame) -> DataFrame:
    """df (a scan or a checkpoint, as counting its partitions would run a shuffle) over at least as many partitions as there are cores, for costly work on a few small files; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
