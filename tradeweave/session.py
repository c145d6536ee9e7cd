"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName("tradeweave")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradeweave-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Staged copies are of no use after the application; the file system drops them when the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def stage(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage for loops and shares a result between several uses. The copy survives the loss of any
    executor, is columnar (later readers prune it) and carries a size the optimizer can check.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    forget_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def concurrently(jobs: Sequence[Callable[[], object]]) -> list:
    """Results of independent jobs, run side by side: one of many small rounds leaves most cores idle on its own."""
    session = SparkSession.active()  # also inside a job that runs side by side with others
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(session)(job)) for job in jobs]]
