"""Session helpers: where shared intermediate data lives and how lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without the setting (tests) gets a temporary folder; on a cluster the
    setting is required, because a machine-local folder is lost with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of any executor."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder as parquet and read it back.

    Used between steps whose output is read several times, so that the work before it runs once
    and the next scan gets column pruning and file statistics.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "stage", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete the files of staged tables whose every reader has been written itself."""
    for df in staged:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)
