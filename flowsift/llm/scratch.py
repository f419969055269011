"""Intermediate tables in the shared folder the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FOLDER_CONF = "spark.checkpoint.dir"
#: Drops the shuffle files of a finished query; what is landed needs them no more.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where it is unset on one machine."""
    root = spark.conf.get(FOLDER_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {FOLDER_CONF} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowsift-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


@contextmanager
def _cleaned_shuffles(spark: SparkSession):
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def land(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors cost no rerun of it. With
    `by` it is written in a folder per value, so that a filter on it reads only its part."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with _cleaned_shuffles(spark):
        df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete landed tables that no later result reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
