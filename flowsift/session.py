"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "flowsift") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    # Tasks share the cores already; clusters set this themselves.
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.extraJavaOptions", "-Dderby.system.home=/tmp")
        .config(SCRATCH_CONF, tempfile.mkdtemp(prefix="flowsift-"))
        .getOrCreate()
    )


def landed(df: DataFrame, name: str) -> DataFrame:
    """Written to the scratch folder and read back: for what several steps read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder name in the shared folder the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get(SCRATCH_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {SCRATCH_CONF} to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowsift-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
