"""Result tables and run records as CSV, JSON and a partitioned experiment table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowsift.sources.flow_files import path_exists

RUN_PREFIX = "EXP-"
RUN_SCHEMA = "experiment_id string, kind string, payload string"


def write_csv(df: DataFrame, path: str) -> str:
    """Any table as CSV with a header: sweeps, importances, reports, scored rows."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table; an empty one with the same columns when it does not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> str:
    """Report rows as JSON lines: metrics, summaries, metadata."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines; an empty table when they do not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def record(spark: SparkSession, values: dict) -> DataFrame:
    """A nested record (settings, metrics, run metadata) as one row."""
    text = json.dumps(values, default=str)
    schema = F.schema_of_json(F.lit(text))
    one = spark.range(1).select(F.from_json(F.lit(text), schema).alias("r"))
    return one.select("r.*")


def save_metadata(spark: SparkSession, values: dict, path: str) -> str:
    return write_json(spark.createDataFrame([(json.dumps(values, default=str),)], "meta string"), path)


def load_metadata(spark: SparkSession, path: str) -> dict:
    """The saved record, or {} when there is none."""
    rows = read_json(spark, path, "meta string").collect()
    return json.loads(rows[0]["meta"]) if rows else {}


def _utc(spark: SparkSession, form: str) -> str:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return spark.range(1).select(F.date_format(now, form)).first()[0]


def utc_now(spark: SparkSession) -> str:
    """Time stamp of a run in UTC."""
    return _utc(spark, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def new_run_id(spark: SparkSession) -> str:
    """EXP-<date>-<time> in UTC."""
    return RUN_PREFIX + _utc(spark, "yyyy-MM-dd-HHmmss")


def save_run(spark: SparkSession, root: str, run_id: str, **parts) -> str:
    """Add the parts of a run (config, metrics, features, ...) to the experiment table."""
    rows = [(run_id, kind, json.dumps(v, default=str)) for kind, v in parts.items()]
    append_runs(spark.createDataFrame(rows, RUN_SCHEMA), root)
    return run_id


def append_runs(parts: DataFrame, root: str) -> str:
    """Add rows (experiment_id, kind, payload) to the experiment table. A part of a run that is
    there already stays as it is, so a repeated append changes nothing."""
    if path_exists(parts.sparkSession, root):
        there = parts.sparkSession.read.schema(RUN_SCHEMA).parquet(root).select("experiment_id", "kind")
        parts = parts.join(there, ["experiment_id", "kind"], "left_anti")
    parts.repartition("experiment_id").write.mode("append").partitionBy("experiment_id").parquet(root)
    return root


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs by id with their config and metrics as JSON text; a missing part is NULL."""
    if path_exists(spark, root):
        runs = spark.read.schema(RUN_SCHEMA).parquet(root)
    else:
        runs = spark.createDataFrame([], RUN_SCHEMA)
    part = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("payload")))
    return (
        runs.where(F.col("experiment_id").startswith(RUN_PREFIX))
        .groupBy("experiment_id")
        .agg(*[part(k).alias(k) for k in ("config", "metrics", "features")])
        .orderBy("experiment_id")
    )


class Stages:
    """What a run has finished. A stage leaves its result, a small record, beside its tables when it
    is done; a rerun takes the record and skips the stage. A stage that was cut short runs again
    and has to overwrite what it left."""

    def __init__(self, spark: SparkSession, home: str) -> None:
        self.spark, self.home = spark, f"{home}/stages"

    def run(self, name: str, work: Callable[[], object]):
        saved = load_metadata(self.spark, f"{self.home}/{name}")
        if not saved:
            save_metadata(self.spark, {"value": work()}, f"{self.home}/{name}")
            saved = load_metadata(self.spark, f"{self.home}/{name}")
        return saved["value"]
