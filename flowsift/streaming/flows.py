"""Scoring, validation and drift monitoring on streams.

Scoring and validation are the batch operators: they are narrow, so a streaming
DataFrame goes through them as it is. This module adds the sinks and the windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowsift.functions.numeric import percent_of
from flowsift.operators.scoring import score_rows, validate_records
from flowsift.operators.small import pin_small
from flowsift.sources import artifacts


def stream_scores(
    stream: DataFrame, features: list[str], score: Column, threshold: float = 0.0
) -> DataFrame:
    return score_rows(stream, features, score, threshold)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a Parquet folder, exactly once over restarts."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def publish_model(spark: SparkSession, manifest: str, version: str, path: str) -> str:
    """Name the saved model that streams are to score with from their next batch on."""
    return artifacts.save_metadata(spark, {"version": version, "path": path}, manifest)


def score_with_published(
    stream: DataFrame, manifest: str, load: Callable[[SparkSession, str], object],
    score: Callable[[DataFrame, object], DataFrame], path: str, checkpoint: str,
) -> StreamingQuery:
    """Score a stream with a fitted model. Each batch looks into the manifest, so a newer model is
    taken up between batches; `model_version` says which one scored a row. A repeated batch
    overwrites its own folder."""
    held: dict[str, object] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = artifacts.load_metadata(spark, manifest)
        if not named:
            raise FileNotFoundError(f"{manifest} names no model")
        if named["path"] not in held:
            held.clear()
            held[named["path"]] = load(spark, named["path"])
        scored = score(batch, held[named["path"]]).withColumn("model_version", F.lit(named["version"]))
        scored.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def split_records(
    stream: DataFrame, record: str, required: list[str], valid_path: str, quarantine_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Valid records to one sink, all others with the reasons to another.

    Each batch overwrites its own folder, so a repeated batch leaves no copies.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate_records(batch, record, required).persist()
        try:
            for path, rows in (
                (valid_path, checked.where("is_valid")),
                (quarantine_path, checked.where("not is_valid")),
            ):
                rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            checked.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_statistics(
    df: DataFrame, features: list[str], ts: str, width: str = "1 day", lateness: str | None = None
) -> DataFrame:
    """Count, mean and std of every feature per time window.

    On a stream, `lateness` bounds the state: rows later than that are left out.
    """
    timed = df.withWatermark(ts, lateness) if lateness else df
    aggs = []
    for i, f in enumerate(features):
        c = F.col(f"`{f}`")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    wide = timed.groupBy(F.window(ts, width).alias("w")).agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, f in enumerate(features)
    ]))
    return wide.select(F.col("w.start").alias("window_start"), rows)


def against_baseline(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Change of window mean and std in percent of the baseline std, per feature.

    baseline has one row per feature: feature, mean, std.
    """
    table, _ = pin_small(baseline.select(
        "feature", F.col("mean").alias("base_mean"), F.col("std").alias("base_std")))
    change = lambda c: percent_of(
        F.abs(F.col(c) - F.col(f"base_{c}")), F.col("base_std"))
    return stats.join(table, "feature").select(
        "window_start", "feature", "n", "mean", "std",
        change("mean").alias("mean_change_pct"), change("std").alias("std_change_pct"))


def write_versions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Every changed row of an aggregate, by batch; read_latest picks the newest."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every key."""
    versions = spark.read.parquet(path)
    values = [c for c in versions.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch")
    return versions.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")
