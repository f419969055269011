"""Counts taken by the job that writes a table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation


def write_observed(
    df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None
) -> tuple[DataFrame, dict]:
    """Write a table, aggregate its rows on the way, read it back: (table, aggregates by name).

    The rows are counted in the stage that writes them, where a repeated task counts once.
    """
    seen = Observation(f"written-{uuid.uuid4().hex}")
    observed = df.observe(seen, *[c.alias(k) for k, c in metrics.items()])
    observed.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
