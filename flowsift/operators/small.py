"""Small side tables: broadcast behind a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 50_000


def pin_small(df: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, list[dict] | None]:
    """Compute a table that is expected to be small, once.

    Up to max_rows rows come back as a local table marked for broadcast, with
    the rows themselves. A bigger table is handed back lazy and unmarked, with
    None for the rows, so joins with it shuffle.
    """
    got = df.limit(max_rows + 1).toArrow()
    if got.num_rows > max_rows:
        return df, None
    # One partition: further steps on so few rows need no shuffle.
    local = df.sparkSession.createDataFrame(got, df.schema).coalesce(1)
    return F.broadcast(local), got.to_pylist()


def unpivot_row(row: DataFrame, parts: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """One-row table -> one row per name; parts gives each output column's values."""
    structs = [
        F.struct(F.lit(n).alias("name"), *[cols[i].alias(k) for k, cols in parts.items()])
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*structs)))
