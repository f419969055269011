"""Columns of a user's table whose names an operator needs for its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """docs with the columns of these names (in letters of any case) under other ones, and what
    selects all columns as they were."""
    wanted = {n.lower() for n in names}
    other = {}
    for i, c in enumerate(docs.columns):
        if c.lower() in wanted:
            new = f"_own{i}"
            while new in docs.columns:
                new = f"_{new}"
            other[c] = new
    return docs.withColumnsRenamed(other), [F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns]


def with_chars(docs: DataFrame, changed: Column) -> DataFrame:
    """docs with n_chars counted anew where the text has changed; a table without n_chars stays so."""
    if "n_chars" not in docs.columns:
        return docs
    chars = F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
