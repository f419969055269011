"""Joins with a table of one row per key, where one key may hold a third of the other side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is heavy, so there are fewer heavy keys than this.
PART = 1000


def heavy_keys(one: DataFrame, n: str, total: int | None = None) -> DataFrame:
    """Rows of `one` whose key has more than a PART-th of all rows, marked for broadcast: PART - 1
    at most. `n` is the column with a key's number of rows on the other side."""
    if total is None:
        total = one.agg(F.sum(n)).first()[0] or 0
    return F.broadcast(one.where(F.col(n) * PART > F.lit(total)))


def join_by_key(rows: DataFrame, one: DataFrame, key: str | list[str], n: str, total: int | None = None) -> DataFrame:
    """rows with the columns of `one` but n; rows without a partner go. Heavy keys do not move: their
    few rows of `one` are broadcast; all others meet in a shuffle. Both sides are read twice, so
    they should be landed."""
    keys = [key] if isinstance(key, str) else key
    heavy = heavy_keys(one, n, total)
    light = rows.join(heavy.select(*keys), keys, "left_anti").join(one.drop(n).hint("merge"), keys)
    return light.unionByName(rows.join(heavy.drop(n), keys))
