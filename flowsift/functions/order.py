"""Random order and noise that depend on the row key only, never on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

HEX_DIGITS = 13  # 52 bits, exact in a double
UNIT = float(16**HEX_DIGITS)


def order_hash(seed, *key: Column) -> Column:
    """32 hex digits; sorting by it is a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))


def value_text(df: DataFrame, name: str) -> Column:
    """A value as text: doubles as their whole part and nine places, as far as whole numbers hold
    them, so that the text does not depend on how an engine prints a double."""
    c = F.col(f"`{name}`")
    if not isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.cast("string")
    whole = F.floor(c)
    places = F.floor((c - whole.cast("double")) * F.lit(1e9) + F.lit(0.5))
    text = F.concat(whole.cast("string"), F.lit("."), places.cast("string"))
    return F.when(F.abs(c) < F.lit(1e15), text).otherwise(c.cast("string"))


def row_text(df: DataFrame, columns: list[str]) -> Column:
    """Values with their lengths, NULL as a dash: different rows give different texts."""
    parts = [value_text(df, c) for c in columns]
    return F.concat_ws("|", *[
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def content_key(df: DataFrame, columns: list[str]) -> Column:
    """Key of a row made from its values alone: the same wherever and in whatever order it stands."""
    return F.md5(row_text(df, columns))


def _unit(hash_col: Column, start: int) -> Column:
    digits = F.conv(F.substring(hash_col, start, HEX_DIGITS), 16, 10)
    return digits.cast("bigint").cast("double")


def gaussian(hash_col: Column) -> Column:
    """Standard normal value of a hash (Box and Muller 1958)."""
    u1 = (_unit(hash_col, 1) + 1.0) / UNIT
    u2 = _unit(hash_col, 1 + HEX_DIGITS) / UNIT
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
