"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from flowsift.functions.text import strip

# Plain decimal numbers and the infinity words. The cast alone would also take
# Java forms such as 1.5d. The end is the text's own: `$` would let a line break follow.
NUMBER = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\z"
NOT_A_NUMBER = r"^[+-]?(?i:nan)$"
INF = float("inf")
EPSILON = 1e-10  # fixed value: keeps percentage changes finite


def to_number(c: Column, dtype: DataType | None = None) -> Column:
    """Double value of a text or number; NULL for anything else, NaN included."""
    if isinstance(dtype, NumericType):
        return nan_to_null(c.cast("double"))
    if dtype is not None and not isinstance(dtype, StringType):
        return F.lit(None).cast("double")
    # Stripping costs several times what the pattern does, and few texts need it.
    return F.coalesce(_read(c), _read(strip(c)))


def _read(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def with_numbers(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, Column], str]:
    """Every column's to_number, the table they are taken from, and its side column, to be dropped after use.

    One function reads the texts of a row as an array. Written out for each column, the code that Spark
    generates is too long to be compiled, and takes several times as long.
    """
    types = {c: df.schema[c].dataType for c in names}
    texts = [c for c in names if isinstance(types[c], StringType)]
    side = "_numbers"
    while side in (c.lower() for c in df.columns):
        side += "_"
    if texts:
        df = df.withColumn(side, F.transform(F.array(*[F.col(f"`{c}`") for c in texts]), lambda c: to_number(c)))
    return df, {c: F.col(side)[texts.index(c)] if c in texts else to_number(F.col(f"`{c}`"), types[c])
                for c in names}, side


def is_number_text(c: Column) -> Column:
    """True when a text reads as a float, NaN and infinity words included."""
    text = strip(c)
    return text.rlike(NUMBER) | text.rlike(NOT_A_NUMBER)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(INF), F.lit(False))


def finite(c: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(F.abs(c) < F.lit(INF), c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.when(b != 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def percent_of(change: Column, base: Column) -> Column:
    """Change in percent of a base that may be 0."""
    return change / (base + F.lit(EPSILON)) * 100.0


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2.0 * precision * recall, precision + recall)


def threshold_grid(lo: float = -3.0, hi: float = 3.0, n: int = 61) -> list[float]:
    """n evenly spaced thresholds, four decimals."""
    return [round(lo + i * (hi - lo) / (n - 1), 4) for i in range(n)]


def display(c: Column, digits: int | None) -> Column:
    """Rounded for a report when digits are asked for."""
    return c if digits is None else F.round(c, digits)
