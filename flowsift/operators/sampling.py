"""Stratified sampling, splitting and folds with exact sizes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.order import order_hash
from flowsift.operators.slicing import CLASS, slice_rows
from flowsift.spec import CV_FOLDS, SEED, TEST_SIZE


def _all_classes() -> Window:
    """Window over the class table, which has one row per class."""
    return Window.partitionBy(F.lit(0))


def stratified_sample(
    df: DataFrame, size: int, label: str, key: list[str], seed: int = SEED
) -> DataFrame:
    """Exactly `size` rows, each class by its share and with at least one row.

    Shares are rounded down; rows still missing go to the classes with the largest
    remainders. A table with no more than `size` rows is returned whole. Many tiny
    classes can push the sample above `size`, since every class keeps one row.
    """

    def cuts(totals: DataFrame) -> DataFrame:
        total = F.sum("n").over(_all_classes())
        share = F.col("n") * (F.lit(float(size)) / F.col("total"))
        quota = F.greatest(F.lit(1), F.floor(share)).cast("bigint")
        ranked = (
            totals.withColumn("total", total.cast("double"))
            .withColumn("share", share)
            .withColumn("quota", quota)
            .withColumn("missing", F.lit(size) - F.sum("quota").over(_all_classes()))
            .withColumn("turn", F.row_number().over(
                _all_classes().orderBy((F.col("share") - F.col("quota")).desc(), CLASS)))
        )
        rank = F.col("quota") + (F.col("turn") <= F.col("missing")).cast("bigint")
        rank = F.when(F.col("total") <= size, F.col("n")).otherwise(F.least("n", rank))
        return ranked.select(CLASS, F.lit(0).alias("cut"), rank.alias("rank"))

    by = F.col(label)
    sliced = slice_rows(df, by, order_hash(seed, *_cols(key)), cuts, 1, "_slice", size)
    return sliced.where(F.col("_slice") == 0).drop("_slice")


def top_n_sample(
    df: DataFrame, n: int, key: list[str], by: str | None = None, seed: int = SEED
) -> DataFrame:
    """At most n random rows of the table, or of each class."""

    def cuts(totals: DataFrame) -> DataFrame:
        rank = F.least(F.col("n"), F.lit(n).cast("bigint"))
        return totals.select(CLASS, F.lit(0).alias("cut"), rank.alias("rank"))

    sliced = slice_rows(df, _class(by), order_hash(seed, *_cols(key)), cuts, 1, "_slice", n)
    return sliced.where(F.col("_slice") == 0).drop("_slice")


def shuffle_rows(df: DataFrame, key: list[str], seed: int = SEED) -> DataFrame:
    """Rows in seeded random order (a range-partitioned sort)."""
    return df.orderBy(order_hash(seed, *_cols(key)))


def train_test_split(
    df: DataFrame,
    key: list[str],
    label: str | None = None,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Add `is_test`. ceil(n * test_size) rows are test rows; a label keeps class shares.

    Train rows are shared out by largest remainder, so every class is within one
    row of its exact share.
    """

    def cuts(totals: DataFrame) -> DataFrame:
        total = F.sum("n").over(_all_classes())
        n_train = F.col("total") - F.ceil(F.col("total").cast("double") * F.lit(test_size))
        exact = F.expr("cast(n as decimal(19,0)) * cast(n_train as decimal(19,0))")
        shared = (
            totals.withColumn("total", total)
            .withColumn("n_train", n_train)
            .withColumn("exact", exact)
            .withColumn("quota", F.expr("exact div total"))
            .withColumn("rest", F.expr("exact % total"))
            .withColumn("missing", F.col("n_train") - F.sum("quota").over(_all_classes()))
            .withColumn("turn", F.row_number().over(
                _all_classes().orderBy(F.col("rest").desc(), CLASS)))
        )
        train = F.col("quota") + (F.col("turn") <= F.col("missing")).cast("bigint")
        return shared.select(CLASS, F.lit(0).alias("cut"), (F.col("n") - train).alias("rank"))

    sliced = slice_rows(df, _class(label), order_hash(seed, *_cols(key)), cuts, 1, "_slice")
    return sliced.withColumn("is_test", F.col("_slice") == 0).drop("_slice")


def assign_folds(
    df: DataFrame, label: str, key: list[str], folds: int = CV_FOLDS, seed: int = SEED
) -> DataFrame:
    """Add `fold`, 0 to folds - 1. Fold sizes differ by one row at most, also per class."""

    def cuts(totals: DataFrame) -> DataFrame:
        # Classes laid end to end, positions dealt out to the folds in turn.
        run = _all_classes().orderBy(CLASS)
        ends = totals.withColumn("hi", F.sum("n").over(run)).withColumn("lo", F.expr("hi - n"))
        dealt = ends.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        mine = F.expr(f"(hi + {folds} - 1 - cut) div {folds} - (lo + {folds} - 1 - cut) div {folds}")
        upto = Window.partitionBy(CLASS).orderBy("cut")
        ranked = dealt.withColumn("rank", F.sum(mine).over(upto))
        return ranked.where(F.col("cut") < folds - 1).select(CLASS, "cut", "rank")

    if folds < 2:
        raise ValueError("folds must be at least 2")
    return slice_rows(df, F.col(label), order_hash(seed, *_cols(key)), cuts, folds - 1, "fold")


def expected_test_rows(n: int, test_size: float = TEST_SIZE) -> int:
    return math.ceil(n * test_size)


def _class(label: str | None) -> Column | None:
    return None if label is None else F.col(label)


def _cols(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]
