"""Class weights, label indexes and standardisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.text import encode_label
from flowsift.operators.numbering import numbered
from flowsift.operators.small import pin_small, unpivot_row
from flowsift.spec import DEFAULT_SPEC, FlowSpec


def project_xy(df: DataFrame, features: list[str], label: str, keep: list[str] = ()) -> DataFrame:
    """Features, the label as `y`, and any columns to keep."""
    cols = [F.col(f"`{c}`") for c in [*keep, *features]]
    return df.select(*cols, F.col(f"`{label}`").alias("y"))


def encode_binary(df: DataFrame, label: str, out: str = "y") -> DataFrame:
    return df.withColumn(out, encode_label(F.col(f"`{label}`")))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Label and its index in sorted order, one row per label."""
    c = F.col(f"`{label}`")
    labels = df.where(c.isNotNull()).select(c.alias("class")).distinct()
    return numbered(labels, ["class"], "index").withColumn("index", F.col("index").cast("int"))


def index_labels(df: DataFrame, label: str, out: str = "y") -> DataFrame:
    """Add the index of the label among the sorted labels; NULL labels stay NULL."""
    table, _ = pin_small(label_index(df, label).withColumnsRenamed({"class": "_c", "index": out}))
    return df.join(table, F.col(f"`{label}`") == F.col("_c"), "left").drop("_c")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of every class: rows / (classes * rows of the class)."""
    c = F.col(f"`{label}`")
    counts = df.groupBy(c.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (k * F.col("n")).cast("double"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    table, _ = pin_small(
        class_weights(df, label).select(F.col("class").alias("_c"), F.col("weight").alias(out))
    )
    return df.join(table, F.col(f"`{label}`").eqNullSafe(F.col("_c")), "left").drop("_c")


@dataclass(frozen=True)
class Scaling:
    """Mean and standard deviation per feature, fitted on one table."""

    features: list[str]
    mean: list[float]
    std: list[float]

    def column(self, feature: str, of: Column | None = None) -> Column:
        """Scaled value; a constant feature becomes 0."""
        i = self.features.index(feature)
        c = F.col(f"`{feature}`") if of is None else of
        if not self.std[i]:
            return F.when(c.isNotNull(), F.lit(0.0))
        return (c - F.lit(self.mean[i])) / F.lit(self.std[i])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f: self.column(f) for f in self.features})


def fit_scaling(df: DataFrame, features: list[str], population: bool = True) -> Scaling:
    """One aggregate over the training rows. Fit on train rows only."""
    std = F.stddev_pop if population else F.stddev_samp
    row = df.agg(
        *[F.avg(f"`{f}`").alias(f"m{i}") for i, f in enumerate(features)],
        *[std(f"`{f}`").alias(f"s{i}") for i, f in enumerate(features)],
    ).first()
    k = len(features)
    return Scaling(list(features), list(row[:k]), list(row[k:]))


def cell_variance(df: DataFrame, features: list[str]) -> DataFrame:
    """Population variance of all feature cells taken together, and gamma "scale"."""
    parts = {"n": F.count, "mean": F.avg, "var": F.var_pop}
    row = df.agg(*[
        fn(f"`{f}`").alias(f"{k}{i}") for i, f in enumerate(features) for k, fn in parts.items()
    ])
    cols = {k: [F.col(f"{k}{i}") for i in range(len(features))] for k in parts}
    cells = unpivot_row(row, cols, features)
    n, mean = F.col("n").cast("double"), F.col("mean")
    total = F.sum(n)
    within, centre = F.sum(n * F.col("var")), F.sum(n * mean) / total
    between = F.sum(n * mean * mean) - total * centre * centre
    variance = (within + between) / total
    gamma = F.when(variance > 0, 1.0 / (F.lit(float(len(features))) * variance)).otherwise(1.0)
    return cells.agg(variance.alias("variance"), gamma.alias("gamma_scale"))


def feature_inventory(df_or_spark, resolved: list[str], spec: FlowSpec = DEFAULT_SPEC) -> DataFrame:
    """Every feature of the spec with its status and description."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    rows = [
        (f, "Available" if f in resolved else "Missing", spec.notes.get(f, ""))
        for f in spec.features
    ]
    return spark.createDataFrame(rows, "feature string, status string, description string")
