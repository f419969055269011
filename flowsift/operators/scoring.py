"""Record validation and batch scoring."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.numeric import finite, is_number_text, to_number, with_numbers
from flowsift.sources.observed import write_observed
from flowsift.spec import ATTACK, BENIGN


class MissingFeatures(ValueError):
    """Required columns are absent."""

    def __init__(self, missing: list[str], available: list[str], required: list[str]):
        super().__init__(f"no column for {len(missing)} of {len(required)} features: {missing}")
        self.missing, self.available, self.required = missing, available, required


def require_columns(df: DataFrame, features: list[str]) -> DataFrame:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise MissingFeatures(missing, df.columns, features)
    return df


def record_map(df: DataFrame, features: list[str]) -> Column:
    """The features of a row as a name -> text map."""
    names = F.array(*[F.lit(f) for f in features])
    return F.map_from_arrays(names, F.array(*[F.col(f"`{f}`").cast("string") for f in features]))


def validate_records(df: DataFrame, record: str, required: list[str]) -> DataFrame:
    """Add missing_features, invalid_features and is_valid for a name -> text map column.

    A feature is invalid when it is there but NULL or not a number.
    """
    m = F.col(record)
    names = F.array(*[F.lit(f) for f in required])
    missing = F.filter(names, lambda f: ~F.map_contains_key(m, f))
    invalid = F.filter(names, lambda f: F.map_contains_key(m, f) & ~F.coalesce(
        is_number_text(F.try_element_at(m, f)), F.lit(False)))
    return df.withColumns({
        "missing_features": missing,
        "invalid_features": invalid,
        "is_valid": (F.size(missing) == 0) & (F.size(invalid) == 0),
    })


def record_columns(df: DataFrame, record: str, features: list[str]) -> DataFrame:
    """Features of a name -> text map as double columns."""
    return df.withColumns({
        f: to_number(F.try_element_at(F.col(record), F.lit(f))) for f in features
    })


def usable_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as finite doubles, anything else NULL."""
    read, numbers, side = with_numbers(df, features)
    # finite is a step of its own, for it takes the number twice.
    ready = read.withColumns(numbers).drop(side)
    return ready.withColumns({f: finite(F.col(f"`{f}`")) for f in features})


def _set_aside(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[Column]]:
    """Usable features under their names, and the input's columns as they were read."""
    held = {f"_raw_{i}": F.col(f"`{f}`") for i, f in enumerate(features)}
    ready = usable_features(require_columns(df, features).withColumns(held), features)
    read = [F.col(f"_raw_{features.index(c)}").alias(c) if c in features else F.col(f"`{c}`")
            for c in df.columns]
    return ready, read


def all_present(features: list[str]) -> Column:
    return reduce(and_, [F.col(f"`{f}`").isNotNull() for f in features])


def class_of(score: Column, threshold: float = 0.0) -> Column:
    """ATTACK above the threshold, BENIGN at or below it, NULL without a score."""
    return F.when(score > F.lit(threshold), ATTACK).when(score.isNotNull(), BENIGN)


def score_rows(
    df: DataFrame, features: list[str], score: Column, threshold: float = 0.0
) -> DataFrame:
    """Add decision_score and prediction to every row; both NULL on rows with an unusable feature.

    The score is a column expression, so the whole step stays in generated code.
    """
    ready, read = _set_aside(df, features)
    scored = ready.withColumn("_score", F.when(all_present(features), score))
    return scored.select(
        *read, F.col("_score").alias("decision_score"),
        class_of(F.col("_score"), threshold).alias("prediction"))


def decision_of(model: PipelineModel) -> Column:
    """Decision score of a transformed row, positive for ATTACK.

    Margin of linear models; P(ATTACK) - 0.5 for forests, which have no margin.
    """
    last = model.stages[-1]
    if type(last).__name__.startswith("RandomForest"):
        return vector_to_array(F.col(last.getProbabilityCol()))[1] - 0.5
    return vector_to_array(F.col(last.getRawPredictionCol()))[1]


def score_with_model(df: DataFrame, model: PipelineModel, features: list[str]) -> DataFrame:
    """score_rows for a fitted MLlib pipeline. All rows are kept."""
    ready, read = _set_aside(df, features)
    filled = ready.withColumn("_valid", all_present(features)).withColumns(
        {f: F.coalesce(F.col(f"`{f}`"), F.lit(0.0)) for f in features})
    scored = model.transform(filled).withColumn("_score", F.when(F.col("_valid"), decision_of(model)))
    return scored.select(
        *read, F.col("_score").alias("decision_score"), class_of(F.col("_score")).alias("prediction"))


def summary_metrics() -> dict[str, Column]:
    """Rows in total, scored, left out, and rows per predicted class."""
    p = F.col("prediction")
    return {
        "total_rows": F.count(F.lit(1)),
        "valid_rows": F.count(p),
        "nan_rows_dropped": F.count_if(p.isNull()),
        "benign": F.count_if(p == BENIGN),
        "attack": F.count_if(p == ATTACK),
    }


def score_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(*[c.alias(k) for k, c in summary_metrics().items()])


def write_scored(scored: DataFrame, path: str) -> tuple[DataFrame, dict]:
    """Write scored rows and summarise them in the same pass."""
    return write_observed(scored, path, summary_metrics())
