"""Confusion counts, classification metrics, reports and threshold sweeps.

Everything is derived from one grouped count, so the scored table is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.numeric import display, f1, percent_of, ratio, threshold_grid
from flowsift.operators.small import unpivot_row

METRICS = ["accuracy", "precision", "recall", "f1"]


def confusion_columns(y: Column, p: Column) -> dict[str, Column]:
    """TP, TN, FP, FN as aggregates; 1 is the positive class."""
    return {
        "tp": F.count_if((y == 1) & (p == 1)),
        "tn": F.count_if((y == 0) & (p == 0)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
    }


def rates(tp: Column, tn: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1 of confusion counts, 0 where undefined."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": f1(precision, recall),
    }


def confusion_binary(df: DataFrame, y: str, p: str, by: list[str] = ()) -> DataFrame:
    counts = confusion_columns(F.col(y), F.col(p))
    return df.groupBy(*by).agg(*[c.alias(k) for k, c in counts.items()])


def binary_metrics(
    df: DataFrame, y: str, p: str, by: list[str] = (), digits: int | None = None
) -> DataFrame:
    """Metrics and confusion counts, one row or one row per group."""
    counts = confusion_binary(df, y, p, by)
    values = rates(*[F.col(c) for c in ("tp", "tn", "fp", "fn")])
    return counts.select(
        *by, *[display(c, digits).alias(k) for k, c in values.items()], "tp", "tn", "fp", "fn"
    )


def confusion_long(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts of every (truth, prediction) pair that occurs."""
    return df.groupBy(F.col(y).alias("truth"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, classes: list | None = None) -> DataFrame:
    """k x k matrix: one row per true class, one column per predicted class.

    The classes are the sorted labels of both columns. A list may add classes that do
    not occur or set their order; a label that is not in it is an error.
    """
    cells = confusion_long(df, y, p)
    both = F.explode(F.array("truth", "predicted"))
    seen = sorted(r[0] for r in cells.select(both.alias("c")).distinct().collect() if r[0] is not None)
    if classes is None:
        classes = seen
    elif set(seen) - set(classes):
        raise ValueError(f"Labels outside the given classes: {sorted(set(seen) - set(classes))}")
    counts = cells.groupBy("truth").pivot("predicted", classes).agg(F.sum("n"))
    rows = df.sparkSession.createDataFrame([(c,) for c in classes], cells.select("truth").schema)
    return rows.join(counts, "truth", "left").na.fill(0)


def _class_counts(cells: DataFrame) -> DataFrame:
    """Support, predictions and hits per class of a confusion table."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("predicted"), n).otherwise(zero)
    roles = F.array(
        F.struct(F.col("truth").alias("class"), n.alias("support"), zero.alias("called"),
                 hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), n.alias("called"),
                 zero.alias("hits")),
    )
    return cells.select(F.inline(roles)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "called", "hits")])


def _class_rates(cells: DataFrame) -> DataFrame:
    precision, recall = ratio(F.col("hits"), F.col("called")), ratio(F.col("hits"), F.col("support"))
    return _class_counts(cells).select(
        "class", precision.alias("precision"), recall.alias("recall"),
        f1(precision, recall).alias("f1"), "support", "hits")


def _weighted(c: str) -> Column:
    return F.sum(F.col(c) * F.col("support")) / F.sum("support")


def classification_report(df: DataFrame, y: str, p: str, digits: int | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    per = _class_rates(confusion_long(df, y, p))
    names = ("precision", "recall", "f1")
    rows = per.withColumn("class", F.col("class").cast("string"))
    total = F.sum("support").alias("support")
    nothing = F.lit(None).cast("double")
    accuracy = F.sum("hits") / F.sum("support")
    averages = rows.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), nothing.alias("precision"),
                     nothing.alias("recall"), accuracy.alias("f1"), total),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], total),
            F.struct(F.lit("weighted avg").alias("class"),
                     *[_weighted(c).alias(c) for c in names], total),
        ).alias("a")
    ).select(F.inline("a"))
    both = rows.select("class", *names, "support").unionByName(averages)
    return both.select("class", *[display(F.col(c), digits).alias(c) for c in names], "support")


def multiclass_metrics(df: DataFrame, y: str, p: str, digits: int | None = None) -> DataFrame:
    """Accuracy, macro F1 and weighted F1, one row."""
    return _class_rates(confusion_long(df, y, p)).agg(
        display(F.sum("hits") / F.sum("support"), digits).alias("accuracy"),
        display(F.avg("f1"), digits).alias("macro_f1"),
        display(_weighted("f1"), digits).alias("weighted_f1"),
    )


def bucket_of(score: Column, thresholds: list[float]) -> Column:
    """How many of the ascending thresholds are <= score, by binary search."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score >= F.lit(thresholds[mid]), search(mid + 1, hi)).otherwise(
            search(lo, mid))

    return search(0, len(thresholds))


def threshold_sweep(
    df: DataFrame, score: str, y: str, thresholds: list[float] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Confusion counts and rates at every threshold, a row being positive if score >= t.

    One pass: scores are counted per interval between thresholds; a running sum
    over those few rows gives the counts above each threshold. Rows without a
    score or label are left out.
    """
    grid = sorted(threshold_grid() if thresholds is None else thresholds)
    scored = df.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(y).isNotNull())
    counts = scored.groupBy(bucket_of(F.col(score), grid).alias("bucket")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    steps = df.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("bucket"))
    full = steps.join(counts, "bucket", "left").na.fill(0)
    every = Window.partitionBy(F.lit(0))  # one row per threshold
    above = every.orderBy(F.col("bucket").desc())
    t = F.element_at(F.array(*[F.lit(float(x)) for x in grid]), F.col("bucket"))
    swept = full.select(
        "bucket",
        F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(every).alias("p"), F.sum("neg").over(every).alias("n"),
    ).where(F.col("bucket") > 0).select(
        t.alias("threshold"), "tp", (F.col("n") - F.col("fp")).alias("tn"), "fp",
        (F.col("p") - F.col("tp")).alias("fn"))
    values = rates(*[F.col(c) for c in ("tp", "tn", "fp", "fn")])
    return swept.select(
        "threshold", *[display(values[k], digits).alias(k)
                       for k in ("precision", "recall", "f1", "accuracy")],
        "tp", "tn", "fp", "fn")


def drift_impact(
    baseline: DataFrame, shifted: DataFrame, y: str, p: str, digits: int | None = None
) -> DataFrame:
    """Each metric on two scored tables, its change and its change in percent."""
    both = baseline.select(F.lit(0).alias("_side"), y, p).unionByName(
        shifted.select(F.lit(1).alias("_side"), y, p))
    return impact_of_sides(both, F.col("_side") == 0, F.col("_side") == 1, y, p, digits)


def impact_of_sides(
    df: DataFrame, is_baseline: Column, is_shifted: Column, y: str, p: str,
    digits: int | None = None,
) -> DataFrame:
    """drift_impact for two parts of one table, in one aggregate."""
    aggs = []
    for side, cond in (("b", is_baseline), ("s", is_shifted)):
        counts = confusion_columns(F.when(cond, F.col(y)), F.col(p))
        aggs += [c.alias(f"{side}_{k}") for k, c in counts.items()]
    cells = ("tp", "tn", "fp", "fn")
    b = rates(*[F.col(f"b_{c}") for c in cells])
    s = rates(*[F.col(f"s_{c}") for c in cells])
    row = unpivot_row(df.agg(*aggs), {
        "baseline": [b[m] for m in METRICS], "shifted": [s[m] for m in METRICS]}, METRICS)
    delta = F.col("shifted") - F.col("baseline")
    return row.select(
        F.col("name").alias("metric"),
        *[display(F.col(c), digits).alias(c) for c in ("baseline", "shifted")],
        display(delta, digits).alias("delta"),
        display(percent_of(delta, F.col("baseline")), digits).alias("delta_pct"),
    )


def compare_models(tables: list[DataFrame]) -> DataFrame:
    """Result rows of several models in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def best_model(results: DataFrame, prefer: list[str]) -> DataFrame:
    """Row with the highest F1; a tie goes to the model named first in `prefer`."""
    place = F.array_position(F.array(*[F.lit(m) for m in prefer]), F.col("model"))
    place = F.when(place == 0, len(prefer) + 1).otherwise(place)
    best = F.max_by(F.struct(*results.columns), F.struct(F.col("f1"), -place, F.col("model")))
    return results.agg(best.alias("b")).select("b.*")


def top_k(df: DataFrame, by: str, k: int = 15, tie: str = "feature") -> DataFrame:
    """The k rows with the largest value, ties by name."""
    return df.orderBy(F.col(by).desc(), F.col(tie)).limit(k)

