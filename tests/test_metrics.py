import pytest
from pyspark.sql import functions as F

from flowsift.functions.numeric import threshold_grid
from flowsift.operators import metrics


def pairs(spark, y, p):
    return spark.createDataFrame(list(zip(y, p)), "y int, p int")


@pytest.mark.parametrize("y, p, want", [
    ([0, 0, 1, 1], [0, 0, 1, 1], (1.0, 1.0, 1.0, 1.0, 2, 2, 0, 0)),
    ([0, 0, 1, 1], [1, 1, 0, 0], (0.0, 0.0, 0.0, 0.0, 0, 0, 2, 2)),
    ([0, 0, 1, 1, 0, 1], [0, 1, 1, 0, 0, 1], (4 / 6, 2 / 3, 2 / 3, 2 / 3, 2, 2, 1, 1)),
    ([0, 0], [0, 0], (1.0, 0.0, 0.0, 0.0, 0, 2, 0, 0)),
])
def test_binary_metrics(spark, y, p, want):
    got = metrics.binary_metrics(pairs(spark, y, p), "y", "p").first()
    assert tuple(got) == pytest.approx(want)


def test_multiclass(spark):
    df = pairs(spark, [0, 1, 2, 0, 1, 2], [0, 1, 2, 0, 2, 1])
    m = metrics.multiclass_metrics(df, "y", "p").first()
    assert m["accuracy"] == pytest.approx(4 / 6)
    assert m["macro_f1"] == pytest.approx((1 + 0.5 + 0.5) / 3) == m["weighted_f1"]
    matrix = metrics.confusion_matrix(df, "y", "p", [0, 1, 2]).orderBy("truth").collect()
    assert [tuple(r) for r in matrix] == [(0, 2, 0, 0), (1, 0, 1, 1), (2, 0, 1, 1)]
    assert metrics.confusion_matrix(df, "y", "p").orderBy("truth").collect() == matrix
    with pytest.raises(ValueError, match="2"):
        metrics.confusion_matrix(df, "y", "p", [0, 1])


def test_report_has_every_class_and_averages(spark):
    df = pairs(spark, [0, 0, 1, 1], [0, 1, 1, 2])
    rows = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert set(rows) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert rows["2"]["support"] == 0 and rows["2"]["recall"] == 0.0
    assert rows["0"]["precision"] == 1.0 and rows["0"]["recall"] == 0.5
    assert rows["accuracy"]["f1"] == 0.5 and rows["macro avg"]["support"] == 4
    assert rows["weighted avg"]["recall"] == pytest.approx(0.5)


def test_sweep_equals_one_count_per_threshold(spark):
    df = spark.range(500).select(
        (F.pmod(F.hash("id"), F.lit(100)) / 10 - 5).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    df = df.unionByName(spark.createDataFrame(
        [(float("nan"), 1), (None, 1), (float("inf"), 0)], "s double, y int"))
    swept = {r["threshold"]: r for r in metrics.threshold_sweep(df, "s", "y").collect()}
    known = [tuple(r) for r in df.where("s is not null and not isnan(s)").collect()]
    assert list(sorted(swept)) == threshold_grid()
    for t, r in swept.items():
        tp = sum(s >= t and y == 1 for s, y in known)
        fp = sum(s >= t and y == 0 for s, y in known)
        assert (r["tp"], r["fp"]) == (tp, fp)
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(known)


def test_sweep_with_own_thresholds(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 1), (0.9, 1)], "s double, y int")
    rows = metrics.threshold_sweep(df, "s", "y", [0.9, 0.1, 0.5]).orderBy("threshold").collect()
    assert [(r["tp"], r["fp"], r["fn"], r["tn"]) for r in rows] == [
        (2, 1, 0, 0), (2, 0, 0, 1), (1, 0, 1, 1)]


def test_drift_impact(spark):
    base = pairs(spark, [0, 1, 1, 0], [0, 1, 1, 0])
    shifted = pairs(spark, [0, 1, 1, 0], [0, 1, 0, 0])
    rows = {r["metric"]: r for r in metrics.drift_impact(base, shifted, "y", "p").collect()}
    assert rows["accuracy"]["delta"] == pytest.approx(-0.25)
    assert rows["recall"]["delta_pct"] == pytest.approx(-50)
    assert rows["precision"]["delta"] == 0


def test_best_model_prefers_the_first_on_a_tie(spark):
    rows = spark.createDataFrame([("rbf", 0.5), ("linear", 0.5), ("x", 0.1)], "model string, f1 double")
    assert metrics.best_model(rows, ["linear", "rbf"]).first()["model"] == "linear"
    better = rows.unionByName(spark.createDataFrame([("rf", 0.6)], rows.schema))
    assert metrics.best_model(better, ["linear", "rbf"]).first()["model"] == "rf"


def test_compare_models_fills_missing_columns(spark):
    a = spark.createDataFrame([("a", 1.0)], "model string, f1 double")
    b = spark.createDataFrame([("b", 2.0, 3)], "model string, f1 double, C int")
    assert metrics.compare_models([a, b]).where("model = 'a'").first()["C"] is None


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "feature string, v double")
    assert [r["feature"] for r in metrics.top_k(df, "v", 2).collect()] == ["c", "a"]
