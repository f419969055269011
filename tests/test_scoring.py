import pytest
from pyspark.sql import functions as F

from flowsift.operators import importance, scoring
from flowsift.spec import DEFAULT_SPEC


def test_record_validation(spark):
    names = DEFAULT_SPEC.features
    full = {f: "0.0" for f in names}
    rows = [(0, full), (1, {"Flow Duration": "100"}), (2, {**full, "Flow Duration": None}),
            (3, {**full, "ACK Flag Count": "many"})]
    df = spark.createDataFrame(rows, "id int, record map<string,string>")
    got = {r["id"]: r for r in scoring.validate_records(df, "record", names).collect()}
    assert got[0]["is_valid"] and not got[0]["missing_features"]
    assert len(got[1]["missing_features"]) == 14 and not got[1]["is_valid"]
    assert got[2]["invalid_features"] == ["Flow Duration"] and not got[2]["is_valid"]
    assert got[3]["invalid_features"] == ["ACK Flag Count"]


def test_all_rows_are_kept(spark):
    df = spark.createDataFrame(
        [("1", 2.0), ("x", 2.0), ("3", float("inf")), ("-4", None), ("-5", 1.0)], "a string, b double")
    scored = scoring.score_rows(df, ["a", "b"], F.col("a") + F.col("b"))
    assert [(r["decision_score"], r["prediction"]) for r in scored.collect()] == [
        (3.0, "ATTACK"), (None, None), (None, None), (None, None), (-4.0, "BENIGN")]
    assert scoring.score_summary(scored).first().asDict() == {
        "total_rows": 5, "valid_rows": 2, "nan_rows_dropped": 3, "benign": 1, "attack": 1}


def test_zero_is_benign(spark):
    df = spark.createDataFrame([(0.0,)], "a double")
    assert scoring.score_rows(df, ["a"], F.col("a")).first()["prediction"] == "BENIGN"


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "random_col int")
    with pytest.raises(scoring.MissingFeatures, match="no column for 2") as error:
        scoring.require_columns(df, ["a", "b"])
    assert error.value.missing == ["a", "b"] and error.value.available == ["random_col"]


def test_record_map(spark):
    df = spark.createDataFrame([(1.5, None)], "a double, b double")
    got = df.select(scoring.record_map(df, ["a", "b"]).alias("m")).first()["m"]
    assert got == {"a": "1.5", "b": None}


@pytest.mark.parametrize("hot", [False, True])
def test_permutation_is_a_bijection(spark, monkeypatch, hot):
    monkeypatch.setattr(importance, "BUCKET_ROWS", 100)
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")) if hot else F.col("id")
    df = spark.range(1000).select(key.alias("k"), F.col("id").cast("double").alias("x"))
    out = importance.permuted(df, ["x"], ["k"], 2)
    for repeat in (1, 2):
        rows = out.where(F.col("repeat") == repeat).select("x", "_d0").collect()
        assert sorted(r["x"] for r in rows) == sorted(r["_d0"] for r in rows) == list(range(1000))
        assert sum(r["x"] == r["_d0"] for r in rows) < 5
    if not hot:
        moved = out.groupBy("x").agg(F.count_distinct("_d0").alias("n")).where("n = 2").count()
        assert moved > 900


def test_importance_does_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    df = spark.range(900).select(
        (F.col("id") % 300).alias("id"), F.sin(F.col("id") % 300).alias("a"),
        F.cos(F.col("id") % 300).alias("b"))  # every row three times
    df = df.withColumn("y", (F.col("a") > 0.1).cast("int"))
    seen = set()
    for rows in (5, 50, 5000):
        monkeypatch.setattr(importance, "BUCKET_ROWS", rows)
        out = importance.permutation_importance(
            df.repartition(rows % 7 + 1), ["a", "b"], "y", ["id"], lambda c: c["a"] - 0.2 * c["b"], 3)
        seen.add(tuple(sorted(map(tuple, out.collect()))))
    assert len(seen) == 1


def test_scored_rows_come_back_as_read(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, 1.0)], "id int, a double")
    rows = scoring.score_rows(df, ["a"], F.col("a")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, float("inf"), None, None), (2, 1.0, 1.0, "ATTACK")]


def test_importance_finds_the_used_feature(spark):
    df = spark.range(2000).select(
        "id", (F.pmod(F.hash("id"), F.lit(1000)) / 500 - 1).alias("used"), F.rand(1).alias("idle"))
    df = df.withColumn("y", (F.col("used") > 0).cast("int"))
    got = importance.permutation_importance(
        df, ["idle", "used"], "y", ["id"], lambda c: c["used"] + 0 * c["idle"], 3).collect()
    assert [r["feature"] for r in got] == ["used", "idle"]
    assert 0.4 < got[0]["importance_mean"] < 0.6
    assert got[1]["importance_mean"] == 0 and got[1]["importance_std"] == 0


def test_bucket_digits():
    rows = importance.BUCKET_ROWS
    assert [importance.bucket_digits(n) for n in (0, rows, rows + 1, 16 * rows, 10**12)] == [
        0, 0, 1, 1, 7]


def test_coefficients(spark):
    got = importance.linear_coefficients(spark, ["a", "b", "c"], [0.5, -2.0, 0.5]).collect()
    assert [(r["feature"], r["abs_coefficient"]) for r in got] == [("b", 2.0), ("a", 0.5), ("c", 0.5)]
