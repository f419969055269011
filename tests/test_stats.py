import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowsift.operators import features, stats

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.RandomState(3)
    n = 3001
    out = pd.DataFrame({
        "a": rng.normal(5, 2, n), "b": rng.exponential(100, n).round(1),
        "c": rng.choice([0.0, 0.0, 1.0, 7.0], n), "d": np.full(n, 4.0), "key": np.arange(n),
    })
    out.loc[::50, "b"] = np.nan
    return out


@pytest.fixture(scope="module")
def table(spark, frame):
    df = spark.createDataFrame(frame).repartition(5)
    return df.withColumn("b", F.when(~F.isnan("b"), F.col("b"))).persist()


def test_feature_statistics_equal_pandas(table, frame):
    got = stats.feature_statistics(table, NAMES).toPandas().set_index("feature")
    for f in NAMES:
        col = frame[f]
        want = [col.mean(), col.std(), col.min(), *col.quantile([0.25, 0.5, 0.75]), col.max(),
                col.skew(), col.kurtosis(), col.isna().sum()]
        assert list(got.loc[f]) == pytest.approx(want, rel=1e-9, abs=1e-9), f


def test_sketch_quartiles_are_close(table, frame):
    got = stats.feature_statistics(table, ["a"], exact=False).first()
    assert got["median"] == pytest.approx(frame["a"].median(), abs=0.05)


@pytest.mark.parametrize("fine", [stats.FINE, 3])
def test_exact_quantiles(table, frame, monkeypatch, fine):
    """Also with intervals narrowed again and again."""
    monkeypatch.setattr(stats, "FINE", fine)
    monkeypatch.setattr(stats, "ACCURACY", 50)
    qs = (0.0, 0.01, 0.5, 0.9, 1.0)
    got = stats.exact_quantiles(table, NAMES, qs).toPandas().set_index("feature")
    for f in NAMES:
        assert list(got.loc[f]) == pytest.approx(list(frame[f].quantile(qs)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (None,)], "a double")
    assert stats.exact_quantiles(empty, ["a"]).count() == 0
    assert stats.feature_statistics(empty, ["a"]).first()["missing"] == 2


def test_distribution_comparison(spark, table, frame):
    other = table.withColumn("a", F.col("a") * 2 + 1)
    row = stats.distribution_comparison(table, other, ["a", "c"]).where("feature = 'a'").first()
    m, s = frame["a"].mean(), frame["a"].std()
    assert row["mean_change_pct"] == pytest.approx((m + 1) / (s + 1e-10) * 100)
    assert row["std_change_pct"] == pytest.approx(100)


def test_perturb_columns(spark, table, frame):
    names = ["a", "b", "c"]
    picked = stats.shifted_features(names)
    assert len(picked) == 1
    one = stats.perturb_columns(table, names, ["key"], 2.0).orderBy("key").toPandas()
    two = stats.perturb_columns(table.repartition(2), names, ["key"], 2.0).orderBy("key").toPandas()
    pd.testing.assert_frame_equal(one, two, rtol=1e-9)
    for f in names:
        noise = (one[f] - frame[f]).dropna()
        if f in picked:
            assert noise.std() == pytest.approx(frame[f].std(), rel=0.1)
        else:
            assert (noise == 0).all()
    with pytest.raises(ValueError):
        stats.perturb_columns(table, names, ["key"], 0.5)
    same = stats.perturb_columns(table, ["d"], ["key"], 3.0)
    assert same.where("d <> 4.0").count() == 0


def test_covariance(table, frame):
    got = stats.covariance_matrix(table, ["a", "c"]).collect()
    want = frame[["a", "c"]].cov()
    for r in got:
        assert r["covariance"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]])


def test_scaling(table, frame):
    scaling = features.fit_scaling(table, ["a", "d"])
    out = scaling.transform(table).select("a", "d").toPandas()
    assert out["a"].mean() == pytest.approx(0, abs=1e-9)
    assert out["a"].std(ddof=0) == pytest.approx(1)
    assert (out["d"] == 0).all()


def test_cell_variance(table, frame):
    got = features.cell_variance(table, ["a", "c"]).first()
    cells = frame[["a", "c"]].to_numpy().ravel()
    assert got["variance"] == pytest.approx(cells.var())
    assert got["gamma_scale"] == pytest.approx(1 / (2 * cells.var()))


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "y string")
    got = {r["class"]: r["weight"] for r in features.class_weights(df, "y").collect()}
    assert got == {"a": 8 / 12, "b": 2.0}
    assert features.with_class_weights(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(8)


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "y string")
    got = [tuple(r) for r in features.index_labels(df, "y", "i").orderBy("y").collect()]
    assert got == [(None, None), ("a", 0), ("a", 0), ("b", 1), ("c", 2)]


def test_quantiles_ask_again_when_a_sketch_is_off(spark, monkeypatch):
    df = spark.range(5000).select(F.sin("id").alias("v"))
    want = stats.exact_quantiles(df, ["v"]).first()
    asked = []

    def off(c, qs):
        """A sketch whose first answers all lie too high."""
        asked.append(qs)
        return F.percentile_approx(c, qs if len(asked) > 2 else [min(1.0, q + 0.2) for q in qs], 10000)

    monkeypatch.setattr(stats, "FINE", 10)
    monkeypatch.setattr(stats, "_sketch", off)
    assert stats.exact_quantiles(df, ["v"]).first() == want and len(asked) > 2
