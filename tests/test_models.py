import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flowsift.operators import fourier, importance, kernel_grid, linear_walk, models, scoring
from flowsift.operators.fourier import RandomFourier
from flowsift.plans import jobs

FEATURES = ["f1", "f2", "f3"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.RandomState(7)
    y = np.array([0] * 210 + [1] * 90)
    x = rng.normal(0, 1, (300, 3)) * [1, 10, 0.1] + np.outer(y, [1.5, -12, 0.02])
    out = pd.DataFrame(x, columns=FEATURES)
    out["y"], out["id"] = y, np.arange(300)
    return out


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).withColumn("y", F.col("y").cast("int")).persist()


@pytest.fixture(scope="module")
def linear(table):
    fitted = models.train_linear_svm(table, FEATURES)
    assert fitted.converged and fitted.iterations > 1
    return fitted


@pytest.fixture(scope="module")
def rbf(table):
    return models.train_rbf_svm(table, FEATURES, 10.0, "scale", dimensions=128, max_iter=20)


def test_linear_svm_reaches_the_primal_optimum(frame, linear):
    x = frame[FEATURES].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    sign = np.where(frame["y"] == 1, 1.0, -1.0)
    weight = np.where(frame["y"] == 1, 300 / (2 * 90), 300 / (2 * 210))

    def objective(w, b):
        return 0.5 * w @ w + (weight * np.maximum(0, 1 - sign * (z @ w + b))).sum()

    svc = linear.model.stages[-1]
    got = objective(svc.coefficients.toArray(), svc.intercept)
    w, b, best = np.zeros(3), 0.0, np.inf
    for i in range(20000):  # subgradient descent
        on = weight * sign * (sign * (z @ w + b) < 1)
        step = 1.0 / (300 + i)
        w, b = w - step * (w - on @ z), b + step * on.sum()
        best = min(best, objective(w, b))
    assert got <= best * 1.002


def test_column_score_equals_the_model(table, linear):
    scored = scoring.score_with_model(table, linear.model, FEATURES).withColumn(
        "column", models.linear_score(linear))
    assert scored.where(F.abs(F.col("column") - F.col("decision_score")) > 1e-9).count() == 0
    assert scored.where((F.col("column") > 0) != (F.col("prediction") == "ATTACK")).count() == 0
    assert scored.columns == [*table.columns, "decision_score", "prediction", "column"]


def test_rows_with_missing_values_get_no_score(spark, linear):
    df = spark.createDataFrame([(1.0, 2.0, None, 5), (1.0, 2.0, 3.0, 6)],
                               "f1 double, f2 double, f3 double, id int")
    rows = scoring.score_with_model(df, linear.model, FEATURES).orderBy("id").collect()
    assert rows[0]["prediction"] is None and rows[0]["f3"] is None and rows[0]["f1"] == 1.0
    assert rows[1]["prediction"] in ("BENIGN", "ATTACK")


def test_rbf_and_evaluation(table, rbf):
    m = jobs.evaluate(rbf, table)
    assert m["f1"] > 0.8 and m["tp"] + m["tn"] + m["fp"] + m["fn"] == 300
    assert rbf.model.stages[-2].getOrDefault("gamma") == pytest.approx(1 / 3)


def test_fourier_features_approach_the_kernel(spark):
    rng = np.random.RandomState(0)
    x = rng.normal(0, 1, (30, 4))
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["i", "scaled"])
    lift = RandomFourier(inputCol="scaled", outputCol="z", gamma=0.3, dimensions=4096)
    rows = lift.transform(df).orderBy("i").select(vector_to_array("z").alias("z")).collect()
    z = np.array([r["z"] for r in rows])
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_save_and_load(spark, table, rbf, tmp_path):
    path = models.save_model(rbf.model, str(tmp_path / "model"))
    loaded = models.load_model(spark, path)
    assert isinstance(loaded, PipelineModel)
    columns = ["id", "decision_score"]
    one = scoring.score_with_model(table, rbf.model, FEATURES).select(columns)
    two = scoring.score_with_model(table, loaded, FEATURES).select(columns)
    assert sorted(one.collect()) == sorted(two.collect())
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, str(tmp_path / "none"))


def test_benchmarks(table):
    for kind, settings in (("logistic_regression", {}), ("random_forest", {"trees": 5, "max_depth": 4})):
        fitted = models.train_benchmark(kind, table, FEATURES, **settings)
        assert jobs.evaluate(fitted, table)["f1"] > 0.7
        scored = scoring.score_with_model(table, fitted.model, FEATURES)
        both = fitted.model.transform(table).select("id", F.col("prediction").alias("p"))
        odd = scored.join(both, "id").where((F.col("prediction") == "ATTACK") != (F.col("p") == 1))
        assert odd.count() == 0
        assert "kernel" in models.model_info(fitted, table)
    with pytest.raises(ValueError):
        models.train_benchmark("unknown_model", table, FEATURES)
    with pytest.raises(ValueError):
        models.build_svm(FEATURES, 10, "poly")


def test_model_info(table, linear, rbf):
    info = models.model_info(linear, table)
    assert info["kernel"] == "linear" and info["n_features"] == 3 and info["C"] == 1.0
    assert info["n_support_vectors"] == sum(info["support_vectors_per_class"].values()) > 0
    assert models.model_info(rbf, table)["gamma"] == "scale"


def test_grid_search(table):
    found = models.search_rbf_svm(
        table, FEATURES, ["id"], {"C": [0.1, 10.0], "gamma": ["scale", 0.5]},
        dimensions=64, max_iter=5)
    assert [(r["C"], r["gamma"]) for r in found.grid] == [
        (0.1, "scale"), (0.1, "0.5"), (10.0, "scale"), (10.0, "0.5")]
    best = max(found.grid, key=lambda r: r["cv_f1_mean"])
    assert (found.C, str(found.gamma)) == (best["C"], best["gamma"])
    assert all(r["cv_f1_std"] >= 0 for r in found.grid)


def test_shared_passes_reach_the_objective_of_single_fits(table, frame):
    """Every model of the grid against MLlib's fit of the same training rows, by the plain hinge."""
    folded = models.with_class_weights(
        table.withColumn("fold", F.col("id") % 3).withColumn("y", F.col("y").cast("double")), "y", "weight").select(
        *FEATURES, "y", "weight", "fold").persist()
    scalings, weights = kernel_grid.fold_scalings(folded, FEATURES, "weight", "fold", 3)
    blocks = kernel_grid.lifted_blocks(
        folded, FEATURES, "y", "weight", "fold", 3, scalings, [0.2, 0.5], 64, 42).persist()
    costs = [0.1, 1.0, 10.0]
    walks = kernel_grid.fit_all(blocks, 6, costs, dict(enumerate(weights * 2)), 64, 400, 1e-4)
    assert all(w.converged for w in walks.values())
    rows = folded.toPandas()
    x = rows[FEATURES].to_numpy()
    sign = np.where(rows["y"] == 1, 1.0, -1.0)
    for (pair, c), walk in walks.items():
        gamma, fold = [0.2, 0.5][pair // 3], pair % 3
        own = (rows["fold"] != fold).to_numpy()
        mean, std = x[own].mean(0), x[own].std(0)
        assert np.allclose(scalings[fold], (mean, 1 / std))
        z = fourier.projection(3, gamma, 64, 42).lifted((x - mean) / std)[own]

        def objective(w, b):
            loss = np.maximum(0, 1 - sign[own] * (z @ w + b)) * rows["weight"].to_numpy()[own]
            return 0.5 * w @ w + costs[c] * loss.sum()

        if pair in (0, 5):
            fitted = models._svc("v", costs[c], weights[fold], 1000, 1e-6).fit(table.sparkSession.createDataFrame(
                [(Vectors.dense(v), float(l > 0), float(w)) for v, l, w in zip(z, sign[own], rows["weight"][own])],
                ["v", "y", "weight"]))
            single = objective(fitted.coefficients.toArray(), fitted.intercept)
            assert objective(walk.x[:-1], walk.x[-1]) <= single * 1.015
    f1 = kernel_grid.held_f1(blocks, walks, 3)
    assert len(f1) == 18 and min(f1.values()) > 0.6


def test_models_of_samples_are_walked_on_over_all_rows(table, monkeypatch):
    """A table beyond START_ROWS ends where one task ends that sees all of it; a small one needs no pass."""
    rows = models.prepare(table, FEATURES).withColumn("fold", F.lit(-1)).repartition(12, "f1").persist()
    scalings, weights = kernel_grid.fold_scalings(rows, FEATURES, "weight", "fold", 1)
    blocks = kernel_grid.lifted_blocks(
        rows, FEATURES, "y", "weight", "fold", 1, scalings, [0.2], 32, 42).persist()
    assert blocks.count() > 4
    fit = lambda: kernel_grid.fit_all(blocks, 1, [1.0], {0: weights[0]}, 32, 400, 1e-4)[0, 0]
    passes, walk = [], kernel_grid._walk
    monkeypatch.setattr(kernel_grid, "_walk", lambda *given: passes.append(walk(*given)))
    small = fit()
    assert small.converged and not passes
    monkeypatch.setattr(kernel_grid, "START_ROWS", 150)
    large = fit()
    assert large.converged and len(passes) == 1
    assert large.f == pytest.approx(small.f, rel=2e-3)


def test_tasks_of_fits_do_not_grow_with_the_table(table):
    forest = models.build_random_forest(FEATURES, 300).getStages()[-1]
    assert forest.getCacheNodeIds()
    tasks = [models.placed(table, FEATURES, 10**12, *bounds).rdd.getNumPartitions()
             for bounds in ((), (models.LEAST_FOREST_TASKS, models.FOREST_TASKS))]
    assert tasks == [models.MOST_TASKS, models.FOREST_TASKS]


def test_tasks_of_a_pass_do_not_grow_with_the_table(table):
    most = models.TASKS_PER_CORE * table.sparkSession.sparkContext.defaultParallelism
    assert models.pass_tasks(table, 1) == 1 and models.pass_tasks(table, 10**13) == most


@pytest.fixture(scope="module")
def three(spark):
    rng = np.random.RandomState(1)
    y = np.repeat([0, 1, 2], 60)
    centre = np.array([[0, 0], [4, 0], [0, 4]])
    x = rng.normal(0, 0.6, (180, 2)) + centre[y]
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, y int")


def test_pairwise_and_one_vs_rest(three, tmp_path):
    pairwise = models.train_pairwise_svm(three, ["a", "b"], max_iter=20)
    path = pairwise.save(three.sparkSession, str(tmp_path / "pairwise"))
    loaded = models.PairwiseSVM.load(three.sparkSession, path)
    assert loaded.pairs == pairwise.pairs and loaded.scaling == pairwise.scaling
    with pytest.raises(FileNotFoundError):
        models.PairwiseSVM.load(three.sparkSession, str(tmp_path / "none"))
    assert sorted(pairwise.pairs) == [(0, 1), (0, 2), (1, 2)]
    assert pairwise.transform(three).where("prediction = y").count() >= 175
    ovr = models.train_one_vs_rest(three, ["a", "b"], max_iter=20)
    assert ovr.model.transform(three).where("prediction = y").count() >= 150


def test_converged_kernel_model_has_a_result_row(spark, table):
    """What the solver says of its end goes into the comparison table."""
    fitted = models.train_rbf_svm(table, FEATURES, 1.0, 0.5, dimensions=32)
    row = jobs.result_row(spark, "RBF", fitted, jobs.evaluate(fitted, table)).first()
    assert row["converged"] is True and row["iterations"] > 1


def test_multiclass_fits_share_their_passes(three, monkeypatch):
    """All pairs in the same few jobs, as near to the minimum from samples as from all rows at once."""
    tracker = three.sparkSession.sparkContext.statusTracker()
    data = np.array(three.select("a", "b", "y").collect(), float)

    def objectives(fitted):
        x = (data[:, :2] - fitted.scaling.mean) / fitted.scaling.std
        rate = len(data) / (3 * np.bincount(data[:, 2].astype(int)))[data[:, 2].astype(int)]
        out = []
        for (a, b), (w, c) in sorted(fitted.pairs.items()):
            own = np.isin(data[:, 2], (a, b))
            sign = np.where(data[own, 2] == a, 1.0, -1.0)
            loss = rate[own] * np.maximum(0, 1 - sign * (x[own] @ w + c))
            out.append(loss.sum() + np.dot(w, w) / 2)
        return np.array(out)

    three.sparkSession.sparkContext.setJobGroup("pairs", "pairs")
    whole = models.train_pairwise_svm(three, ["a", "b"])
    assert len(tracker.getJobIdsForGroup("pairs")) < 20
    three.sparkSession.sparkContext.setJobGroup("", "")
    passes, one = [], linear_walk._pass
    monkeypatch.setattr(linear_walk, "_pass", lambda b, m, points: passes.append(len(points)) or one(b, m, points))
    monkeypatch.setattr(linear_walk, "START_CELLS", 60)
    monkeypatch.setattr(linear_walk, "BLOCK_ROWS", 8)
    sampled = models.train_pairwise_svm(three, ["a", "b"])
    assert passes and passes[0] == 3
    monkeypatch.setattr(models, "TOLERANCE", 1e-9)
    monkeypatch.setattr(linear_walk, "START_CELLS", 10**9)
    best = objectives(models.train_pairwise_svm(three, ["a", "b"]))
    assert (objectives(whole) <= 1.01 * best).all() and (objectives(sampled) <= 1.01 * best).all()


def test_multiclass_fit_rejects_missing_values(three):
    broken = three.withColumn("a", F.when(F.col("a") < 3, F.col("a")))
    with pytest.raises(Exception, match="finite number"):
        models.train_pairwise_svm(broken, ["a", "b"])


def test_forest_does_not_depend_on_partitions(table):
    settings = {"trees": 5, "max_depth": 6}
    one, two = (models.train_benchmark("random_forest", t, FEATURES, **settings).model.stages[-1]
                for t in (table.repartition(5), table.repartition(2, "f1")))
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]


def test_pca_equals_svd(table, frame):
    fitted = models.fit_pca(table, FEATURES, 2)
    x = frame[FEATURES].to_numpy()
    x = x - x.mean(0)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    assert fitted.explained == pytest.approx(list(s[:2] ** 2 / (s**2).sum()))
    out = fitted.transform(table).orderBy("id").select("pc1", "pc2").toPandas().to_numpy()
    want = x @ v[:2].T
    for k in range(2):
        sign = np.sign(v[k][np.abs(v[k]).argmax()])
        assert out[:, k] == pytest.approx(want[:, k] * sign, abs=1e-8)


def test_forest_does_not_depend_on_partitions(spark):
    rng = np.random.RandomState(3)
    rows = [(float(a), float(b), int(a + 0.3 * b > 0)) for a, b in rng.normal(0, 1, (400, 2))]
    trees = set()
    for parts in (1, 4, 16):
        df = spark.createDataFrame(rows, "a double, b double, y int").repartition(parts)
        fitted = models.train_benchmark("random_forest", df, ["a", "b"], trees=5, max_depth=6)
        trees.add(fitted.model.stages[-1].toDebugString.split("\n", 1)[1])
        assert models.placed(df, ["a", "b"], 800, models.FOREST_TASKS).rdd.getNumPartitions() == 64
    assert len(trees) == 1


def kernel_error(z, x, gamma):
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    return np.abs(z @ z.T - exact).mean()


@pytest.mark.parametrize("width", [4, 15, 300])
def test_structured_directions_are_closer_to_the_kernel(width):
    """Less kernel error than independent normal directions, over several seeds; both ways to
    multiply agree."""
    rng = np.random.RandomState(1)
    x = rng.normal(0, 1, (60, width)) / np.sqrt(width)
    own, plain = [], []
    for seed in range(8):
        drawn = fourier.Projection(width, 1.0, 512, seed)
        own.append(kernel_error(drawn.lifted(x), x, 1.0))
        r = np.random.RandomState(seed)
        w, b = r.normal(0, np.sqrt(2.0), (width, 512)), r.uniform(0, 2 * np.pi, 512)
        plain.append(kernel_error(np.sqrt(2.0 / 512) * np.cos(x @ w + b), x, 1.0))
        assert np.allclose(drawn.of(x), drawn._turned(x))
        assert np.allclose(drawn.of(np.eye(width))[1], drawn.column(1))
    assert np.mean(own) < 0.95 * np.mean(plain)


def exact_kernel_svm(x, y, gamma, C):
    """Dual coordinate ascent on the exact kernel with balanced weights, by the plain rule; the
    intercept is a constant added to the kernel. Gives the decision function."""
    kernel = lambda a, b: np.exp(-gamma * ((a[:, None] - b[None]) ** 2).sum(-1)) + 1.0
    sign = np.where(y == 1, 1.0, -1.0)
    bound = C * np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    k, a = kernel(x, x), np.zeros(len(y))
    f = np.zeros(len(y))
    for _ in range(300):
        for i in range(len(y)):
            new = min(max(a[i] + (1 - sign[i] * f[i]) / k[i, i], 0.0), bound[i])
            f += (new - a[i]) * sign[i] * k[:, i]
            a[i] = new
    return lambda z: kernel(z, x) @ (a * sign)


def test_f1_gap_to_the_exact_kernel(spark):
    """What the approximation costs on a ring inside a cloud, which no line separates."""
    rng = np.random.RandomState(4)
    x = rng.normal(0, 1, (600, 2))
    y = ((np.hypot(x[:, 0], x[:, 1]) < 0.9) ^ (rng.random_sample(600) < 0.05)).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, y int")
    fitted = models.train_rbf_svm(df.limit(400), ["a", "b"], 1.0, 0.5)
    train = df.limit(400).toPandas()
    scaled = (x - train[["a", "b"]].to_numpy().mean(0)) / train[["a", "b"]].to_numpy().std(0)
    decide = exact_kernel_svm(scaled[:400], y[:400], 0.5, 1.0)
    called = decide(scaled[400:]) > 0
    tp = (called & (y[400:] == 1)).sum()
    exact = 2 * tp / (called.sum() + (y[400:] == 1).sum())
    rest = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x[400:], y[400:])],
                                 "a double, b double, y int")
    own = jobs.evaluate(fitted, rest)["f1"]
    print(f"F1 {own:.4f} against {exact:.4f} with the exact kernel")
    assert exact > 0.8 and abs(own - exact) < 0.02


def test_walsh_hadamard_is_its_own_inverse():
    x = np.random.RandomState(0).normal(0, 1, (3, 32))
    assert np.allclose(fourier.walsh_hadamard(fourier.walsh_hadamard(x)), x)
    assert np.allclose((fourier.walsh_hadamard(np.eye(32)) ** 2), 1 / 32)


def test_importance_by_swapped_columns_equals_rescoring(table, linear, rbf):
    used = table.select("id", *FEATURES, "y")
    for fitted in (linear, rbf):
        short = importance.model_permutation_importance(used, FEATURES, "y", ["id"], fitted.model, 3)
        long = importance._rescored_importance(used, FEATURES, "y", ["id"], fitted.model, 3, 42)
        counts = [d._jdf.queryExecution().optimizedPlan().toString().lower().count("explode(sequence(-1") for d in (short, long)]
        assert counts[0] == 0, counts  # no row per feature
        for a, b in zip(short.collect(), long.collect(), strict=True):
            assert a[0] == b[0] and tuple(a)[1:] == pytest.approx(tuple(b)[1:], abs=1e-12)
