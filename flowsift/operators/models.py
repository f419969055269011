"""Classifiers on MLlib: SVMs, logistic regression, random forest, multiclass, PCA."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.numeric import display
from flowsift.operators import kernel_grid, linear_walk
from flowsift.operators.features import Scaling, cell_variance, fit_scaling, with_class_weights
from flowsift.operators.fourier import RandomFourier
from flowsift.operators.sampling import assign_folds
from flowsift.session import scratch_path
from flowsift.sources import artifacts
from flowsift.spec import CV_FOLDS, RBF_GRID, SEED

LABEL, WEIGHT = "y", "weight"
# Solvers run until the objective's relative change is below the tolerance. The count is
# only there to end a run that never gets there, which Fitted.converged tells.
MAX_ITER, TOLERANCE = 10_000, 1e-4
DIMENSIONS = 512
CELLS_PER_TASK = 1_000_000
#: Lifted cells that a task of the grid search is worth.
GRID_CELLS = 8_000_000
#: Tasks per core of a pass, at most: every task sends its sums of every pass to the driver.
TASKS_PER_CORE = 2
#: Tasks of a solver step, at most: each sends its part of every step to the driver.
MOST_TASKS = 32
#: A tree costs its rows times the trees, so a forest is grown by several tasks at least. Every task ships
#: the counts of all nodes of a step, whether it has rows of them or not, so there are not many either.
LEAST_FOREST_TASKS, FOREST_TASKS = 8, 64


@dataclass
class Fitted:
    """A fitted pipeline with the settings it was fitted with."""

    model: PipelineModel
    features: list[str]
    kernel: str
    C: float | None = None
    gamma: float | str | None = None
    seconds: float = 0.0
    grid: list[dict] = field(default_factory=list)
    iterations: int | None = None
    converged: bool | None = None

    def __post_init__(self) -> None:
        """Steps of the last solver, and whether it ended by its tolerance."""
        last = self.model.stages[-1]
        if getattr(last, "hasSummary", False):
            summary = last.summary() if callable(last.summary) else last.summary
            self.iterations = int(summary.totalIterations)
            if hasattr(last, "getMaxIter"):
                self.converged = self.iterations < last.getMaxIter()
        self.model = without_summaries(self.model)


def without_summaries(model: PipelineModel) -> PipelineModel:
    """The pipeline as it is after saving and loading. Training summaries hold on to the session, and
    once that has observed a write, such a model cannot be sent to tasks any more."""
    return PipelineModel.load(save_model(model, scratch_path(SparkSession.active(), "fitted")))


def prepare(train: DataFrame, features: list[str]) -> DataFrame:
    """Training rows with a double label and balanced class weights."""
    labelled = with_class_weights(train, LABEL, WEIGHT)
    return labelled.select(
        *[F.col(f"`{f}`") for f in features], F.col(LABEL).cast("double").alias(LABEL), WEIGHT
    )


def scaling_stages(features: list[str], n: int) -> list:
    """Assemble, then scale to zero mean and unit population variance.

    StandardScaler divides by the sample deviation; the factor turns it into the
    population one.
    """
    factor = float(np.sqrt(n / (n - 1.0))) if n > 1 else 1.0
    return [
        VectorAssembler(inputCols=features, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="standard", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="standard", outputCol="scaled", scalingVec=Vectors.dense([factor] * len(features))
        ),
    ]


def build_svm(
    features: list[str], n: int, kernel: str = "linear", C: float = 1.0, gamma: float = 1.0,
    dimensions: int = DIMENSIONS, max_iter: int = MAX_ITER, tol: float = TOLERANCE, seed: int = SEED,
) -> Pipeline:
    """Scaler and SVM for n training rows. kernel "rbf" puts random Fourier features between."""
    if kernel not in ("linear", "rbf"):
        raise ValueError(f"kernel {kernel!r} is neither linear nor rbf")
    stages = scaling_stages(features, n)
    source = "scaled"
    if kernel == "rbf":
        source = "fourier"
        stages.append(RandomFourier(
            inputCol="scaled", outputCol=source, gamma=float(gamma), dimensions=dimensions, seed=seed))
    stages.append(_svc(source, C, n, max_iter, tol))
    return Pipeline(stages=stages)


def _svc(source: str, C: float, weight_sum: float, max_iter: int, tol: float) -> LinearSVC:
    # |w|^2 / 2 + C * sum(weight * hinge), divided by C * sum(weight)
    return LinearSVC(
        featuresCol=source, labelCol=LABEL, weightCol=WEIGHT, regParam=1.0 / (C * weight_sum),
        maxIter=max_iter, tol=tol, standardization=False,
    )


def build_logistic_regression(features: list[str], n: int, C: float = 1.0) -> Pipeline:
    return Pipeline(stages=[*scaling_stages(features, n), LogisticRegression(
        featuresCol="scaled", labelCol=LABEL, weightCol=WEIGHT, regParam=1.0 / (C * n),
        maxIter=1000, standardization=False)])


def build_random_forest(
    features: list[str], n: int, trees: int = 100, max_depth: int = 30, seed: int = SEED
) -> Pipeline:
    """Trees need no scaling. 30 is the deepest that MLlib grows."""
    assembler = VectorAssembler(inputCols=features, outputCol="assembled")
    return Pipeline(stages=[assembler, RandomForestClassifier(
        featuresCol="assembled", labelCol=LABEL, weightCol=WEIGHT, numTrees=trees,
        maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed,
        cacheNodeIds=True)])  # else every row falls through every tree again at each step


def _fit(
    train: DataFrame, features: list[str], build: Callable[[DataFrame, int], Pipeline],
    least_tasks: int = 1, most_tasks: int = MOST_TASKS,
) -> tuple[PipelineModel, float]:
    """Fit on the prepared rows, held in memory and on disk since several passes read them."""
    held = train.select(*[F.col(f"`{f}`") for f in features], LABEL).persist()
    try:
        n = held.count()
        start = time.perf_counter()
        data = placed(prepare(held, features), features, n * len(features), least_tasks, most_tasks)
        model = build(held, n).fit(data)
        return model, time.perf_counter() - start
    finally:
        held.unpersist()


def placed(
    df: DataFrame, features: list[str], cells: int, least_tasks: int = 1, most_tasks: int = MOST_TASKS
) -> DataFrame:
    """Rows in partitions and in an order that their content decides, and in a number of them that
    the amount of data decides: a forest draws its samples per partition, so the fit depends on
    nothing else."""
    tasks = least_tasks
    while tasks * CELLS_PER_TASK < cells and 2 * tasks <= most_tasks:
        tasks *= 2
    content = [F.col(f"`{f}`") for f in features] + [F.col(LABEL)]
    return df.repartition(tasks, F.xxhash64(*content)).sortWithinPartitions(*content)


def train_linear_svm(train: DataFrame, features: list[str], C: float = 1.0, **settings) -> Fitted:
    model, seconds = _fit(
        train, features, lambda held, n: build_svm(features, n, "linear", C, **settings))
    return Fitted(model, features, "linear", C, None, seconds)


def gamma_value(train: DataFrame, features: list[str], gamma: float | str) -> float:
    """Number for a gamma; "scale" is 1 / (features * variance of all scaled cells)."""
    if gamma != "scale":
        return float(gamma)
    scaled = fit_scaling(train, features).transform(train)
    return cell_variance(scaled, features).first()["gamma_scale"]


def train_rbf_svm(
    train: DataFrame, features: list[str], C: float = 1.0, gamma: float | str = "scale", **settings
) -> Fitted:
    """SVM on Fourier features: the grid search's fit for one point and no folds."""
    data = prepare(train, features).persist()
    start = time.perf_counter()
    try:
        model, walk = _fit_lifted(data, features, data.count(), C, gamma_value(data, features, gamma), **settings)
    finally:
        data.unpersist()
    return Fitted(model, features, "rbf", C, gamma, time.perf_counter() - start,
                  iterations=walk.iterations, converged=walk.converged)


def _fit_lifted(
    data: DataFrame, features: list[str], n: int, C: float, gamma: float, dimensions: int = DIMENSIONS,
    max_iter: int = MAX_ITER, tol: float = TOLERANCE, seed: int = SEED,
) -> tuple[PipelineModel, kernel_grid.Descent]:
    """Scaler, Fourier features and linear SVM fitted on n prepared rows, and the walk to it."""
    whole = data.withColumn("_fold", F.lit(-1))  # no row is kept for testing
    scalings, weights = kernel_grid.fold_scalings(whole, features, WEIGHT, "_fold", 1)
    blocks = kernel_grid.lifted_blocks(
        whole.repartition(pass_tasks(data, n * dimensions)), features, LABEL, WEIGHT, "_fold", 1, scalings,
        [gamma], dimensions, seed).persist()
    try:
        walk = kernel_grid.fit_all(blocks, 1, [C], dict(enumerate(weights)), dimensions, max_iter, tol)[0, 0]
    finally:
        blocks.unpersist()
    scaling = Pipeline(stages=scaling_stages(features, n)).fit(data)
    lift = RandomFourier(
        inputCol="scaled", outputCol="fourier", gamma=float(gamma), dimensions=dimensions, seed=seed)
    svc = _svc("fourier", C, weights[0], max_iter, tol)
    return PipelineModel([*scaling.stages, lift, _svc_model(svc, walk.x[:-1], walk.x[-1])]), walk


def _svc_model(svc: LinearSVC, weights: np.ndarray, intercept: float) -> LinearSVCModel:
    """The model that the estimator would give with these coefficients."""
    context = SparkContext.getOrCreate()
    made = context._jvm.org.apache.spark.ml.classification.LinearSVCModel(
        svc.uid, _py2java(context, Vectors.dense(weights)), float(intercept))
    return svc._copyValues(LinearSVCModel(made))


def pass_tasks(df: DataFrame, cells: int) -> int:
    """Tasks of a pass over so many lifted cells: what they are worth, within a few per core."""
    most = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(cells / GRID_CELLS), most))


def search_rbf_svm(
    train: DataFrame, features: list[str], key: list[str], grid: dict | None = None,
    folds: int = CV_FOLDS, seed: int = SEED, dimensions: int = DIMENSIONS,
    max_iter: int = MAX_ITER, tol: float = TOLERANCE,
) -> Fitted:
    """Cross-validated F1 for every C and gamma, refit on all rows with the best.

    Every fold is scaled by its own training rows. `grid` on the result lists the points in order,
    C outermost.
    """
    grid = grid or RBF_GRID
    folded = assign_folds(train, LABEL, key, folds, seed)
    data = with_class_weights(folded, LABEL, WEIGHT).select(
        *[F.col(f"`{f}`") for f in features],
        F.col(LABEL).cast("double").alias(LABEL), WEIGHT, "fold",
    ).persist()
    start = time.perf_counter()
    blocks = None
    try:
        n = data.count()
        costs, gammas = grid["C"], grid["gamma"]
        widths = [gamma_value(data, features, g) for g in gammas]
        scalings, weights = kernel_grid.fold_scalings(data, features, WEIGHT, "fold", folds)
        # A block is lifted for every gamma and fold; few rows are shared out to all cores still.
        tasks = pass_tasks(data, n * dimensions * folds * len(widths))
        blocks = kernel_grid.lifted_blocks(
            data.repartition(tasks), features, LABEL, WEIGHT, "fold", folds, scalings, widths, dimensions, seed
        ).persist()
        walks = kernel_grid.fit_all(
            blocks, folds * len(widths), costs, dict(enumerate(weights * len(widths))), dimensions, max_iter, tol)
        f1 = kernel_grid.held_f1(blocks, walks, len(costs))
        results = []
        for c, cost in enumerate(costs):
            for g, gamma in enumerate(gammas):
                own = [f1.get((g * folds + f, c), 0.0) for f in range(folds)]
                results.append({"kernel": "rbf", "C": cost, "gamma": str(gamma),
                                "cv_f1_mean": float(np.mean(own)), "cv_f1_std": float(np.std(own))})
        best = max(range(len(results)), key=lambda i: (results[i]["cv_f1_mean"], -i))
        C, g = results[best]["C"], best % len(gammas)
        blocks.unpersist()
        refit, walk = _fit_lifted(data, features, n, C, widths[g], dimensions, max_iter, tol, seed)
        return Fitted(refit, features, "rbf", C, gammas[g], time.perf_counter() - start, results,
                      walk.iterations, walk.converged)
    finally:
        data.unpersist()
        if blocks is not None:
            blocks.unpersist()


# Kind of model -> the name it has in result tables, and its builder.
BENCHMARKS = {
    "logistic_regression": ("Logistic Regression", build_logistic_regression),
    "random_forest": ("Random Forest", build_random_forest),
}


def train_benchmark(kind: str, train: DataFrame, features: list[str], **settings) -> Fitted:
    if kind not in BENCHMARKS:
        raise ValueError(f"{kind!r} is none of the benchmark models {sorted(BENCHMARKS)}")
    build = BENCHMARKS[kind][1]
    tasks = (LEAST_FOREST_TASKS, FOREST_TASKS) if kind == "random_forest" else (1, MOST_TASKS)
    model, seconds = _fit(train, features, lambda held, n: build(features, n, **settings), *tasks)
    return Fitted(model, features, kind, None, None, seconds)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    try:
        spark.read.text(f"{path.rstrip('/')}/metadata")
    except AnalysisException as error:
        raise FileNotFoundError(f"{path} holds no saved pipeline") from error
    return PipelineModel.load(path)


def linear_score(fitted: Fitted) -> Column:
    """Linear SVM score as a column expression over the raw features."""
    scaler, factor, svc = fitted.model.stages[-3:]
    scale = factor.getScalingVec()
    total = F.lit(float(svc.intercept))
    for i, f in enumerate(fitted.features):
        if scaler.std[i]:
            weight = float(svc.coefficients[i] * scale[i] / scaler.std[i])
            total = total + (F.col(f"`{f}`") - F.lit(float(scaler.mean[i]))) * F.lit(weight)
    return total


def model_info(fitted: Fitted, train: DataFrame) -> dict:
    """Type, parameters and support-vector counts (rows on or inside the margin)."""
    last = fitted.model.stages[-1]
    if fitted.kernel not in ("linear", "rbf"):
        return {
            "type": type(last).__name__.removesuffix("Model").removesuffix("Classification"),
            "kernel": None, "n_features": len(fitted.features),
        }
    counts = {str(int(r["y"])): r["n"] for r in support_vectors(fitted, train).collect()}
    info = {
        "type": "SVM", "kernel": fitted.kernel, "C": float(fitted.C),
        "n_support_vectors": sum(counts.values()), "support_vectors_per_class": counts,
        "n_features": len(fitted.features),
    }
    if fitted.kernel == "rbf":
        info["gamma"] = str(fitted.gamma) if isinstance(fitted.gamma, str) else float(fitted.gamma)
    return info


def support_vectors(fitted: Fitted, train: DataFrame) -> DataFrame:
    """Rows per class with y * f(x) <= 1."""
    from flowsift.operators.scoring import decision_of

    sign = F.when(F.col(LABEL) == 1, 1.0).otherwise(-1.0)
    scored = fitted.model.transform(train)
    margin = sign * decision_of(fitted.model)
    return scored.groupBy(LABEL).agg(F.count_if(margin <= 1.0).alias("n"))


def svm_objective(df: DataFrame, y: str, score: Column, squared_norm: float, C: float) -> DataFrame:
    """What a linear SVM minimises, |w|^2 / 2 + C * sum(weight * hinge), for any score column:
    per class the rows, those on or inside the margin and their weighted hinge loss."""
    weighted = with_class_weights(df, y, "_w")
    sign = F.when(F.col(y) == 1, 1.0).otherwise(-1.0)
    hinge = F.greatest(F.lit(0.0), 1.0 - sign * score)
    per = weighted.groupBy(y).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(sign * score <= 1.0).alias("inside"),
        F.sum(F.col("_w") * hinge).alias("hinge"))
    total = per.agg(F.sum("hinge")).scalar()
    return per.withColumn("objective", F.lit(squared_norm / 2) + F.lit(float(C)) * total)


# --- multiclass -----------------------------------------------------------------


def _linear_walks(
    train: DataFrame, features: list[str], C: float, max_iter: int,
    sides: Callable[[list[int]], list[dict[int, int]]],
) -> tuple[Scaling, dict[int, int], list[dict[int, int]], list[kernel_grid.Descent]]:
    """Scaling, rows per class, the side that each model takes of each class, and the models' walks."""
    scaling = fit_scaling(train, features)
    data = with_class_weights(scaling.transform(train), LABEL, WEIGHT)
    sizes = data.groupBy(F.col(LABEL).cast("int").alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(WEIGHT).alias("w"))
    rows = {r["c"]: (r["n"], r["w"]) for r in sizes.collect()}
    n = sum(c for c, _ in rows.values())
    models = sides(sorted(rows))
    weights = [sum(rows[c][1] for c in m if c in rows) for m in models]
    tasks = max(1, min(math.ceil(n * len(features) / CELLS_PER_TASK), MOST_TASKS))
    blocks = linear_walk.class_blocks(data, features, LABEL, WEIGHT, tasks).persist()
    try:
        walks = linear_walk.fit_linear(blocks, n, models, weights, len(features), C, max_iter, TOLERANCE)
    finally:
        blocks.unpersist()
    return scaling, {c: k for c, (k, _) in rows.items()}, models, walks


def train_one_vs_rest(
    train: DataFrame, features: list[str], C: float = 1.0, max_iter: int = MAX_ITER,
) -> Fitted:
    """One linear SVM per class against the others; label `y` is the class index."""
    start = time.perf_counter()
    _, sizes, _, walks = _linear_walks(
        train, features, C, max_iter,
        lambda classes: [{c: 1 if c == k else -1 for c in classes} for k in range(max(classes) + 1)])
    n = sum(sizes.values())
    svc = _svc("scaled", C, n, max_iter, TOLERANCE)
    ovr = OneVsRest(classifier=svc, featuresCol="scaled", labelCol=LABEL, weightCol=WEIGHT)
    fitted = ovr._copyValues(OneVsRestModel([_svc_model(svc, w.x[:-1], w.x[-1]) for w in walks]))
    scaling = Pipeline(stages=scaling_stages(features, n)).fit(train)
    return Fitted(PipelineModel([*scaling.stages, fitted]), features, "linear", C, None,
                  time.perf_counter() - start, iterations=max(w.iterations for w in walks),
                  converged=all(w.converged for w in walks))


@dataclass
class PairwiseSVM:
    """One linear SVM per pair of classes; the class with most votes wins, ties go low."""

    features: list[str]
    scaling: Scaling
    classes: list[int]
    pairs: dict[tuple[int, int], tuple[list[float], float]]
    seconds: float = 0.0

    def score(self, pair: tuple[int, int]) -> Column:
        weights, intercept = self.pairs[pair]
        total = F.lit(intercept)
        for f, w in zip(self.features, weights):
            total = total + self.scaling.column(f) * F.lit(w)
        return total

    def save(self, spark: SparkSession, path: str) -> str:
        """Scaling and coefficients as JSON; load gives the model back."""
        state = {
            "features": self.features, "mean": self.scaling.mean, "std": self.scaling.std,
            "classes": self.classes,
            "pairs": [[a, b, w, c] for (a, b), (w, c) in self.pairs.items()],
        }
        return artifacts.save_metadata(spark, state, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PairwiseSVM":
        state = artifacts.load_metadata(spark, path)
        if not state:
            raise FileNotFoundError(f"{path} holds no saved pairwise model")
        scaling = Scaling(state["features"], state["mean"], state["std"])
        pairs = {(a, b): (w, c) for a, b, w, c in state["pairs"]}
        return cls(state["features"], scaling, state["classes"], pairs)

    def transform(self, df: DataFrame) -> DataFrame:
        wins = {
            f"_w{a}_{b}": F.when(self.score((a, b)) > 0, F.lit(a)).otherwise(F.lit(b))
            for a, b in self.pairs
        }
        votes = F.array(*[
            sum(((F.col(w) == c).cast("int") for w in wins), F.lit(0)) for c in self.classes
        ])
        place = F.array_position(votes, F.array_max(votes))
        named = F.element_at(F.array(*[F.lit(c) for c in self.classes]), place.cast("int"))
        return df.withColumns(wins).withColumn("prediction", named).drop(*wins)


def train_pairwise_svm(
    train: DataFrame, features: list[str], C: float = 1.0, max_iter: int = MAX_ITER,
) -> PairwiseSVM:
    """All pairs in the same passes."""
    start = time.perf_counter()
    scaling, sizes, models, walks = _linear_walks(
        train, features, C, max_iter,
        lambda classes: [{a: 1, b: -1} for a, b in combinations(classes, 2)])
    pairs = {tuple(m): ([float(x) for x in w.x[:-1]], float(w.x[-1])) for m, w in zip(models, walks)}
    return PairwiseSVM(features, scaling, sorted(sizes), pairs, time.perf_counter() - start)


# --- principal components -------------------------------------------------------


@dataclass
class Components:
    """Principal components of one table; the largest loading of each is positive."""

    features: list[str]
    mean: list[float]
    loadings: list[list[float]]
    explained: list[float]

    def column(self, k: int) -> Column:
        total = F.lit(0.0)
        for f, m, w in zip(self.features, self.mean, self.loadings[k]):
            total = total + (F.col(f"`{f}`") - F.lit(m)) * F.lit(w)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"pc{k + 1}": self.column(k) for k in range(len(self.loadings))})

    def table(self, spark: SparkSession, digits: int | None = None) -> DataFrame:
        rows = [(f"pc{k + 1}", v) for k, v in enumerate(self.explained)]
        raw = spark.createDataFrame(rows, "component string, explained_ratio double")
        return raw.withColumn("explained_ratio", display(F.col("explained_ratio"), digits))


def fit_pca(df: DataFrame, features: list[str], k: int = 2) -> Components:
    """Components and explained-variance ratios of the (already scaled) features."""
    assembled = VectorAssembler(inputCols=features, outputCol="v").transform(
        df.select(*[F.col(f"`{f}`") for f in features]))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(assembled)
    mean = list(df.agg(*[F.avg(f"`{f}`") for f in features]).first())
    loadings = []
    for column in model.pc.toArray().T:
        sign = np.sign(column[np.argmax(np.abs(column))]) or 1.0
        loadings.append([float(sign * x) for x in column])
    return Components(features, mean, loadings, [float(x) for x in model.explainedVariance])


def grid_table(spark: SparkSession, results: list[dict]) -> DataFrame:
    """Grid-search points as a table."""
    rows = [(r["kernel"], float(r["C"]), r["gamma"], float(r["cv_f1_mean"]), float(r["cv_f1_std"]))
            for r in results]
    return spark.createDataFrame(
        rows, "kernel string, C double, gamma string, cv_f1_mean double, cv_f1_std double")
