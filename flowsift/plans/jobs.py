"""Whole runs: experiments, training run, drift run."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.order import content_key
from flowsift.functions.text import encode_label
from flowsift.operators import metrics as M
from flowsift.operators import models
from flowsift.operators.clean import (
    add_category,
    class_distribution,
    clean_flows,
    counted_report,
    drop_unusable,
    read_cleaned,
    write_deduped,
)
from flowsift.operators.features import fit_scaling, index_labels, label_index
from flowsift.operators.importance import linear_coefficients, model_permutation_importance
from flowsift.operators.sampling import stratified_sample, train_test_split
from flowsift.operators.scoring import decision_of
from flowsift.operators.stats import distribution_comparison, perturb_columns
from flowsift.session import landed
from flowsift.sources import artifacts
from flowsift.sources.flow_files import (
    CORRUPT,
    ROW_ID,
    fingerprint_columns,
    read_flow_csv,
    read_flow_files,
    shape_flows,
    split_corrupt,
)
from flowsift.sources.observed import write_observed
from flowsift.spec import DEFAULT_SPEC, SAMPLE_SIZE, SEED, FlowSpec

RESULT = (
    "model string, kernel string, C string, gamma string, train_time double, "
    "iterations int, converged boolean, accuracy double, precision double, recall double, f1 double"
)
LINEAR, RBF = "Linear SVM", "RBF SVM (best)"
KEY = "_key"  # content key of a cleaned row


@dataclass
class BinaryRun:
    best_name: str
    best: models.Fitted
    metrics: dict
    comparison: DataFrame
    sweep: DataFrame
    report: DataFrame
    importance: DataFrame
    pca: models.Components
    projection: DataFrame
    grid: list[dict] = field(default_factory=list)


def scored_rows(fitted: models.Fitted, test: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Label, prediction and decision score of labelled rows, written once: metrics, sweep and
    report read them without running the model again."""
    scored = fitted.model.transform(test).select(
        *keep, models.LABEL, "prediction", decision_of(fitted.model).alias("decision_score"))
    return landed(scored, "scored")


def evaluate(fitted: models.Fitted, test: DataFrame) -> dict:
    """Metrics and confusion counts of a fitted model on labelled rows."""
    return measure(fitted.model.transform(test))


def measure(scored: DataFrame) -> dict:
    return M.binary_metrics(scored, models.LABEL, "prediction").first().asDict()


def result_row(spark: SparkSession, name: str, fitted: models.Fitted, m: dict) -> DataFrame:
    svm = fitted.kernel in ("linear", "rbf")
    row = (
        name, fitted.kernel if svm else "N/A", str(fitted.C) if svm else "N/A",
        str(fitted.gamma) if fitted.gamma is not None else "N/A", float(fitted.seconds),
        fitted.iterations, fitted.converged,
        m["accuracy"], m["precision"], m["recall"], m["f1"],
    )
    return spark.createDataFrame([row], RESULT)


def binary_experiment(
    train: DataFrame, test: DataFrame, features: list[str], key: list[str],
    grid: dict | None = None, seed: int = SEED, repeats: int = 10, **settings,
) -> BinaryRun:
    """Linear SVM against the best RBF SVM; the winner is evaluated in full."""
    spark = train.sparkSession
    linear_settings = {k: v for k, v in settings.items() if k in ("max_iter", "tol")}
    fits = {
        LINEAR: models.train_linear_svm(train, features, 1.0, **linear_settings),
        RBF: models.search_rbf_svm(train, features, key, grid, seed=seed, **settings),
    }
    scores = {name: scored_rows(f, test) for name, f in fits.items()}
    measured = {name: measure(rows) for name, rows in scores.items()}
    comparison = M.compare_models([result_row(spark, n, fits[n], measured[n]) for n in fits])
    best_name = M.best_model(comparison, [LINEAR, RBF]).first()["model"]
    best = fits[best_name]
    scored = scores[best_name]
    if best.kernel == "linear":
        weights = best.model.stages[-1].coefficients
        importance = linear_coefficients(spark, features, list(weights))
    else:
        importance = model_permutation_importance(
            test, features, models.LABEL, key, best.model, repeats, seed)
    scaled = fit_scaling(train, features).transform(test)
    pca = models.fit_pca(scaled, features)
    return BinaryRun(
        best_name, best, measured[best_name], comparison,
        M.threshold_sweep(scored, "decision_score", models.LABEL),
        M.classification_report(scored, models.LABEL, "prediction"),
        importance, pca, pca.transform(scaled).select(*key, models.LABEL, "pc1", "pc2"),
        fits[RBF].grid,
    )


def benchmark_experiment(
    train: DataFrame, test: DataFrame, features: list[str], settings: dict | None = None
) -> DataFrame:
    """Logistic regression and random forest result rows."""
    rows = []
    for kind, (name, _) in models.BENCHMARKS.items():
        fitted = models.train_benchmark(kind, train, features, **(settings or {}).get(kind, {}))
        rows.append(result_row(train.sparkSession, name, fitted, evaluate(fitted, test)))
    return M.compare_models(rows)


def ablation_subsets(features: list[str], spec: FlowSpec) -> list[tuple[str, str, list[str]]]:
    """Name, description and features of every ablation that leaves two features or more."""
    subsets = [(name, text, [f for f in spec.without_groups(excluded) if f in features])
               for name, (text, excluded) in spec.ablations.items()]
    return [s for s in subsets if len(s[2]) >= 2]


def ablation_experiment(
    train: DataFrame, test: DataFrame, features: list[str], spec: FlowSpec, **settings
) -> DataFrame:
    """Linear SVM per feature subset on the same split; subsets below two features are left out."""
    rows = []
    for name, description, subset in ablation_subsets(features, spec):
        fitted = models.train_linear_svm(train, subset, **settings)
        m = evaluate(fitted, test)
        rows.append((name, description, len(subset), subset, m["accuracy"], m["precision"],
                     m["recall"], m["f1"], fitted.seconds))
    return train.sparkSession.createDataFrame(
        rows, "ablation string, description string, n_features int, features array<string>, "
              "accuracy double, precision double, recall double, f1 double, train_time double")


def multiclass_experiment(
    sample: DataFrame, features: list[str], key: list[str], spec: FlowSpec, seed: int = SEED,
    **settings,
) -> tuple[DataFrame, DataFrame, DataFrame, models.PairwiseSVM] | None:
    """Pairwise linear SVM over the attack categories: metrics, report, confusion counts, model.

    None when there are not more than two categories.
    """
    named = add_category(sample, "category", spec)
    if label_index(named, "category").count() <= 2:
        return None
    indexed = index_labels(named, "category", models.LABEL)
    split = train_test_split(indexed, key, models.LABEL, seed=seed)
    fitted = models.train_pairwise_svm(split.where("not is_test"), features, **settings)
    scored = landed(
        fitted.transform(split.where("is_test")).select(models.LABEL, "prediction"), "scored")
    return (
        M.multiclass_metrics(scored, models.LABEL, "prediction"),
        M.classification_report(scored, models.LABEL, "prediction"),
        M.confusion_long(scored, models.LABEL, "prediction"),
        fitted,
    )


def drift_run(
    sample: DataFrame, features: list[str], key: list[str], fitted: models.Fitted,
    magnitude: float = 1.5, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Distribution comparison and metric impact between test rows and perturbed test rows."""
    test = train_test_split(sample, key, models.LABEL, seed=seed).where("is_test")
    shifted = perturb_columns(test, features, key, magnitude, seed)
    score = lambda df: fitted.model.transform(df).select(models.LABEL, "prediction")
    return (
        distribution_comparison(test, shifted, features),
        M.drift_impact(score(test), score(shifted), models.LABEL, "prediction"),
    )


def land_input(raw: DataFrame, path: str) -> tuple[DataFrame, dict]:
    """Parsed rows, written once, with the number of malformed lines and the fingerprint of all rows,
    whatever the number of files: the files are parsed in one pass."""
    rows, fingerprint = fingerprint_columns(raw, [c for c in raw.columns if c != ROW_ID])
    return write_observed(raw, path, {
        "rows": rows, "fingerprint": fingerprint, "corrupt": F.count(F.col(CORRUPT))})


def training_sample(
    cleaned: DataFrame, features: list[str], spec: FlowSpec, size: int, seed: int = SEED
) -> DataFrame:
    """Sample of cleaned rows with `y` and `is_test`.

    Cleaned rows differ in features or label, so a hash of these is their key: sample, split
    and folds depend on the rows alone, not on files, folders or partitions.
    """
    key = content_key(cleaned, [*features, spec.label_col])
    # Landed, as the split reads it several times: each time would search the whole table again.
    sample = landed(stratified_sample(
        cleaned.drop(ROW_ID).withColumn(KEY, key), size, spec.label_col, [KEY], seed), "sampled")
    encoded = sample.withColumn(models.LABEL, encode_label(F.col(f"`{spec.label_col}`")))
    return train_test_split(encoded, [KEY], models.LABEL, seed=seed)


def training_run(
    spark: SparkSession, path: str, out: str, spec: FlowSpec = DEFAULT_SPEC,
    sample_size: int = SAMPLE_SIZE, seed: int = SEED, benchmark: bool = False,
    multiclass: bool = False, ablation: bool = False, grid: dict | None = None,
    repeats: int = 10, run_id: str | None = None, **settings,
) -> str:
    """Load, clean, sample, split, train, evaluate and save everything under `out`.

    Every stage writes its tables and then its record, which cuts the lineage before the iterative
    fits; started again with the id of a run that was cut short, it goes on with the first stage
    that has no record. Malformed lines go to `quarantine`. Returns the run id.
    """
    run_id = run_id or artifacts.new_run_id(spark)
    home = f"{out.rstrip('/')}/{run_id}"
    stages = artifacts.Stages(spark, home)
    fit_settings = {k: v for k, v in settings.items() if k in ("max_iter", "tol")}

    def load() -> dict:
        parsed, known = land_input(read_flow_files(spark, path), f"{home}/parsed")
        if known["corrupt"]:
            split_corrupt(parsed)[1].write.mode("overwrite").parquet(f"{home}/quarantine")
        return known

    known = stages.run("input", load)

    def clean() -> dict:
        good, _ = split_corrupt(spark.read.parquet(f"{home}/parsed"))
        flows, features, missing = shape_flows(good, spec, [ROW_ID])
        cleaned, counts = write_deduped(
            clean_flows(flows, features, [ROW_ID], spec), features, f"{home}/deduped", spec)
        report = counted_report(
            spark, counts, features, missing, spec, path, known["fingerprint"], known["corrupt"])
        written = artifacts.write_json(report, f"{home}/validation_report")
        artifacts.write_csv(
            class_distribution(cleaned, spec.original_label_col), f"{home}/original_class_distribution")
        read = artifacts.read_json(spark, written, report.schema)
        return {"features": features, "report": read.first().asDict(recursive=True)}

    cleaned = stages.run("cleaned", clean)
    features, report = cleaned["features"], cleaned["report"]

    def draw() -> dict:
        training_sample(
            read_cleaned(spark, f"{home}/deduped"), features, spec, sample_size, seed
        ).write.mode("overwrite").parquet(f"{home}/sample")
        counts = spark.read.parquet(f"{home}/sample").groupBy("is_test").count().collect()
        sizes = {r["is_test"]: r["count"] for r in counts}
        return {"train_size": sizes.get(False, 0), "test_size": sizes.get(True, 0)}

    sizes = stages.run("sample", draw)
    sample = spark.read.parquet(f"{home}/sample")
    train, test = sample.where("not is_test"), sample.where("is_test")

    def binary() -> dict:
        run = binary_experiment(train, test, features, [KEY], grid, seed, repeats, **settings)
        artifacts.write_csv(run.sweep, f"{home}/threshold_analysis")
        artifacts.write_csv(run.report, f"{home}/classification_report")
        artifacts.write_csv(run.importance, f"{home}/feature_importance")
        run.projection.drop(KEY).write.mode("overwrite").parquet(f"{home}/pca_projection")
        artifacts.write_json(artifacts.record(spark, run.metrics), f"{home}/metrics")
        models.save_model(run.best.model, f"{home}/model")
        return {
            "best_model": run.best_name, "results": [r.asDict() for r in run.comparison.collect()],
            "rbf_search": run.grid, "metrics": run.metrics,
            "model_info": models.model_info(run.best, train), "explained_variance": run.pca.explained,
        }

    chosen = stages.run("binary", binary)
    results = chosen.pop("results")
    if benchmark:
        results += stages.run("benchmark", lambda: [
            r.asDict() for r in benchmark_experiment(train, test, features).collect()])
    table = spark.createDataFrame([tuple(r.values()) for r in results], RESULT)
    comparison = M.compare_models([table])
    extra = {}
    if multiclass:
        extra = stages.run("multiclass", lambda: _multiclass_stage(
            spark, sample, features, spec, seed, home, fit_settings))
    if ablation:
        stages.run("ablation", lambda: artifacts.write_json(
            ablation_experiment(train, test, features, spec, **fit_settings), f"{home}/ablation"))

    artifacts.write_csv(comparison, f"{home}/model_comparison")
    meta = stages.run("metadata", lambda: {
        "experiment_id": run_id,
        "timestamp": artifacts.utc_now(spark),
        "dataset": path,
        "random_state": seed,
        "sample_size": sample_size,
        "features": features,
        "label_mapping": {"BENIGN": 0, "ATTACK": 1},
        **sizes,
        **chosen,
        "results": [r.asDict() for r in comparison.collect()],
        "validation_report": report,
        **extra,
    })
    artifacts.save_metadata(spark, meta, f"{home}/metadata")
    artifacts.save_metadata(spark, training_summary(meta), f"{home}/training_summary")
    artifacts.save_run(
        spark, f"{out.rstrip('/')}/runs", run_id, config=meta, metrics=meta["metrics"],
        features={"features": features, "count": len(features)})
    return run_id


def _multiclass_stage(
    spark: SparkSession, sample: DataFrame, features: list[str], spec: FlowSpec, seed: int, home: str,
    settings: dict,
) -> dict:
    try:
        done = multiclass_experiment(
            sample.drop("is_test", models.LABEL), features, [KEY], spec, seed,
            **{k: v for k, v in settings.items() if k == "max_iter"})
    except PySparkException as error:
        return {"multiclass_error": str(error)}
    if not done:
        return {}
    artifacts.write_json(done[0], f"{home}/multiclass_metrics")
    artifacts.write_csv(done[1], f"{home}/multiclass_report")
    artifacts.write_csv(done[2], f"{home}/multiclass_confusion")
    done[3].save(spark, f"{home}/multiclass_model")
    return {"multiclass": done[0].first().asDict()}


def training_summary(meta: dict) -> dict:
    """What a reader of a run wants first: data, models side by side, the chosen one."""
    report = meta["validation_report"]
    return {
        "experiment_id": meta["experiment_id"], "dataset": meta["dataset"],
        "rows": {k: report[k] for k in ("raw_rows", "cleaned_rows", "corrupt_rows")},
        "classes": report["class_distribution"],
        "train_size": meta["train_size"], "test_size": meta["test_size"],
        "models": {r["model"]: {k: r[k] for k in ("f1", "train_time", "iterations", "converged")}
                   for r in meta["results"]},
        "best_model": meta["best_model"], "metrics": meta["metrics"],
    }


def score_file(spark: SparkSession, path: str, model_path: str, features: list[str]) -> DataFrame:
    """Score every line of a CSV file with a saved model. Unusable rows keep a NULL score, and so
    do malformed lines, which stand in `_corrupt` and have no values."""
    from flowsift.operators.scoring import require_columns, score_with_model

    rows = require_columns(read_flow_csv(spark, path), features)
    broken = F.col(CORRUPT).isNotNull()
    values = [c for c in rows.columns if c not in (CORRUPT, ROW_ID)]
    rows = rows.withColumns({c: F.when(~broken, F.col(f"`{c}`")) for c in values})
    return score_with_model(rows, models.load_model(spark, model_path), features).drop(ROW_ID)


def cleaned_for_training(
    flows: DataFrame, features: list[str], key: list[str], spec: FlowSpec
) -> DataFrame:
    """Cleaned rows with the encoded label `y`."""
    cleaned = drop_unusable(clean_flows(flows, features, key, spec), features)
    return cleaned.withColumn(models.LABEL, encode_label(F.col(f"`{spec.label_col}`")))
