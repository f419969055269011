"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.numeric import finite, is_infinite, nan_to_null, to_number
from flowsift.functions.text import binary_label, category_label, decode_label, encode_label
from flowsift.operators import clean, features, importance, metrics, models, sampling, scoring, stats
from flowsift.plans import jobs
from flowsift.plans import tables as T
from flowsift.session import landed, scratch_path
from flowsift.sources import artifacts, flow_files
from flowsift.streaming import flows as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SAMPLE, PER_CLASS, ANY, TRAINING = 20000, 2000, 5000, 1500
SPLIT_DAY, SPLIT_YEAR = "2024-01-16", 1998


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- labels, coercion, cleaning -------------------------------------------------


@query
def flow_label_binary(spark, sf):
    return T.labelled_flows(spark, sf).select(
        *T.EV_KEY, "raw_label", binary_label(F.col("raw_label")).alias("label"))


@query
def flow_label_multiclass(spark, sf):
    return T.labelled_flows(spark, sf).select(
        *T.EV_KEY, "raw_label", category_label(F.col("raw_label")).alias("category"))


@query
def flow_coerce(spark, sf):
    texts = T.event_texts(spark, sf)
    number = to_number(F.col("raw"))
    return texts.select(
        "event_id", finite(number).alias("value"), is_infinite(number).alias("infinite"),
        number.isNull().alias("missing"))


def _deduped(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_flows(T.event_flows(spark, sf), T.EV_FEATURES, T.EV_KEY, T.EV_SPEC)


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_unusable(_deduped(spark, sf), T.EV_FEATURES)


@query
def flow_dedupe(spark, sf):
    return _deduped(spark, sf).select(
        *T.EV_KEY, *[finite(F.col(f)).alias(f) for f in T.EV_FEATURES],
        is_infinite(F.col("bytes_s")).alias("bytes_s_infinite"),
        F.col("raw_label").alias("label"), "original_label", "copies")


@query
def flow_dup_count(spark, sf):
    labelled = clean.coerce_features(
        clean.label_flows(T.event_flows(spark, sf), T.EV_SPEC), T.EV_FEATURES)
    return clean.duplicate_count(labelled, [*T.EV_FEATURES, "raw_label"])


@query
def flow_clean(spark, sf):
    return _cleaned(spark, sf).select(
        *T.EV_FEATURES, F.col("raw_label").alias("label"), "original_label")


@query
def flow_clean_report(spark, sf):
    return clean.clean_report(_deduped(spark, sf), T.EV_FEATURES)


@query
def flow_report_observed(spark, sf):
    """The report's counts, taken by the job that writes the de-duplicated flows."""
    _, counts = clean.write_deduped(
        _deduped(spark, sf), T.EV_FEATURES, scratch_path(spark, "deduped"), T.EV_SPEC)
    report = clean.counted_report(spark, counts, T.EV_FEATURES, [], T.EV_SPEC)
    return report.select("raw_rows", "cleaned_rows", "removed_rows", "duplicates_removed",
                         "inf_replaced", "nan_rows_dropped")


def _pairs(c: str) -> Column:
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ";").alias(c)


@query
def flow_validation_report(spark, sf):
    """The whole report in one row; lists and maps written out as text."""
    found, missing = flow_files.resolve_features(T.event_flows(spark, sf).columns, T.EV_SPEC)
    report = clean.validation_report(_deduped(spark, sf), list(found), missing, T.EV_SPEC)
    counts = ["raw_rows", "cleaned_rows", "removed_rows", "duplicates_removed", "inf_replaced",
              "nan_rows_dropped"]
    return report.select(
        *counts, F.array_join("features_missing", ";").alias("features_missing"),
        "num_features", _pairs("class_distribution"), "imbalance_ratio")


@query
def class_distribution(spark, sf):
    return clean.class_distribution(_cleaned(spark, sf), "raw_label")


@query
def class_distribution_items(spark, sf):
    return clean.class_distribution(T.lineitem_flows(spark, sf), "l_returnflag")


@query
def original_class_distribution(spark, sf):
    return clean.class_distribution(_cleaned(spark, sf), "original_label")


@query
def imbalance_ratio(spark, sf):
    return clean.imbalance(_cleaned(spark, sf), "raw_label")


@query
def encode_labels(spark, sf):
    flows = T.labelled_flows(spark, sf).withColumn("label", binary_label(F.col("raw_label")))
    code = encode_label(F.col("label"))
    return flows.select(*T.EV_KEY, "label", code.alias("code"), decode_label(code).alias("back"))


@query
def multiclass_index(spark, sf):
    labelled = clean.label_flows(T.labelled_flows(spark, sf), T.EV_SPEC)
    return features.index_labels(labelled, "original_label", "code").select(
        *T.EV_KEY, "original_label", "code")


@query
def ablation_projection(spark, sf):
    flows = T.event_flows(spark, sf)
    subset = [f for f in T.EV_SPEC.without_groups(["flow_rates", "tcp_flags"]) if f in flows.columns]
    return features.project_xy(flows, subset, "raw_label", T.EV_KEY)


@query
def feature_inventory(spark, sf):
    """Status of every feature of the spec, with how many usable values it has."""
    flows = T.event_flows(spark, sf)
    found, _ = flow_files.resolve_features(flows.columns, T.EV_SPEC)
    names = list(found)
    counts = flows.agg(*[F.count(finite(F.col(f))).alias(f) for f in names])
    long = counts.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("usable")) for f in names])))
    return features.feature_inventory(spark, names, T.EV_SPEC).join(long, "feature", "left")


@query
def validate_records(spark, sf):
    checked = scoring.validate_records(T.event_records(spark, sf), "record", ["k", "amount"])
    return checked.select(
        "event_id", "is_valid", F.array_join("missing_features", ";").alias("missing"),
        F.array_join("invalid_features", ";").alias("invalid"))


@query
def table_fingerprint(spark, sf):
    li = T.table(spark, sf, "lineitem")
    li = li.withColumn("l_shipdate", F.unix_micros(F.col("l_shipdate").cast("timestamp")))
    return flow_files.row_fingerprint(li, T.LI_COLUMNS)


@query
def file_fingerprints(spark, sf):
    return flow_files.file_fingerprints(spark, sf, "*.parquet")


def _flow_csv(spark: SparkSession, sf: str) -> str:
    """Flows in key order as CSV files with blank-padded names."""
    path = scratch_path(spark, "flows-csv")
    flows = T.event_flows(spark, sf).orderBy(*T.EV_KEY)
    messy = flows.select(
        *[F.col(f).alias(f" {f} ") for f in T.EV_FEATURES], F.col("raw_label").alias(" Raw Label "))
    (messy.write.option("header", True).option("encoding", "ISO-8859-1")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _ragged_csv(spark: SparkSession, sf: str) -> str:
    """Flow keys and sums as CSV lines, some with a field too many and some with one too few;
    every file has a header."""
    path = scratch_path(spark, "ragged-csv")
    short = F.concat_ws(",", "user_id", "flow_day")
    line = F.concat(short, F.lit(","), F.col("tot_fwd").cast("int").cast("string"))
    kind = F.col("user_id") % 7
    lines = T.event_flows(spark, sf).where("copy_no = 0").select(
        F.when(kind == 1, F.concat(line, F.lit(",surplus"))).when(kind == 2, short).otherwise(line)
        .alias("value"))

    def with_header(batches):
        first = True
        for batch in batches:
            if first:
                batch = pd.concat([pd.DataFrame({"value": ["user_id,flow_day,Label"]}), batch])
                first = False
            yield batch

    lines.mapInPandas(with_header, "value string").write.text(path)
    return path


@query
def csv_ragged_rows(spark, sf):
    """Lines of a CSV with malformed ones among them: values, or the whole line as it stands."""
    rows = flow_files.read_flow_csv(spark, _ragged_csv(spark, sf))
    good, bad = flow_files.split_corrupt(rows)
    return good.select("user_id", "flow_day", F.lit(None).cast("string").alias("line")).unionByName(
        bad.select(F.lit(None).cast("string").alias("user_id"),
                   F.lit(None).cast("string").alias("flow_day"), "line"))


def _daily_csv(spark: SparkSession, sf: str) -> str:
    """Flows as the files of three kinds of days, by day of the month: columns as they are; in
    another order, blank-padded and one more; and without counts of acknowledgements."""
    path = scratch_path(spark, "daily-csv")
    flows = T.event_flows(spark, sf).withColumn("_day", F.col("flow_day").substr(9, 2).cast("int") % 3)
    names = [*T.EV_KEY, *T.EV_FEATURES, "raw_label"]
    kinds = [
        [F.col(c) for c in names],
        [F.lit("x").alias("surplus"), *[F.col(c).alias(f" {c.upper()} ") for c in reversed(names)]],
        [F.col(c) for c in names if c != "ack"],
    ]
    for k, columns in enumerate(kinds):
        (flows.where(F.col("_day") == k).select(*columns).write.option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{path}/day={k}"))
    return f"{path}/day=*/*.csv"


@query
def csv_mixed_headers(spark, sf):
    """Daily exports whose headers differ, read as one table by column name."""
    found = flow_files.discover(spark, _daily_csv(spark, sf), sf, "flows.csv")
    good, _ = flow_files.split_corrupt(flow_files.read_flow_files(spark, found))
    number = lambda c: to_number(F.col(c))
    return good.select(
        number("user_id").cast("bigint").alias("user_id"), "flow_day",
        number("copy_no").cast("bigint").alias("copy_no"), *[number(f).alias(f) for f in (
            "flow_duration", "tot_fwd", "len_fwd", "rst", "ack")], "raw_label", "surplus")


@query
def training_sample(spark, sf):
    """Sample and split of the training run, from the flow CSV; keyed by what the rows hold."""
    shaped, names, _ = flow_files.shape_flows(flow_files.split_corrupt(
        flow_files.read_flow_csv(spark, _flow_csv(spark, sf)))[0], T.EV_SPEC, [flow_files.ROW_ID])
    deduped = clean.clean_flows(shaped, names, [flow_files.ROW_ID], T.EV_SPEC)
    sample = jobs.training_sample(
        landed(clean.drop_unusable(deduped, names), "cleaned"), names, T.EV_SPEC, TRAINING)
    return sample.select(jobs.KEY, F.col("raw_label").alias("label"), models.LABEL, "is_test")


@query
def csv_scan_clean(spark, sf):
    """Flows written as a messy CSV, read back, resolved and cleaned."""
    shaped, names, _ = flow_files.shape_flows(flow_files.split_corrupt(
        flow_files.read_flow_csv(spark, _flow_csv(spark, sf)))[0], T.EV_SPEC, [flow_files.ROW_ID])
    deduped = clean.clean_flows(shaped, names, [flow_files.ROW_ID], T.EV_SPEC)
    return clean.drop_unusable(deduped, names).select(
        *names, F.col("raw_label").alias("label"), "original_label")


# --- sampling -------------------------------------------------------------------


@query
def stratified_sample(spark, sf):
    li = T.lineitem_flows(spark, sf)
    return sampling.stratified_sample(li, SAMPLE, "l_returnflag", T.LI_KEY)


@query
def stratified_sample_flows(spark, sf):
    """A tenth of the default size from the skewed flow classes."""
    flows = T.event_flows(spark, sf).withColumn("label", binary_label(F.col("raw_label")))
    return sampling.stratified_sample(flows, 2000, "label", T.EV_KEY).select(*T.EV_KEY, "label")


@query
def topn_sample_per_class(spark, sf):
    li = T.lineitem_flows(spark, sf)
    return sampling.top_n_sample(li, PER_CLASS, T.LI_KEY, "l_returnflag")


@query
def topn_sample(spark, sf):
    return sampling.top_n_sample(T.lineitem_flows(spark, sf), ANY, T.LI_KEY)


@query
def shuffled_rows(spark, sf):
    return sampling.shuffle_rows(T.lineitem_flows(spark, sf), T.LI_KEY)


@query
def stratified_split(spark, sf):
    li = T.lineitem_flows(spark, sf)
    return sampling.train_test_split(li, T.LI_KEY, "l_returnflag").select(
        "row_key", "l_returnflag", "is_test")


@query
def plain_split(spark, sf):
    return sampling.train_test_split(T.lineitem_flows(spark, sf), T.LI_KEY, test_size=0.3).select(
        "row_key", "is_test")


@query
def stratified_folds(spark, sf):
    li = T.lineitem_flows(spark, sf)
    return sampling.assign_folds(li, "l_returnflag", T.LI_KEY).select(
        "row_key", "l_returnflag", "fold")


# --- weights, scaling, statistics -----------------------------------------------


@query
def class_weights(spark, sf):
    return features.class_weights(T.lineitem_flows(spark, sf), "l_returnflag")


@query
def weighted_rows(spark, sf):
    labelled = clean.label_flows(T.event_flows(spark, sf), T.EV_SPEC)
    return features.with_class_weights(labelled, "raw_label").select(
        *T.EV_KEY, "raw_label", "weight")


@query
def standardize(spark, sf):
    li = T.lineitem_flows(spark, sf)
    scaled = features.fit_scaling(li, T.LI_FEATURES).transform(li)
    return scaled.select("row_key", *[F.round(f, 6).alias(f) for f in T.LI_FEATURES])


@query
def cell_variance(spark, sf):
    li = T.lineitem_flows(spark, sf)
    li = li.withColumn("l_extendedprice", F.col("l_extendedprice") / 1000)
    out = features.cell_variance(li, T.LI_FEATURES)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query
def feature_statistics(spark, sf):
    return stats.feature_statistics(T.lineitem_flows(spark, sf), T.LI_FEATURES, 4)


@query
def feature_statistics_flows(spark, sf):
    return stats.feature_statistics(_cleaned(spark, sf), T.EV_FEATURES, 3)


@query
def distribution_compare(spark, sf):
    li = T.lineitem_flows(spark, sf)
    year = F.col("ship_year")
    return stats.compare_sides(li, year < SPLIT_YEAR, year >= SPLIT_YEAR, T.LI_FEATURES, (4, 2))


@query
def distribution_compare_tables(spark, sf):
    """The same comparison for two tables: flows of two periods."""
    flows = _cleaned(spark, sf)
    day = F.col("flow_day")
    return stats.distribution_comparison(
        flows.where(day < SPLIT_DAY), flows.where(day >= SPLIT_DAY), T.EV_FEATURES, (1, 2))


@query
def top_changed_features(spark, sf):
    changed = distribution_compare_tables(spark, sf)
    return metrics.top_k(changed, "mean_change_pct", 3).select("feature", "mean_change_pct")


@query
def perturb_columns(spark, sf):
    li = T.lineitem_flows(spark, sf)
    noisy = stats.perturb_columns(li, T.LI_FEATURES, T.LI_KEY, 1.5)
    return noisy.select("row_key", *[F.round(f, 5).alias(f) for f in T.LI_FEATURES])


@query
def covariance_matrix(spark, sf):
    li = T.lineitem_flows(spark, sf).withColumn("l_extendedprice", F.col("l_extendedprice") / 1000)
    out = stats.covariance_matrix(li, T.LI_FEATURES)
    return out.withColumn("covariance", F.round("covariance", 6))


# --- metrics --------------------------------------------------------------------


@query
def confusion_binary(spark, sf):
    return metrics.confusion_binary(T.scored_flows(spark, sf), "y", "p")


@query
def metrics_binary(spark, sf):
    return metrics.binary_metrics(T.scored_flows(spark, sf), "y", "p")


@query
def metrics_per_day(spark, sf):
    return metrics.binary_metrics(T.scored_flows(spark, sf), "y", "p", ["flow_day"])


@query
def classification_report(spark, sf):
    out = metrics.classification_report(T.category_flows(spark, sf), "truth", "called")
    return out.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")],
                      "support")


@query
def confusion_multiclass(spark, sf):
    return metrics.confusion_long(T.category_flows(spark, sf), "truth", "called")


@query
def confusion_pivot(spark, sf):
    return metrics.confusion_matrix(T.category_flows(spark, sf), "truth", "called")


@query
def metrics_multiclass(spark, sf):
    return metrics.multiclass_metrics(T.category_flows(spark, sf), "truth", "called", 9)


@query
def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(T.scored_flows(spark, sf), "score", "y")


@query
def drift_impact(spark, sf):
    day = F.col("flow_day")
    return metrics.impact_of_sides(
        T.scored_flows(spark, sf), day < SPLIT_DAY, day >= SPLIT_DAY, "y", "p")


def _model_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three fixed scorers, compared in one pass over the flows."""
    scored = T.scored_flows(spark, sf)
    rules = {
        "combined": F.col("p"),
        "resets": (F.col("rst") >= 2).cast("int"),
        "volume": (F.col("len_fwd") + F.col("len_bwd") > 400).cast("int"),
    }
    long = scored.select("y", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), c.alias("called")) for n, c in rules.items()])))
    return metrics.binary_metrics(long, "y", "called", ["model"])


@query
def model_compare(spark, sf):
    return _model_rows(spark, sf)


@query
def model_compare_best(spark, sf):
    return metrics.best_model(_model_rows(spark, sf), ["combined", "resets", "volume"])


# --- scoring --------------------------------------------------------------------


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    used = [*T.SCORE_FEATURES, "bytes_s"]
    return scoring.score_rows(T.event_flows(spark, sf), used, T.fixed_score())


@query
def score_batch(spark, sf):
    return _batch(spark, sf).select(
        *T.EV_KEY, *T.SCORE_FEATURES, nan_to_null(F.col("bytes_s")).alias("bytes_s"),
        "decision_score", "prediction")


@query
def score_summary(spark, sf):
    return scoring.score_summary(_batch(spark, sf))


@query
def score_summary_observed(spark, sf):
    """The same summary, taken by the job that writes the scored flows."""
    _, counts = scoring.write_scored(_batch(spark, sf), scratch_path(spark, "scored"))
    schema = ", ".join(f"{k} bigint" for k in counts)
    return spark.createDataFrame([tuple(counts.values())], schema)


@query
def permutation_importance(spark, sf):
    flows = T.scored_flows(spark, sf)
    names = [*T.SCORE_FEATURES, "ack"]
    out = importance.permutation_importance(flows, names, "y", T.EV_KEY, T.fixed_score)
    return out.select("feature", *[
        F.round(c, 9).alias(c) for c in ("importance_mean", "importance_std")])


# --- artifacts ------------------------------------------------------------------


@query
def artifact_csv(spark, sf):
    """Threshold table written as CSV and read back."""
    sweep = threshold_sweep(spark, sf)
    path = artifacts.write_csv(sweep, scratch_path(spark, "sweep"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sweep.schema)
    return artifacts.read_csv(spark, path, schema)


@query
def artifact_json(spark, sf):
    """Metrics written as JSON and read back."""
    m = metrics_binary(spark, sf)
    return artifacts.read_json(
        spark, artifacts.write_json(m, scratch_path(spark, "metrics")), m.schema)


@query
def experiment_runs(spark, sf):
    """One run per flow day, with its class counts as metrics; other folders are ignored."""
    daily = T.scored_flows(spark, sf).groupBy("flow_day").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("attacks"))
    parts = F.array(
        F.struct(F.concat(F.lit("EXP-"), "flow_day").alias("experiment_id"),
                 F.lit("metrics").alias("kind"),
                 F.to_json(F.struct("n", "attacks")).alias("payload")),
        F.struct(F.concat(F.lit("TMP-"), "flow_day").alias("experiment_id"),
                 F.lit("metrics").alias("kind"), F.lit("{}").alias("payload")),
    )
    root = scratch_path(spark, "runs")
    artifacts.append_runs(daily.select(F.inline(parts)), root)
    return artifacts.list_runs(spark, root).select("experiment_id", "config", "metrics")


# --- fitted models --------------------------------------------------------------


def _split_flows(spark: SparkSession, sf: str) -> DataFrame:
    flows = landed(
        jobs.cleaned_for_training(T.event_flows(spark, sf), T.EV_FEATURES, T.EV_KEY, T.EV_SPEC),
        "cleaned")
    return landed(sampling.train_test_split(flows, T.EV_KEY, models.LABEL), "split")


def _scores(split: DataFrame, fitted: models.Fitted) -> DataFrame:
    return scoring.score_with_model(split, fitted.model, fitted.features).select(
        *T.EV_KEY, "is_test", models.LABEL, "decision_score", "prediction")


@query
def linear_svm_scores(spark, sf):
    split = _split_flows(spark, sf)
    return _scores(split, models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES))


@query
def saved_model_scores(spark, sf):
    """Linear SVM saved, loaded and used for scoring; also as a plain column expression."""
    split = _split_flows(spark, sf)
    fitted = models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES)
    path = models.save_model(fitted.model, scratch_path(spark, "model"))
    scored = scoring.score_with_model(split, models.load_model(spark, path), T.EV_FEATURES)
    return scored.withColumn("column_score", models.linear_score(fitted)).select(
        *T.EV_KEY, "decision_score", "column_score", "prediction")


@query
def score_csv_file(spark, sf):
    """Every row of the flow CSV scored with a saved logistic regression."""
    train = _split_flows(spark, sf).where("not is_test")
    fitted = models.train_benchmark("logistic_regression", train, T.EV_FEATURES)
    saved = models.save_model(fitted.model, scratch_path(spark, "model"))
    return jobs.score_file(spark, _flow_csv(spark, sf), saved, T.EV_FEATURES).drop("Raw Label")


@query
def training_run(spark, sf):
    """The whole training run on the flow CSV with all its parts: its listed metrics."""
    out = scratch_path(spark, "training")
    jobs.training_run(spark, _flow_csv(spark, sf), out, T.EV_SPEC, benchmark=True, multiclass=True,
                      ablation=True)
    return artifacts.list_runs(spark, f"{out}/runs").select("metrics", "features")


@query
def logreg_scores(spark, sf):
    split = _split_flows(spark, sf)
    return _scores(split, models.train_benchmark(
        "logistic_regression", split.where("not is_test"), T.EV_FEATURES))


@query
def rf_scores(spark, sf):
    split = _split_flows(spark, sf)
    return _scores(split, models.train_benchmark(
        "random_forest", split.where("not is_test"), T.EV_FEATURES))


@query
def rff_svm_scores(spark, sf):
    split = _split_flows(spark, sf)
    return _scores(split, models.train_rbf_svm(
        split.where("not is_test"), T.EV_FEATURES, 10.0, "scale"))


@query
def rbf_grid_search(spark, sf):
    split = _split_flows(spark, sf)
    found = models.search_rbf_svm(split.where("not is_test"), T.EV_FEATURES, T.EV_KEY)
    return models.grid_table(spark, found.grid)


@query
def svm_coefficients(spark, sf):
    split = _split_flows(spark, sf)
    fitted = models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES)
    return importance.linear_coefficients(
        spark, T.EV_FEATURES, list(fitted.model.stages[-1].coefficients))


@query
def support_vectors(spark, sf):
    train = _split_flows(spark, sf).where("not is_test")
    return models.support_vectors(models.train_linear_svm(train, T.EV_FEATURES), train)


@query
def model_importance(spark, sf):
    """Permutation importance of a fitted RBF model on its test rows."""
    split = _split_flows(spark, sf)
    fitted = models.train_rbf_svm(
        split.where("not is_test"), T.EV_FEATURES, 10.0, "scale")
    return importance.model_permutation_importance(
        split.where("is_test"), T.EV_FEATURES, models.LABEL, T.EV_KEY, fitted.model)


def _checked(scored: DataFrame, agrees: Column | None = None) -> DataFrame:
    """What is certain about a fitted model's rows: how many there are of each label and side, how
    many have a score, and whether every prediction follows from its score."""
    follows = (F.col("decision_score") > 0) == (F.col("prediction") == "ATTACK")
    return scored.groupBy(models.LABEL, "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.count("decision_score").alias("scored"),
        F.bool_and(follows if agrees is None else follows & agrees).alias("consistent"))


@query
def linear_svm_checked(spark, sf):
    """Linear SVM, saved and loaded: its score is that of its coefficients as a column."""
    split = _split_flows(spark, sf)
    fitted = models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES)
    path = models.save_model(fitted.model, scratch_path(spark, "model"))
    scored = scoring.score_with_model(split, models.load_model(spark, path), T.EV_FEATURES)
    column = models.linear_score(fitted)
    near = F.abs(F.col("decision_score") - column) <= 1e-9 * (1 + F.abs(column))
    return _checked(scored, near)


@query
def logreg_checked(spark, sf):
    """Logistic regression: the score is the margin of its probability."""
    split = _split_flows(spark, sf)
    fitted = models.train_benchmark("logistic_regression", split.where("not is_test"), T.EV_FEATURES)
    return _checked(scoring.score_with_model(split, fitted.model, T.EV_FEATURES))


@query
def rf_checked(spark, sf):
    """Random forest: the score is a share of the trees less one half."""
    split = _split_flows(spark, sf)
    fitted = models.train_benchmark("random_forest", split.where("not is_test"), T.EV_FEATURES)
    scored = scoring.score_with_model(split, fitted.model, T.EV_FEATURES)
    return _checked(scored, F.abs("decision_score") <= 0.5)


@query
def rff_svm_checked(spark, sf):
    """SVM on Fourier features; the margin is bounded by its coefficients, as features are."""
    split = _split_flows(spark, sf)
    fitted = models.train_rbf_svm(split.where("not is_test"), T.EV_FEATURES, 1.0, "scale")
    svc = fitted.model.stages[-1]
    most = abs(float(svc.intercept)) + float(svc.coefficients.norm(2)) * (1 + 1e-9)
    scored = scoring.score_with_model(split, fitted.model, T.EV_FEATURES)
    return _checked(scored, F.abs("decision_score") <= most)


@query
def score_csv_checked(spark, sf):
    """File scoring: which rows of the flow CSV have a score, and whether predictions follow."""
    train = _split_flows(spark, sf).where("not is_test")
    fitted = models.train_benchmark("logistic_regression", train, T.EV_FEATURES)
    saved = models.save_model(fitted.model, scratch_path(spark, "model"))
    scored = jobs.score_file(spark, _flow_csv(spark, sf), saved, T.EV_FEATURES)
    follows = (F.col("decision_score") > 0) == (F.col("prediction") == "ATTACK")
    return scored.groupBy(F.col("decision_score").isNotNull().alias("has_score")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_and(follows), F.lit(True)).alias("consistent"))


@query
def multiclass_checked(spark, sf):
    """Pairwise and one-against-rest models name a known class for every row."""
    split = _category_split(spark, sf)
    train = split.where("not is_test")
    pairwise = models.train_pairwise_svm(train, T.EV_FEATURES, max_iter=100)
    other = models.train_one_vs_rest(train, T.EV_FEATURES, max_iter=100).model
    known = [F.lit(c) for c in pairwise.classes]
    called = other.transform(pairwise.transform(split).withColumnRenamed("prediction", "_pairwise"))
    good = F.col("_pairwise").isin(*known) & F.col("prediction").cast("int").isin(*known)
    return called.groupBy("category", models.LABEL, "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(good).alias("known"))


@query
def pca_all_features(spark, sf):
    """All components of the standardised columns together give back their correlations."""
    li = T.lineitem_flows(spark, sf)
    names = T.LI_FEATURES
    fitted = models.fit_pca(features.fit_scaling(li, names).transform(li), names, len(names))
    rows = [(a, b, sum(e * w[i] * w[j] for e, w in zip(fitted.explained, fitted.loadings)) * len(names))
            for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "a string, b string, correlation double").select(
        "a", "b", (F.round("correlation", 6) + 0.0).alias("correlation"))


def _category_split(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = landed(clean.add_category(_cleaned(spark, sf), "category", T.EV_SPEC), "categories")
    flows = features.index_labels(cleaned, "category", models.LABEL)
    return landed(sampling.train_test_split(flows, T.EV_KEY, models.LABEL), "category-split")


@query
def ovr_scores(spark, sf):
    split = _category_split(spark, sf)
    fitted = models.train_one_vs_rest(split.where("not is_test"), T.EV_FEATURES)
    return fitted.model.transform(split).select(
        *T.EV_KEY, "is_test", models.LABEL, F.col("prediction").cast("int").alias("prediction"))


@query
def pairwise_scores(spark, sf):
    split = _category_split(spark, sf)
    fitted = models.train_pairwise_svm(split.where("not is_test"), T.EV_FEATURES)
    return fitted.transform(split).select(*T.EV_KEY, "is_test", models.LABEL, "prediction")


@query
def multiclass_run(spark, sf):
    cleaned = landed(_cleaned(spark, sf), "cleaned")
    done = jobs.multiclass_experiment(cleaned, T.EV_FEATURES, T.EV_KEY, T.EV_SPEC)
    return done[1]


@query
def category_split_sizes(spark, sf):
    """Rows per category and side of the multiclass split."""
    return _category_split(spark, sf).groupBy("category", models.LABEL, "is_test").agg(
        F.count(F.lit(1)).alias("n"))


@query
def binary_split_sizes(spark, sf):
    """Rows per label and side of the binary split that the model queries share."""
    return _split_flows(spark, sf).groupBy(models.LABEL, "is_test").agg(F.count(F.lit(1)).alias("n"))


@query
def pairwise_given(spark, sf):
    """Votes of a pairwise model with given coefficients, saved and loaded before use."""
    flows = T.event_flows(spark, sf)
    scaling = features.fit_scaling(flows, T.GIVEN_FEATURES)
    given = models.PairwiseSVM(T.GIVEN_FEATURES, scaling, [0, 1, 2], T.GIVEN_PAIRS)
    loaded = models.PairwiseSVM.load(spark, given.save(spark, scratch_path(spark, "pairwise")))
    return loaded.transform(flows).select(*T.EV_KEY, "prediction")


@query
def svm_objective_given(spark, sf):
    """Objective, hinge loss and rows inside the margin for given coefficients."""
    flows = T.scored_flows(spark, sf)
    out = models.svm_objective(flows, "y", F.col("score"), T.GIVEN_NORM, 1.0)
    return out.select("y", "n", "inside", F.round("hinge", 6).alias("hinge"),
                      F.round("objective", 6).alias("objective"))


@query
def pca_two_features(spark, sf):
    """Explained variance and loadings of two standardised columns."""
    li = T.lineitem_flows(spark, sf)
    two = T.LI_FEATURES[:2]
    fitted = models.fit_pca(features.fit_scaling(li, two).transform(li), two, 2)
    rows = [(f"pc{k + 1}", e, abs(w[0]), abs(w[1]))
            for k, (e, w) in enumerate(zip(fitted.explained, fitted.loadings))]
    return spark.createDataFrame(rows, "component string, explained double, a double, b double").select(
        "component", *[F.round(c, 9).alias(c) for c in ("explained", "a", "b")])


@query
def pca_projection(spark, sf):
    li = T.lineitem_flows(spark, sf)
    scaled = features.fit_scaling(li, T.LI_FEATURES).transform(li)
    return models.fit_pca(scaled, T.LI_FEATURES).transform(scaled).select(
        "row_key", "l_returnflag", "pc1", "pc2")


@query
def pca_explained(spark, sf):
    flows = landed(_cleaned(spark, sf), "cleaned")
    scaled = features.fit_scaling(flows, T.EV_FEATURES).transform(flows)
    return models.fit_pca(scaled, T.EV_FEATURES, 2).table(spark)


@query
def benchmark_models(spark, sf):
    split = _split_flows(spark, sf)
    return jobs.benchmark_experiment(
        split.where("not is_test"), split.where("is_test"), T.EV_FEATURES).drop("train_time")


@query
def ablation_run(spark, sf):
    split = _split_flows(spark, sf)
    return jobs.ablation_experiment(
        split.where("not is_test"), split.where("is_test"), T.EV_FEATURES, T.EV_SPEC).drop("train_time")


@query
def binary_run(spark, sf):
    """Linear against RBF SVM: the comparison table."""
    split = _split_flows(spark, sf)
    return jobs.binary_experiment(
        split.where("not is_test"), split.where("is_test"), T.EV_FEATURES,
        T.EV_KEY).comparison.drop("train_time")


@query
def drift_run(spark, sf):
    split = _split_flows(spark, sf)
    fitted = models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES)
    _, impact = jobs.drift_run(split.drop("is_test"), T.EV_FEATURES, T.EV_KEY, fitted, 1.5)
    return impact


@query
def drift_run_distributions(spark, sf):
    """The other result of the drift run: how far the perturbed test rows moved."""
    split = _split_flows(spark, sf)
    fitted = models.train_linear_svm(split.where("not is_test"), T.EV_FEATURES)
    return jobs.drift_run(split.drop("is_test"), T.EV_FEATURES, T.EV_KEY, fitted, 1.5)[0]


@query
def multiclass_confusion(spark, sf):
    """Confusion counts of the multiclass run."""
    cleaned = landed(_cleaned(spark, sf), "cleaned")
    return jobs.multiclass_experiment(cleaned, T.EV_FEATURES, T.EV_KEY, T.EV_SPEC)[2]


# --- streams --------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.table(spark, sf, "events").schema
    # As a pattern, so that the table may be a file or a folder of files.
    raw = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_score(spark, sf):
    score = (F.lit(0.05) * F.col("amount") + F.lit(0.02) * F.col("k")) - F.lit(3.0)
    records = scoring.record_columns(
        T.as_records(_event_stream(spark, sf)), "record", ["k", "amount"])
    scored = streams.stream_scores(records, ["k", "amount"], score).select(
        "event_id", "decision_score", "prediction")
    path = scratch_path(spark, "stream-scores")
    streams.write_available(scored, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(scored.schema).parquet(path)


@query
def stream_score_model(spark, sf):
    """A stream scored by a saved model that a manifest names; records it cannot use go without."""
    given = models.PairwiseSVM(
        T.STREAM_FEATURES, features.Scaling(T.STREAM_FEATURES, *T.STREAM_SCALING), [0, 1, 2], T.STREAM_PAIRS)
    manifest = scratch_path(spark, "manifest")
    streams.publish_model(spark, manifest, "v1", given.save(spark, scratch_path(spark, "pairwise")))
    records = scoring.record_columns(
        T.as_records(_event_stream(spark, sf)), "record", T.STREAM_FEATURES)

    def score(batch, model):
        ready = scoring.usable_features(batch, T.STREAM_FEATURES)
        called = F.when(scoring.all_present(T.STREAM_FEATURES), F.col("prediction"))
        return model.transform(ready).select("event_id", called.alias("prediction"))

    path = scratch_path(spark, "stream-calls")
    streams.score_with_published(
        records, manifest, models.PairwiseSVM.load, score, path,
        scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema("event_id long, prediction int, model_version string").parquet(f"{path}/batch=*")


@query
def stream_quarantine(spark, sf):
    good, bad = scratch_path(spark, "valid"), scratch_path(spark, "quarantine")
    records = T.as_records(_event_stream(spark, sf))
    streams.split_records(records, "record", ["k", "amount"], good, bad,
                          scratch_path(spark, "stream-checkpoint")).awaitTermination()
    checked = scoring.validate_records(records, "record", ["k", "amount"]).schema
    sink = lambda path, name: spark.read.schema(checked).parquet(path).withColumn(
        "sink", F.lit(name))
    both = sink(good, "valid").unionByName(sink(bad, "quarantine"))
    return both.select(
        "event_id", "sink", F.array_join("missing_features", ";").alias("missing"),
        F.array_join("invalid_features", ";").alias("invalid"))


@query
def stream_drift_windows(spark, sf):
    """Daily mean and std of a stream against those of the whole table."""
    base = stats.feature_statistics(T.events(spark, sf), ["value"], exact=False)
    path = scratch_path(spark, "windows")
    stat = streams.window_statistics(_event_stream(spark, sf), ["value"], "ts", "1 day", "1 day")
    streams.write_versions(stat, path, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    latest = streams.read_latest(spark, path, ["window_start", "feature"])
    return streams.against_baseline(latest, base.select("feature", "mean", "std")).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature", "n",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "mean_change_pct", "std_change_pct")])
