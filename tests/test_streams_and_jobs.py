import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.operators import clean, models, numbering, scoring
from flowsift.plans import jobs
from flowsift.sources import artifacts, flow_files
from flowsift.sources.flow_files import ROW_ID
from flowsift.spec import DEFAULT_SPEC, FEATURE_GROUPS, FEATURES, FlowSpec
from flowsift.streaming import flows as streams


def folder_stream(spark, tmp_path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b={i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in/b=*"))


def test_stream_scores(spark, tmp_path):
    stream = folder_stream(
        spark, tmp_path, [[(1, 2.0)], [(2, None), (3, -1.0)]], "id int, a double")
    scored = streams.stream_scores(stream, ["a"], F.col("a") * 2)
    streams.write_available(scored, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [(r["id"], r["decision_score"], r["prediction"]) for r in rows] == [
        (1, 4.0, "ATTACK"), (2, None, None), (3, -2.0, "BENIGN")]
    # a second run finds nothing new
    streams.write_available(scored, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_newer_model_is_taken_up_between_batches(spark, tmp_path):
    from flowsift.operators.features import Scaling

    rows = [[(1, 1.0), (2, -1.0)], [(3, 2.0)]]
    manifest, out, cp = (str(tmp_path / n) for n in ("manifest", "out", "cp"))
    score = lambda batch, model: model.transform(batch)
    load = models.PairwiseSVM.load
    for version, (sign, batch) in enumerate(zip((1.0, -1.0), rows)):
        given = models.PairwiseSVM(["a"], Scaling(["a"], [0.0], [1.0]), [0, 1], {(0, 1): ([sign], 0.0)})
        saved = given.save(spark, str(tmp_path / f"model{version}"))
        streams.publish_model(spark, manifest, f"v{version}", saved)
        spark.createDataFrame(batch, "id int, a double").coalesce(1).write.parquet(str(tmp_path / f"in/b={version}"))
        stream = spark.readStream.schema("id int, a double").parquet(str(tmp_path / "in/b=*"))
        streams.score_with_published(stream, manifest, load, score, out, cp).awaitTermination()
    got = spark.read.parquet(out).orderBy("id").collect()
    assert [(r["id"], r["prediction"], r["model_version"]) for r in got] == [(1, 0, "v0"), (2, 1, "v0"), (3, 1, "v1")]


def test_a_fitted_pipeline_scores_a_stream(spark, tmp_path):
    """Fourier features included: the stream's scores are those of the batch."""
    rng = np.random.RandomState(3)
    rows = [(i, float(a), float(b), int(a * b > 0)) for i, (a, b) in enumerate(rng.normal(0, 1, (120, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    fitted = models.train_rbf_svm(df, ["a", "b"], 1.0, 0.5, dimensions=32, max_iter=5)
    manifest, out = str(tmp_path / "manifest"), str(tmp_path / "out")
    streams.publish_model(spark, manifest, "v1", models.save_model(fitted.model, str(tmp_path / "model")))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    score = lambda batch, model: scoring.score_with_model(batch, model, ["a", "b"])
    streams.score_with_published(
        stream, manifest, models.load_model, score, out, str(tmp_path / "cp")).awaitTermination()
    want = scoring.score_with_model(df, fitted.model, ["a", "b"]).select("id", "decision_score")
    got = spark.read.parquet(out).select("id", "decision_score")
    assert sorted(got.collect()) == sorted(want.collect())


def test_split_records(spark, tmp_path):
    stream = folder_stream(
        spark, tmp_path, [[(1, {"a": "1"})], [(2, {}), (3, {"a": "x"}), (4, {"a": "2"})]],
        "id int, record map<string,string>")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    streams.split_records(stream, "record", ["a"], good, bad, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(good).collect()) == [1, 4]
    got = {r["id"]: r for r in spark.read.parquet(bad).collect()}
    assert got[2]["missing_features"] == ["a"] and got[3]["invalid_features"] == ["a"]


def test_drift_windows(spark, tmp_path):
    hour = "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, {0})"
    day = lambda h: spark.sql(f"select {hour.format(h)} as t").first()["t"]
    stream = folder_stream(spark, tmp_path, [
        [(day(0), 1.0), (day(1), 3.0)], [(day(2), 5.0), (day(30), 10.0), (day(31), 12.0)],
    ], "ts timestamp, v double")
    stats = streams.window_statistics(stream, ["v"], "ts", "1 day", "1 day")
    streams.write_versions(stats, str(tmp_path / "w"), str(tmp_path / "cp")).awaitTermination()
    latest = streams.read_latest(spark, str(tmp_path / "w"), ["window_start", "feature"])
    base = spark.createDataFrame([("v", 3.0, 2.0)], "feature string, mean double, std double")
    rows = streams.against_baseline(latest, base).orderBy("window_start").collect()
    assert [(r["n"], r["mean"]) for r in rows] == [(3, 3.0), (2, 11.0)]
    assert rows[0]["mean_change_pct"] == pytest.approx(0)
    assert rows[1]["mean_change_pct"] == pytest.approx(400)


@pytest.fixture(scope="module")
def flow_file(tmp_path_factory):
    """A CSV day with blank-padded header, copies, infinities and three categories."""
    rng = np.random.RandomState(5)
    lines = [", ".join(FEATURES) + ", Label"]
    names = ["BENIGN"] * 7 + ["DDoS", "Bot", "DDoS"]
    for i in range(400):
        raw = names[i % 10]
        shift = {"BENIGN": 0, "DDoS": 3, "Bot": -3}[raw]
        values = [f"{v:.4f}" for v in rng.normal(10 + shift, 1, len(FEATURES))]
        if i % 50 == 0:
            values[7] = "Infinity"
        lines += [",".join([*values, raw])] * (2 if i % 40 == 1 else 1)
    lines += ["1,2,3", ",".join(["1"] * 17)]  # a field too few, one too many
    path = tmp_path_factory.mktemp("flows") / "day.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_training_sample_is_split_without_the_table(spark, tmp_path):
    """The split's passes read the sample, not the cleaned table that it was drawn from."""
    rows = [(float(i), float(i % 7), "BENIGN" if i % 3 else "Bot", i) for i in range(300)]
    path = str(tmp_path / "cleaned")
    spark.createDataFrame(rows, f"a double, b double, `{DEFAULT_SPEC.label_col}` string, {ROW_ID} int").write.parquet(path)
    sample = jobs.training_sample(spark.read.parquet(path), ["a", "b"], DEFAULT_SPEC, 60)
    assert sample.count() == 60 and sample.where("is_test").count() == 12
    assert not [f for f in sample.inputFiles() if "/cleaned/" in f]


def test_training_run_end_to_end(spark, flow_file, tmp_path):
    out = str(tmp_path / "runs")
    spec = FlowSpec(
        features=FEATURES, groups=FEATURE_GROUPS, categories={"benign": "BENIGN", "ddos": "DDoS", "bot": "Bot"},
        ablations={"all": ("All", []), "none": ("Too few", list(FEATURE_GROUPS))})
    run = jobs.training_run(
        spark, flow_file, out, spec, sample_size=200, multiclass=True, ablation=True,
        grid={"C": [1.0], "gamma": ["scale"]}, repeats=2, dimensions=32, max_iter=5)
    home = f"{out}/{run}"
    listed = artifacts.list_runs(spark, f"{out}/runs").collect()
    assert [r["experiment_id"] for r in listed] == [run]
    meta = artifacts.load_metadata(spark, f"{home}/metadata")
    assert meta == json.loads(listed[0]["config"])
    report = meta["validation_report"]
    assert report["raw_rows"] == 410 and report["duplicates_removed"] == 10
    assert report["inf_replaced"] == 8 == report["nan_rows_dropped"] and report["corrupt_rows"] == 2
    assert spark.read.parquet(f"{home}/quarantine").count() == 2
    summary = artifacts.load_metadata(spark, f"{home}/training_summary")
    assert summary["rows"]["raw_rows"] == 410 and set(summary["models"]) == {jobs.LINEAR, jobs.RBF}
    assert artifacts.read_csv(spark, f"{home}/multiclass_confusion", "truth int, predicted int, n int").count() >= 3
    assert models.PairwiseSVM.load(spark, f"{home}/multiclass_model").classes == [0, 1, 2]
    raw = spark.read.option("header", True).csv(f"{home}/original_class_distribution")
    assert {r["class"] for r in raw.collect()} == {"BENIGN", "DDoS", "Bot"}
    assert len(report["dataset_hash"]) == 16 and report["features_missing"] == []
    assert (meta["train_size"], meta["test_size"]) == (160, 40)
    assert meta["best_model"] in (jobs.LINEAR, jobs.RBF) and meta["multiclass"]["accuracy"] > 0.8
    assert artifacts.read_csv(spark, f"{home}/model_comparison", jobs.RESULT).count() == 2
    assert spark.read.json(f"{home}/ablation").count() == 1
    assert spark.read.option("header", True).csv(f"{home}/threshold_analysis").count() == 61
    assert spark.read.option("header", True).csv(f"{home}/feature_importance").count() == 15
    assert spark.read.parquet(f"{home}/pca_projection").count() == 40
    scored = jobs.score_file(spark, flow_file, f"{home}/model", FEATURES)
    assert scored.count() == 412 and scored.where("prediction is null").count() == 10
    assert scored.where("_corrupt is not null and prediction is null").count() == 2


def test_a_run_that_was_cut_short_goes_on(spark, flow_file, tmp_path, monkeypatch):
    """Finished stages are not run again, the rest is, and the registry holds the run once."""
    spec = FlowSpec(features=FEATURES, groups=FEATURE_GROUPS, categories={"benign": "BENIGN"})
    out, run = str(tmp_path / "runs"), "EXP-2024-01-01-000000"
    settings = dict(sample_size=200, grid={"C": [1.0], "gamma": [0.1]}, repeats=1, dimensions=16, max_iter=3)

    def stop(*args, **kwargs):
        raise RuntimeError("cut short")

    with monkeypatch.context() as m:
        m.setattr(jobs, "binary_experiment", stop)
        with pytest.raises(RuntimeError):
            jobs.training_run(spark, flow_file, out, spec, run_id=run, **settings)
    assert artifacts.list_runs(spark, f"{out}/runs").count() == 0
    sample = sorted(map(tuple, spark.read.parquet(f"{out}/{run}/sample").collect()))
    with monkeypatch.context() as m:
        m.setattr(jobs, "land_input", stop)
        m.setattr(jobs, "training_sample", stop)
        jobs.training_run(spark, flow_file, out, spec, run_id=run, **settings)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/{run}/sample").collect())) == sample
    first = artifacts.list_runs(spark, f"{out}/runs").collect()
    with monkeypatch.context() as m:
        m.setattr(jobs, "binary_experiment", stop)
        jobs.training_run(spark, flow_file, out, spec, run_id=run, **settings)
    assert artifacts.list_runs(spark, f"{out}/runs").collect() == first and len(first) == 1
    assert spark.read.parquet(f"{out}/runs").count() == 3


def test_training_sample_depends_on_the_rows_alone(spark, flow_file, tmp_path):
    spec = FlowSpec(features=FEATURES, groups=FEATURE_GROUPS)
    (tmp_path / "moved").mkdir()
    copy = tmp_path / "moved" / "other.csv"
    copy.write_text(open(flow_file).read())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = set()
    try:
        for path, split in ((flow_file, "4k"), (flow_file, "64k"), (str(copy), "16k")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            good, _ = flow_files.split_corrupt(flow_files.read_flow_csv(spark, path))
            flows, features, _ = flow_files.shape_flows(good, spec, [flow_files.ROW_ID])
            cleaned = clean.drop_unusable(
                clean.clean_flows(flows, features, [flow_files.ROW_ID], spec), features)
            rows = jobs.training_sample(cleaned, features, spec, 100).select(jobs.KEY, "is_test", "y")
            seen.add(tuple(sorted(map(tuple, rows.collect()))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(seen) == 1 and len(seen.pop()) == 100


def test_numbers_by_range_equal_numbers_by_window(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 1009).cast("string").alias("k"))
    one = numbering.numbered(df, ["k"], "n").collect()
    assert sorted(one) == sorted(numbering.numbered_by_range(df, ["k"], "n").collect())
    assert [r["k"] for r in sorted(one, key=lambda r: r["n"])] == sorted(r["k"] for r in one)


def test_drift_run_and_benchmark(spark):
    rng = np.random.RandomState(2)
    rows = [(i, float(a + 2 * (i % 2)), float(b), i % 2) for i, (a, b) in
            enumerate(rng.normal(0, 1, (300, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    fitted = models.train_linear_svm(df, ["a", "b"], max_iter=10)
    compared, impact = jobs.drift_run(df, ["a", "b"], ["id"], fitted, 3.0)
    assert compared.where("std_change_pct > 50").count() == 1
    assert {r["metric"] for r in impact.collect()} == {"accuracy", "precision", "recall", "f1"}
    table = jobs.benchmark_experiment(df, df, ["a", "b"], {"random_forest": {"trees": 3, "max_depth": 3}})
    assert [r["kernel"] for r in table.collect()] == ["N/A", "N/A"]


def test_multiclass_needs_three_classes(spark):
    df = spark.createDataFrame([(1, 1.0, "ddos"), (2, 2.0, "benign")], "id int, a double, Original_Label string")
    spec = FlowSpec(features=["a"], categories={"benign": "BENIGN", "ddos": "DDoS"})
    assert jobs.multiclass_experiment(df, ["a"], ["id"], spec) is None
