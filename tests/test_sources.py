import hashlib
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from flowsift.operators import clean
from flowsift.sources import artifacts, flow_files
from flowsift.spec import DEFAULT_SPEC, FlowSpec

SPEC = FlowSpec(features=["a", "b", "c"], aliases={"a": ["a", "A"], "b": ["b"]})
DIRTY = "\n".join([
    " A , b,Some LABEL",
    "1,2,BENIGN",
    "1,2, Benign ",          # copy of the first row
    "1.0,2,DDoS",            # same numbers, other class
    "Infinity,2,BENIGN",
    ",2,BENIGN",
    "x,2,BENIGN",            # unreadable, not a copy of the row above
    "NaN,2,BENIGN",          # copy of the row with the blank
    "3,1.5d,Web Attack \x96 XSS",
    "4,-inf,Bot",
    "5,6,",
    "5,6,NA",                # copy
    "7,8,Bot",
]) + "\n"


@pytest.fixture
def dirty(tmp_path):
    path = tmp_path / "day.csv"
    path.write_bytes(DIRTY.encode("latin-1"))
    return path


def load(spark, path):
    good, _ = flow_files.split_corrupt(flow_files.read_flow_csv(spark, str(path)))
    flows, features, missing = flow_files.shape_flows(good, SPEC, [flow_files.ROW_ID])
    return clean.clean_flows(flows, features, [flow_files.ROW_ID], SPEC), features, missing


def test_dirty_file(spark, dirty):
    deduped, features, missing = load(spark, dirty)
    assert (features, missing) == (["a", "b"], ["c"])
    assert clean.clean_report(deduped, features).first().asDict() == {
        "raw_rows": 12, "cleaned_rows": 4, "removed_rows": 8, "duplicates_removed": 3,
        "inf_replaced": 2, "nan_rows_dropped": 5,
    }
    rows = clean.drop_unusable(deduped, features).select("a", "b", "Label", "Original_Label")
    assert sorted(map(tuple, rows.collect()), key=repr) == [
        (1.0, 2.0, "ATTACK", "DDoS"), (1.0, 2.0, "BENIGN", "BENIGN"), (5.0, 6.0, "BENIGN", None),
        (7.0, 8.0, "ATTACK", "Bot"),
    ]


def test_validation_report(spark, dirty):
    deduped, features, missing = load(spark, dirty)
    r = clean.validation_report(deduped, features, missing, SPEC, "day.csv", "f", 3).first()
    assert r["corrupt_rows"] == 3 and r["dataset_hash"] == "f"
    assert r["class_distribution"] == {"ATTACK": 2, "BENIGN": 2}
    assert r["class_percentages"] == {"ATTACK": 50.0, "BENIGN": 50.0}
    assert r["imbalance_ratio"] == 1.0 and r["features_missing"] == ["c"]
    assert r["columns"] == ["a", "b", "Label", "Original_Label"]


def test_raw_labels_are_a_table_of_their_own(spark, dirty):
    deduped, features, missing = load(spark, dirty)
    report = clean.validation_report(deduped, features, missing, SPEC)
    assert "original_class_distribution" not in report.columns
    table = clean.class_distribution(clean.drop_unusable(deduped, features), "Original_Label")
    assert {x["class"]: x["n"] for x in table.collect()} == {"BENIGN": 1, "Bot": 1, "DDoS": 1}


def test_written_report_equals_the_query(spark, dirty, tmp_path):
    deduped, features, _ = load(spark, dirty)
    cleaned = clean.write_cleaned(deduped, features, str(tmp_path / "cleaned"))
    assert cleaned.count() == clean.clean_report(deduped, features).first()["cleaned_rows"]


def test_ragged_lines_are_kept_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,Label\n1,2,Bot\n1,2,Bot,9\n3\n4,5,\n")
    raw = flow_files.read_flow_csv(spark, str(tmp_path / "a.csv"))
    good, bad = flow_files.split_corrupt(raw)
    assert sorted(map(tuple, good.drop(flow_files.ROW_ID).collect())) == [("1", "2", "Bot"), ("4", "5", None)]
    assert sorted(r["line"] for r in bad.collect()) == ["1,2,Bot,9", "3"]
    assert bad.count() == 2 and raw.where(F.col(flow_files.CORRUPT).isNotNull()).count() == 2


def test_first_copy_in_file_order_survives(spark, tmp_path):
    for i, raw in enumerate(["Bot", "DDoS", "PortScan"]):
        (tmp_path / f"day{i}.csv").write_text("a,b,Label\n" + f"1,1,{raw}\n" * 50)
    deduped, features, _ = load(spark, tmp_path / "*.csv")
    row = deduped.repartition(3).collect()
    assert len(row) == 1 and row[0]["Original_Label"] == "Bot" and row[0]["copies"] == 150


def test_number_labels_are_benign(spark):
    df = spark.createDataFrame([(1.0, 42)], "a double, Label int")
    assert clean.label_flows(df).first()["Label"] == "BENIGN"


def test_resolution():
    full = [*DEFAULT_SPEC.features, "Label"]
    found, missing = flow_files.resolve_features(full)
    assert len(found) == 15 and not missing
    found, missing = flow_files.resolve_features(
        ["Flow Bytes/s ", "Flow Packets/s ", "flow duration", "Label"])
    assert found["Flow Bytes/s"] == "Flow Bytes/s " and found["Flow Duration"] == "flow duration"
    assert len(missing) == 12
    assert len(flow_files.resolve_features(["Unrelated", "Columns"])[1]) == 15


def test_label_column():
    assert flow_files.find_label(["x", "Label", "my label"]) == "Label"
    assert flow_files.find_label(["x", "my label"]) == "my label"
    many = [f"column{i}" for i in range(30)]
    with pytest.raises(ValueError, match="column29"):
        flow_files.find_label(many)


def test_discovery(spark, dirty, tmp_path):
    folder = str(tmp_path)
    assert flow_files.discover(spark, str(dirty), folder, "none.csv") == str(dirty)
    assert flow_files.discover(spark, None, folder, "day.csv") == f"{folder}/day.csv"
    assert flow_files.discover(spark, "/no/such.csv", folder, "none.csv") == f"{folder}/*.csv"
    with pytest.raises(FileNotFoundError):
        flow_files.discover(spark, None, f"{folder}/empty", "none.csv")


def test_fingerprints_of_long_files_by_piece(spark, tmp_path, monkeypatch):
    """No task reads more than a piece, and the SHA-256 is that of the whole file."""
    contents = {f"a b%20{n}.bin": bytes(i * 7 % 251 for i in range(n)) for n in (1, 63, 999, 1000, 1001, 2000, 5003)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    monkeypatch.setattr(flow_files, "PIECE", 1000)
    monkeypatch.setattr(flow_files, "READ_BYTES", 300)
    rounds, landed = [], flow_files.landed
    monkeypatch.setattr(flow_files, "landed", lambda df, name: rounds.append(name) or landed(df, name))
    got = {r["file"]: (r["bytes"], r["fingerprint"])
           for r in flow_files.file_fingerprints(spark, str(tmp_path), "*.bin").collect()}
    assert got == {k: (len(v), hashlib.sha256(v).hexdigest()[:16]) for k, v in contents.items()}
    assert len(rounds) == 6


def test_fingerprints(spark, dirty):
    row = flow_files.file_fingerprints(spark, str(dirty)).first()
    assert row["fingerprint"] == hashlib.sha256(dirty.read_bytes()).hexdigest()[:16]
    df = spark.range(100).select("id", F.lit("x").alias("s"))
    one = flow_files.row_fingerprint(df, ["id", "s"]).first()
    assert one == flow_files.row_fingerprint(df.repartition(7), ["id", "s"]).first()
    assert one != flow_files.row_fingerprint(df.where("id > 0"), ["id", "s"]).first()
    pairs = [("a|b", "c"), ("a", "b|c"), ("1:a", None), (None, "1:a"), ("-", None), (None, None)]
    prints = {flow_files.row_fingerprint(
        spark.createDataFrame([p], "x string, y string"), ["x", "y"]).first()["fingerprint"] for p in pairs}
    assert len(prints) == len(pairs)
    close = [1.0, 1.000001, 1e20, 2e20, float("nan"), float("inf"), None, -1.5]
    prints = {flow_files.row_fingerprint(
        spark.createDataFrame([(v,)], "x double"), ["x"]).first()["fingerprint"] for v in close}
    assert len(prints) == len(close)


def test_tables_and_records(spark, tmp_path):
    df = spark.createDataFrame([(0.1, 3), (None, 4)], "t double, n int")
    path = artifacts.write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, artifacts.read_csv(spark, path, "t double, n int").collect()), key=repr) \
        == [(0.1, 3), (None, 4)]
    assert artifacts.read_csv(spark, str(tmp_path / "none"), "t double").count() == 0
    path = artifacts.write_json(df, str(tmp_path / "j"))
    assert artifacts.read_json(spark, path, df.schema).count() == 2
    nested = artifacts.record(spark, {"a": 1, "b": {"c": [1.5]}}).first()
    assert nested["b"]["c"] == [1.5]


def test_metadata(spark, tmp_path):
    meta = {"features": ["a"], "metrics": {"f1": 0.5}}
    path = artifacts.save_metadata(spark, meta, str(tmp_path / "m"))
    assert artifacts.load_metadata(spark, path) == meta
    assert artifacts.load_metadata(spark, str(tmp_path / "none")) == {}


def test_runs(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert artifacts.list_runs(spark, root).count() == 0
    artifacts.save_run(spark, root, "EXP-2", config={"a": 1}, metrics={"f1": 0.5})
    artifacts.save_run(spark, root, "EXP-1", config={"a": 2})
    artifacts.save_run(spark, root, "OTHER", config={"a": 3})
    rows = artifacts.list_runs(spark, root).collect()
    assert [r["experiment_id"] for r in rows] == ["EXP-1", "EXP-2"]
    assert rows[0]["metrics"] is None and rows[1]["metrics"] == '{"f1": 0.5}'
    assert re.fullmatch(r"EXP-\d{4}-\d\d-\d\d-\d{6}", artifacts.new_run_id(spark))
    stamp = datetime.fromisoformat(artifacts.utc_now(spark))
    assert abs((datetime.now(timezone.utc) - stamp).total_seconds()) < 60


def test_counts_are_taken_by_the_write(spark, dirty, tmp_path):
    """The report of the observed write is the aggregate's, and the rows are computed once."""
    deduped, features, missing = load(spark, dirty)
    want = clean.validation_report(deduped, features, missing, SPEC, "day.csv", "f", 3).first()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = deduped.mapInArrow(count, deduped.schema)
    cleaned, counts = clean.write_deduped(watched, features, str(tmp_path / "deduped"), SPEC)
    assert seen.value == deduped.count()
    got = clean.counted_report(spark, counts, features, missing, SPEC, "day.csv", "f", 3).first()
    assert got == want
    assert cleaned.count() == got["cleaned_rows"] and seen.value == deduped.count()


def test_counts_of_nothing(spark, dirty, tmp_path):
    deduped, features, missing = load(spark, dirty)
    cleaned, counts = clean.write_deduped(deduped.where("false"), features, str(tmp_path / "none"), SPEC)
    assert cleaned.count() == 0 and set(counts.values()) == {0}
    report = clean.counted_report(spark, counts, features, missing, SPEC).first()
    assert report["class_distribution"] == {} and report["imbalance_ratio"] == 0.0


def test_files_whose_headers_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,Label\n1,2,BENIGN\n3,4\n")
    (tmp_path / "b.csv").write_text(" Label , A ,extra\nBot,5,6\n")
    (tmp_path / "c.csv").write_text("a,b,Label\n7,8,DDoS\n")
    (tmp_path / "d.csv").write_text("")
    rows = flow_files.read_flow_files(spark, str(tmp_path / "*.csv"))
    assert rows.columns == ["a", "b", "Label", "extra", flow_files.CORRUPT, flow_files.ROW_ID]
    got = sorted(((r["a"], r["b"], r["Label"], r["extra"], r["_corrupt"]) for r in rows.collect()), key=repr)
    assert got == sorted([("1", "2", "BENIGN", None, None), ("3", "4", None, None, "3,4"),
                          ("5", None, "Bot", "6", None), ("7", "8", "DDoS", None, None)], key=repr)
    flows, features, missing = flow_files.shape_flows(flow_files.split_corrupt(rows)[0], SPEC, [flow_files.ROW_ID])
    assert (features, missing) == (["a", "b"], ["c"])
    assert clean.clean_flows(flows, features, [flow_files.ROW_ID], SPEC).count() == 3
    one = flow_files.read_flow_files(spark, str(tmp_path / "a.csv"))
    assert one.columns == ["a", "b", "Label", flow_files.CORRUPT, flow_files.ROW_ID]
