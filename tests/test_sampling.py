import pytest
from pyspark.sql import functions as F

from flowsift.operators import sampling, slicing


def flows(spark, counts, partitions=4):
    rows, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "id int, label string").repartition(partitions)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def by_label(df, *more):
    cols = ["label", *more]
    return {tuple(r[c] for c in cols) if more else r["label"]: r["count"]
            for r in df.groupBy(*cols).count().collect()}


def test_sample_is_exact_and_keeps_ratios(spark):
    df = flows(spark, {"BENIGN": 800, "ATTACK": 200})
    assert by_label(sampling.stratified_sample(df, 200, "label", ["id"])) == {
        "BENIGN": 160, "ATTACK": 40}
    assert sampling.stratified_sample(df, 500, "label", ["id"]).count() == 500


def test_sample_of_odd_sizes_is_exact(spark):
    df = flows(spark, {"a": 333, "b": 334, "c": 333})
    for size in (10, 100, 997):
        assert sampling.stratified_sample(df, size, "label", ["id"]).count() == size


def test_sample_larger_than_table(spark):
    df = flows(spark, {"BENIGN": 40, "ATTACK": 10})
    assert sampling.stratified_sample(df, 100, "label", ["id"]).count() == 50


def test_tiny_class_keeps_one_row(spark):
    df = flows(spark, {"BENIGN": 5000, "ATTACK": 3})
    got = by_label(sampling.stratified_sample(df, 100, "label", ["id"]))
    assert got["ATTACK"] == 1 and 99 <= got["BENIGN"] <= 100


def test_result_does_not_depend_on_partitions(spark):
    counts = {"BENIGN": 700, "ATTACK": 90}
    runs = []
    for partitions in (1, 4, 16):
        df = flows(spark, counts, partitions)
        runs.append((
            ids(sampling.stratified_sample(df, 100, "label", ["id"])),
            ids(sampling.train_test_split(df, ["id"], "label").where("is_test")),
            sorted(map(tuple, sampling.assign_folds(df, "label", ["id"]).collect())),
            ids(sampling.top_n_sample(df, 7, ["id"], "label")),
        ))
    assert runs[0] == runs[1] == runs[2]


def test_seed_changes_the_sample(spark):
    df = flows(spark, {"a": 300})
    one = ids(sampling.top_n_sample(df, 50, ["id"], seed=1))
    assert one == ids(sampling.top_n_sample(df, 50, ["id"], seed=1))
    assert one != ids(sampling.top_n_sample(df, 50, ["id"], seed=2))


def test_split_sizes(spark):
    df = flows(spark, {"0": 150, "1": 50})
    split = sampling.train_test_split(df, ["id"], "label")
    assert by_label(split, "is_test") == {
        ("0", True): 30, ("0", False): 120, ("1", True): 10, ("1", False): 40}
    plain = sampling.train_test_split(df, ["id"], test_size=0.3)
    assert plain.where("is_test").count() == 60 == sampling.expected_test_rows(200, 0.3)
    assert ids(plain) == list(range(200))


def test_split_rounds_up_and_shares_by_remainder(spark):
    split = sampling.train_test_split(flows(spark, {"a": 7, "b": 7, "c": 7}), ["id"], "label")
    got = by_label(split.where("is_test"))
    assert sum(got.values()) == 5 and set(got.values()) <= {1, 2}


def test_folds(spark):
    df = sampling.assign_folds(flows(spark, {"a": 100, "b": 11, "c": 1}), "label", ["id"], 3)
    assert sorted(r["count"] for r in df.groupBy("fold").count().collect()) == [37, 37, 38]
    per = by_label(df, "fold")
    assert sorted(v for (c, _), v in per.items() if c == "a") == [33, 33, 34]
    assert ids(df) == list(range(112))
    with pytest.raises(ValueError):
        sampling.assign_folds(df, "label", ["id"], 1)


def test_null_class_is_a_class(spark):
    df = flows(spark, {"a": 20}).unionByName(
        spark.range(100, 120).select(F.col("id").cast("int"), F.lit(None).cast("string").alias("label")))
    assert sampling.top_n_sample(df, 5, ["id"], "label").groupBy("label").count().count() == 2


def test_empty_table(spark):
    df = flows(spark, {"a": 3}).where("id < 0")
    assert sampling.stratified_sample(df, 5, "label", ["id"]).count() == 0
    assert sampling.train_test_split(df, ["id"], "label").count() == 0


@pytest.mark.parametrize("same", ["all columns", "key only"])
def test_repeated_keys_are_cut_exactly(spark, same):
    """A third of the rows shares one key; sizes stay exact and no row is lost."""
    df = flows(spark, {"a": 300, "b": 60})
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit(-1)).otherwise(F.col("id"))
    other = F.lit(0) if same == "all columns" else F.col("id")
    df = df.select(key.alias("id"), "label", other.alias("x"))
    folds = sampling.assign_folds(df, "label", ["id"], 3)
    assert [r["count"] for r in folds.groupBy("fold").count().collect()] == [120] * 3
    assert sorted(map(tuple, folds.drop("fold").collect())) == sorted(map(tuple, df.collect()))
    assert sampling.stratified_sample(df, 50, "label", ["id"]).count() == 50
    split = sampling.train_test_split(df, ["id"], "label")
    assert split.where("is_test").count() == 72 and split.count() == 360


def test_copies_are_expanded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(slicing, "EXPAND", 7)
    df = spark.range(100).select(F.lit(1).alias("id"), F.lit("a").alias("label"))
    folds = sampling.assign_folds(df, "label", ["id"], 3)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == [33, 33, 34]


def test_refinement_and_many_classes_give_the_same_rows(spark, monkeypatch):
    df = flows(spark, {"a": 900, "b": 300})
    want = ids(sampling.stratified_sample(df, 77, "label", ["id"]))
    folds = sorted(map(tuple, sampling.assign_folds(df, "label", ["id"], 4).collect()))
    monkeypatch.setattr(slicing, "SIGMAS", 0.01)  # intervals that miss
    assert ids(sampling.stratified_sample(df, 77, "label", ["id"])) == want
    monkeypatch.setattr(slicing, "_estimate", lambda *_: None)
    assert folds == sorted(map(tuple, sampling.assign_folds(df, "label", ["id"], 4).collect()))
    monkeypatch.setattr(slicing, "FINE", 0.0001)  # refine digit group by digit group
    assert ids(sampling.stratified_sample(df, 77, "label", ["id"])) == want
    monkeypatch.setattr(slicing, "pin_small", lambda d, n=0: (d, None))  # class table too large
    monkeypatch.setattr(slicing, "FINE", 1e9)
    assert ids(sampling.stratified_sample(df, 77, "label", ["id"])) == want


def test_whole_classes_and_close_cuts(spark):
    df = flows(spark, {"a": 5, "b": 2, "c": 1})
    folds = sampling.assign_folds(df, "label", ["id"], 5)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == [1, 1, 2, 2, 2]
    assert sampling.top_n_sample(df, 2, ["id"], "label").count() == 5
    assert sampling.stratified_sample(df, 7, "label", ["id"]).count() == 7


def test_shuffle_is_a_seeded_order(spark):
    df = flows(spark, {"a": 200})
    one = [r["id"] for r in sampling.shuffle_rows(df, ["id"]).collect()]
    assert one != sorted(one) and sorted(one) == list(range(200))
    assert one == [r["id"] for r in sampling.shuffle_rows(df.repartition(9), ["id"]).collect()]
