"""Neighbours, language and the whole pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from flowsift.llm import ann_scan, language_cnn
from flowsift.llm.catalog import ORACLE, QUERIES
from tests.llm import cases


def brute(data, k):
    good = {i: np.array(v, float) for i, v in data if i is not None and v is not None and len(v) == 4
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in good.items():
        if q % 3 == 0:
            hits = sorted((-float((x * y).sum()), i) for i, y in good.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in hits]
    return out


def test_search_of_all_lists_is_exact(spark):
    rng = np.random.default_rng(0)
    data = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(300)]
    data += [(300 + i, [1.0, 2.0, 3.0, 1.0]) for i in range(150)]  # a third are equal
    data += [(900, None), (903, [0.0] * 4), (906, [1.0, None, 2.0, 3.0]), (909, [1.0, float("nan"), 1.0, 1.0]),
             (912, [float("inf"), 1.0, 1.0, 1.0]), (915, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]),
             (918, [5.0, 0.0, 0.0, 0.0]), (918, [5.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "'x' as class", "1 as rank")
    got = {}
    for r in ann_scan.search(df, df.where("vec_id % 3 = 0"), 20, probe_share=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(data, 20)
    assert set(got) == set(want)
    for q, hits in want.items():
        own = sorted(got[q])
        assert [h[0] for h in own] == list(range(1, len(hits) + 1))
        assert [h[1] for h in own] == [i for i, _ in hits]
        assert np.allclose([h[2] for h in own], [s for _, s in hits], rtol=0, atol=1e-12)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann_scan.search(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [tuple(r) for r in ann_scan.search(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.5)]


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    found = {}
    for r in QUERIES["op3_adaptive_scan"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        order = np.lexsort((ids, -(x @ x[q])))
        want = [ids[i] for i in order if i != q][:20]
        hits += len(found[ids[q]] & set(want))
        total += 20
    assert hits / total >= 0.9


def like_the_given(n, seed=7):
    """Vectors with the means and covariances of the given ones, label by label."""
    rng = np.random.default_rng(seed)
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    out = []
    for _, own in rows.groupby("label"):
        x = np.stack(own["embedding"]).astype(float)
        out.append(rng.multivariate_normal(x.mean(axis=0), np.cov(x.T), round(n * len(x) / len(rows)) + 1))
    return rng.permutation(np.concatenate(out))[:n]


def test_recall_on_many_vectors(spark):
    x = like_the_given(20_000)
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)})
    df = spark.createDataFrame(table)
    found = {}
    for r in ann_scan.search(df, df.where("vec_id % 200 = 0")).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 200):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert len(found) == 100 and hits / 2000 >= 0.9, hits / 2000


def test_strictness_is_that_of_the_scan():
    rng = np.random.default_rng(6)
    rows, q = rng.normal(size=(600, 64)), rng.normal(size=64)
    rows = rows[np.argsort(((rows - q) ** 2).sum(axis=1))]
    strict = ann_scan._strictness(np.tile(q, (10, 1)), rows[:10], np.zeros(10, int), 10)
    for epsilon in (0.2, 0.7, 2.1):  # the first 512 rows hold the 10 nearest; then comes one of them again
        kept = [512 in ann_scan.scan(q, np.concatenate([rows[:512], rows[i:i + 1]]), 10, epsilon=epsilon) for i in range(10)]
        assert kept == (strict <= epsilon).tolist()


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(3000, 64)) @ ann_scan.rotation(64)
    kept = 0
    for _ in range(20):
        q = rows[rng.integers(3000)] + rng.normal(size=64) * 0.5
        want = set(np.argsort(((rows - q) ** 2).sum(axis=1))[:10].tolist())
        kept += len(want & set(ann_scan.scan(q, rows, 10).tolist()))
    assert kept >= 195


def documents_of(n, seed=1):
    rnd = random.Random(seed)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ster", "ung", "ich", "gen"], "cc": ["ção", "ões", "lhe", "nho"]}
    data = []
    for i in range(n):
        lang = rnd.choice(list(parts))
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 3)))
                        for _ in range(rnd.choice([3, 20, 300])))
        data.append((i, text, lang if i % 7 else None, "s", 1))
    return data


def test_language_on_held_out_documents(spark):
    data = documents_of(600)
    odd = [(1001, None, "aa", "s", 1), (1002, "", "aa", "s", 1), (1003, "123 ... 🙂", "bb", "s", 1), (None, "ka lo mi", "aa", "s", 1)]
    df = cases.table(spark, data + odd + [data[0]])
    rows = language_cnn.classify(df).collect()
    assert len(rows) == len(data) + 5
    truth = {i: lang for i, _, lang, *_ in data}
    hits = []
    for r in rows:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (1001, 1002, 1003):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["held_out"] and truth.get(r["doc_id"]):
            hits.append(r["lang_pred"] == truth[r["doc_id"]])
    assert len(hits) > 100 and sum(hits) / len(hits) > 0.95


def test_language_learns_from_no_held_out_row(spark):
    data = documents_of(60)
    chosen = language_cnn.sample(cases.table(spark, data)).collect()
    assert chosen and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"] for r in chosen)
    assert len(language_cnn.sample(cases.table(spark, data), most=9).collect()) <= 9


def test_language_without_labels(spark):
    df = cases.table(spark, [(1, "some text", None, "s", 1)])
    assert [tuple(r)[2:] for r in language_cnn.classify(df).collect()] == [("und", 0.0)]
    assert language_cnn.classify(cases.empty(spark)).count() == 0


def test_windows_cover_the_text():
    for n in (0, 1, 255, 256, 257, 1000):
        text = bytes(i % 251 for i in range(n))
        windows = language_cnn.windows_of(text)
        assert b"".join(w[:256].tobytes() for w in windows)[:n] == text
    net = language_cnn.fit(np.stack([language_cnn.windows_of(t)[0] for t in (b"aaa", b"bbb")] * 30),
                           np.array([0, 1] * 30), ["a", "b"], epochs=20)
    p = language_cnn.probabilities(net, net.tables(), np.stack([language_cnn.windows_of(t)[0] for t in (b"aaa", b"bbb")]))
    assert p[0, 0] > 0.8 and p[1, 1] > 0.8


# --- pipeline ------------------------------------------------------------------------------


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "suffix_dedup", "packing"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)


def test_stages_return_the_columns_of_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    last = sorted(map(tuple, docs.drop("sequence_id", "offset").collect()))
    again = sorted(map(tuple, corpus_pipeline.run(spark, sf).drop("sequence_id", "offset").collect()))
    assert {r[0] for r in last} == {r[0] for r in again} and sum(r[2] for r in last) == sum(r[2] for r in again)


@pytest.mark.parametrize("data", [[], cases.rows()], ids=["empty", "odd"])
def test_stages_on_odd_tables(spark, sf, data):
    docs = cases.table(spark, data, clashing=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() >= 0
